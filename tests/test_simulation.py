import hashlib
import math

import numpy as np
import pytest

from revenue_lens.operators.simulation import MODULUS, hash_sample, monte_carlo_profit, profit_summary, simulate_draws


def orders(spark, n):
    return spark.createDataFrame([(i, 100.0 + i % 50) for i in range(n)], "order_id long, revenue double")


def test_sample_is_the_lowest_hashes(spark):
    df = orders(spark, 3000)
    lowest = sorted(range(3000), key=lambda i: int(hashlib.md5(f"42|{i}".encode()).hexdigest()[:13], 16))[:100]
    for layout in (df, df.repartition(11)):
        assert sorted(r["order_id"] for r in hash_sample(layout, 100, "order_id").collect()) == sorted(lowest)


def test_small_table_is_taken_whole(spark):
    assert hash_sample(orders(spark, 30), 100, "order_id").count() == 30
    assert hash_sample(orders(spark, 30), None, "order_id").count() == 30


def test_draws_against_numpy(spark):
    df = orders(spark, 40)
    found = {r["draw"]: r["total_profit"] for r in simulate_draws(df, "order_id", 25).collect()}
    expected = np.zeros(25)
    for i in range(40):
        digest = hashlib.md5(f"42|order|{i}".encode()).hexdigest()
        a1, c1, a2, c2 = (int(digest[8 * k : 8 * k + 8], 16) % MODULUS for k in range(4))
        d = np.arange(25)
        u1, u2 = (((a * d + c) % MODULUS + 0.5) / MODULUS for a, c in ((a1, c1), (a2, c2)))
        ratio = np.clip(np.exp(-0.45 + 0.15 * np.sqrt(-2 * np.log(u1)) * np.cos(2 * np.pi * u2)), 0.2, 0.95)
        expected += (100.0 + i % 50) * (1 - ratio)
    assert [found[d] for d in range(25)] == pytest.approx(list(expected))


def test_many_draws_need_no_row_each(spark):
    """Rows of draws took about 100 ns each: the plan must not multiply orders by draws."""
    draws = simulate_draws(orders(spark, 40), "order_id", 5000)
    assert "Generate" not in draws._jdf.queryExecution().toString()
    found = {r["draw"]: (r["total_profit"], r["orders"]) for r in draws.collect()}
    assert sorted(found) == list(range(5000)) and {n for _, n in found.values()} == {40}
    seeds = [[int(hashlib.md5(f"42|order|{i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) % MODULUS for k in range(4)] for i in range(40)]
    for d in (0, 1, 99, 100, 101, 2499, 4900, 4999):
        u = [((a1 * d + c1) % MODULUS + 0.5, (a2 * d + c2) % MODULUS + 0.5) for a1, c1, a2, c2 in seeds]
        ratio = [min(max(math.exp(-0.45 + 0.15 * math.sqrt(-2 * math.log(x / MODULUS)) * math.cos(2 * math.pi * y / MODULUS)), 0.2), 0.95) for x, y in u]
        assert found[d][0] == pytest.approx(sum((100.0 + i % 50) * (1 - r) for i, r in enumerate(ratio)), rel=1e-12)


def test_odd_revenues(spark):
    schema = "order_id long, revenue double"
    missing = simulate_draws(spark.createDataFrame([(1, None), (2, 8.0), (3, None)], schema), "order_id", 7).collect()
    alone = {r["draw"]: r["total_profit"] for r in simulate_draws(spark.createDataFrame([(2, 8.0)], schema), "order_id", 7).collect()}
    assert {r["draw"]: r["total_profit"] for r in missing} == pytest.approx(alone) and {r["orders"] for r in missing} == {3}
    assert {r["total_profit"] for r in simulate_draws(spark.createDataFrame([(1, None)], schema), "order_id", 3).collect()} == {None}
    assert {r["total_profit"] for r in simulate_draws(spark.createDataFrame([(1, math.inf), (2, 8.0)], schema), "order_id", 3).collect()} == {math.inf}
    assert simulate_draws(spark.createDataFrame([], schema), "order_id", 3).collect() == []


def test_distribution(spark):
    df = orders(spark, 400)
    row = profit_summary(simulate_draws(df, "order_id", 2000)).first()
    revenue = np.array([100.0 + i % 50 for i in range(400)])
    mean, sd = math.exp(-0.45 + 0.15**2 / 2), math.exp(-0.45 + 0.15**2 / 2) * math.sqrt(math.exp(0.15**2) - 1)
    assert row["mean_total_profit"] == pytest.approx(revenue.sum() * (1 - mean), rel=2e-3)
    assert row["std"] == pytest.approx(sd * math.sqrt((revenue**2).sum()), rel=0.05)
    assert row["p5"] <= row["p50"] <= row["p95"]
    assert (row["n_orders_in_sim"], row["n_draws"]) == (400, 2000)


def test_margins_and_repeatability(spark):
    df = orders(spark, 1000)
    rows = [monte_carlo_profit(layout, "order_id", n_draws=50, n_orders=100).first() for layout in (df, df.repartition(9))]
    assert rows[0]["mean_total_profit"] == pytest.approx(rows[1]["mean_total_profit"])
    assert 0.2 < rows[0]["margin_sim"] < 0.5
    assert rows[0]["margin_reference"] == pytest.approx(rows[0]["margin_sim"] / 10, rel=0.2)
    other = monte_carlo_profit(df, "order_id", n_draws=50, n_orders=100, seed=7).first()
    assert other["mean_total_profit"] != rows[0]["mean_total_profit"]
