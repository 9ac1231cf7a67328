import math

import pytest
from pyspark.sql import functions as F

from revenue_lens.operators import ranking
from revenue_lens.operators.ranking import rows_at_ranks, running_totals
from revenue_lens.operators.rfm import add_rfm_segments, quantile_parts, top_risk_decile


def table(spark, values):
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(values)], "customer_id long, v double")


def parts(df, n=5):
    rows = quantile_parts(df, {"part": "v"}, n).orderBy("customer_id").collect()
    return [r["part"] for r in rows]


def test_seven_values(spark):
    assert parts(table(spark, range(7))) == [1, 2, 3, 3, 4, 5, 5]


def test_ties_by_id(spark):
    assert parts(table(spark, [3] * 5)) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6])
def test_fewer_rows_than_parts(spark, n):
    assert parts(table(spark, range(n))) == [math.ceil(5 * (r + 1) / n) for r in range(n)]


def test_recency_score_is_inverted_after_ranking(spark):
    tied = spark.createDataFrame([(i, 10, 1, 1.0) for i in range(1, 6)], "customer_id long, recency_days long, frequency_365d long, monetary_365d double")
    rows = add_rfm_segments(tied).orderBy("customer_id").collect()
    assert [r["R_score"] for r in rows] == [5, 4, 3, 2, 1]
    assert [r["rfm_score"] for r in rows] == ["511", "422", "333", "244", "155"]


def test_segment_rules(spark):
    from revenue_lens.operators.rfm import OTHER_SEGMENT, SEGMENT_RULES

    cases = {(4, 4, 4): "champions", (4, 4, 1): "loyal", (3, 3, 1): "loyal", (5, 2, 5): "new_or_promising", (2, 3, 1): "at_risk", (2, 2, 5): "hibernating", (3, 2, 5): "other"}
    df = spark.createDataFrame(list(cases), "R_score int, F_score int, M_score int")
    label = F.lit(OTHER_SEGMENT)
    for name, rule in reversed(SEGMENT_RULES):
        label = F.when(F.expr(rule), name).otherwise(label)
    found = {tuple(r)[:3]: r["s"] for r in df.withColumn("s", label).collect()}
    assert found == cases


def test_cut_rows_inside_a_hot_value(spark):
    # Two thirds of the rows share one value, so most cuts fall among equal values.
    df = spark.range(9000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(4500)).cast("double").alias("v"), F.col("id").alias("k")
    ).repartition(7)
    ordered = sorted((r["v"], r["k"]) for r in df.collect())
    wanted = [0, 1, 2, 1500, 1501, 4499, 7499, 7500, 7501, 8999, 9000]
    found = rows_at_ranks(df, "g", "v", "k", lambda n: wanted)["g"]
    assert found[0] is None
    for rank, cut in zip(wanted[1:], found[1:]):
        value, key = cut
        at_or_before = [r for r in ordered if r[0] < value or (r[0] == value and (key is None or r[1] <= key))]
        assert at_or_before == ordered[:rank]


@pytest.mark.parametrize("kind", ["distinct", "tied", "mixed"])
def test_parts_against_sorting(spark, kind):
    value = {"distinct": lambda i: i * 7919 % 1009 + i / 1009, "tied": lambda i: 5, "mixed": lambda i: i * 31 % 17}[kind]
    df = table(spark, [value(i) for i in range(1009)])
    ordered = sorted((value(i), i + 1) for i in range(1009))
    expected = {key: math.ceil(5 * rank / 1009) for rank, (_, key) in enumerate(ordered, 1)}
    assert parts(df.repartition(5)) == [expected[i + 1] for i in range(1009)]


def test_an_approximation_that_misses_is_widened(spark, monkeypatch):
    original, tried = ranking._brackets, []

    def narrow(rows, sizes, ranks, slack):
        tried.append(slack)
        return {g: [(-5.0, -4.0)] for g in sizes} if slack == 1 else original(rows, sizes, ranks, slack)

    monkeypatch.setattr(ranking, "_brackets", narrow)
    assert parts(table(spark, range(100))) == [math.ceil(5 * (i + 1) / 100) for i in range(100)]
    assert tried == [1, 8]


def test_missing_values_are_not_scored(spark):
    df = table(spark, range(5)).unionByName(spark.createDataFrame([(9, None)], "customer_id long, v double"))
    assert parts(df) == [1, 2, 3, 4, 5, None]


def test_running_totals_over_blocks(spark, many_blocks):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), (F.col("id") * 37 % 500).cast("double").alias("v"), F.lit(2).alias("n"))
    rows = running_totals(df, "g", "v", ["n"]).collect()
    for g in (0, 1):
        mine = sorted((r["v"], r["cum_n"], r["all_n"]) for r in rows if r["g"] == g)
        assert [m[1] for m in mine] == [2 * (i + 1) for i in range(250)]
        assert {m[2] for m in mine} == {500}


def test_top_decile_size(spark):
    df = table(spark, [(i * 37) % 101 for i in range(105)]).withColumnRenamed("v", "churn_probability")
    top = top_risk_decile(df).collect()
    ranked = sorted(df.collect(), key=lambda r: (r["churn_probability"], r["customer_id"]))
    expected = {r["customer_id"] for i, r in enumerate(ranked, 1) if math.ceil(10 * i / 105) == 10}
    assert {r["customer_id"] for r in top} == expected


def test_empty_input(spark):
    assert parts(table(spark, [])) == []
