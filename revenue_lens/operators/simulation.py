"""Monte Carlo profit over all orders, or over a hash-ordered sample of them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.functions import hash_int, hash_uniform, to_cents
from revenue_lens.operators.storage import materialize
from revenue_lens.settings import SEED

# Log-normal cost ratio and its bounds.
COST_MU, COST_SIGMA = -0.45, 0.15
COST_LOW, COST_HIGH = 0.2, 0.95
DEFAULT_DRAWS = 5000

# Prime modulus of the pairwise-independent hash (2^31 - 1).
MODULUS = 2**31 - 1


def hash_sample(df: DataFrame, size: int | None, key: str, seed: int = SEED) -> DataFrame:
    """The ``size`` rows with the lowest hash of ``key``: the same rows on any cluster.

    A hash threshold first cuts the table down to little more than the sample, so that the
    final ordering does not see ``size`` rows of every partition.
    """
    u = hash_uniform(seed, F.col(key))
    total = df.count() if size is not None else 0
    if size is None or total <= size:
        return df.withColumn("_u", u)
    share = (size + 10 * math.sqrt(size) + 10) / total
    while True:
        sample = df.withColumn("_u", u).where(F.col("_u") < min(share, 1.0)).orderBy("_u", key).limit(size)
        stored = materialize(sample)
        if share >= 1.0 or stored.count() == size:
            return stored
        share *= 2


#: Draws of a run, which share the angles of their order, and values that are worked on at once (they stay in the cache of a core).
_RUN, _VALUES = 100, 40_000


def _profit_of_draws(revenue: np.ndarray, a1: np.ndarray, c1: np.ndarray, a2: np.ndarray, c2: np.ndarray, n_draws: int) -> np.ndarray:
    """Profit of some orders by draw.

    The uniforms of draw ``d`` are ``(x + 0.5) / p`` with ``x = (a * d + c) mod p``, a family that is pairwise independent over the
    draws and independent over the orders. With ``d = i + j``, ``i`` the first draw of a run, ``x`` is the sum of two remainders,
    less ``p`` where it reaches it, and the cosine of the angle of the second uniform follows from those of ``i`` and ``j``.
    """
    run = min(_RUN, n_draws)
    firsts, steps = np.arange(0, n_draws, run), np.arange(run)
    spread, median = COST_SIGMA * math.sqrt(2), math.exp(COST_MU)
    low, high = math.log(COST_LOW) - COST_MU, math.log(COST_HIGH) - COST_MU
    at = lambda a, c, d: (a[:, None] * d + c[:, None]) % MODULUS
    finite = np.isfinite(revenue)
    costs, known = np.zeros(n_draws), np.where(finite, revenue, 0.0)
    size = max(1, _VALUES // n_draws)
    buffers = np.empty((2, min(size, len(revenue)), len(firsts), run))
    for first in range(0, len(revenue), size):
        own = slice(first, min(first + size, len(revenue)))
        x, less = buffers[:, : own.stop - first]
        np.add((at(a1[own], c1[own], firsts) + 0.5)[:, :, None], at(a1[own], 0 * c1[own], steps).astype(np.float64)[:, None, :], out=x)
        np.subtract(x, MODULUS, out=less)
        # As unsigned numbers the negative ones are the largest.
        np.minimum(x.view(np.uint64), less.view(np.uint64), out=x.view(np.uint64))
        angle, turn = (at(a2[own], c2[own], firsts) + 0.5) * (2 * math.pi / MODULUS), at(a2[own], 0 * c2[own], steps) * (2 * math.pi / MODULUS)
        cosine = np.matmul(np.stack([np.cos(angle) * spread, np.sin(angle) * -spread], axis=2), np.stack([np.cos(turn), np.sin(turn)], axis=1), out=less)
        np.log(x, out=x)
        np.subtract(math.log(MODULUS), x, out=x)
        np.sqrt(x, out=x)
        np.multiply(x, cosine, out=x)
        np.clip(x, low, high, out=x)
        np.exp(x, out=x)
        costs += (known[own] @ x.reshape(len(x), -1))[:n_draws]
    return known.sum() - costs * median + revenue[~finite].sum()


def simulate_draws(sample: DataFrame, key: str, n_draws: int = DEFAULT_DRAWS, seed: int = SEED) -> DataFrame:
    """Total profit of ``sample`` per draw.

    One digest per order seeds all its draws. Each partition adds up its orders by draw in arrays of bounded size, so the shuffle
    carries at most ``n_draws`` rows per partition. Orders without a revenue count, but add nothing.
    """
    names = ("a1", "c1", "a2", "c2")
    seeds = {name: (hash_int(seed, "order", F.col(key), lane=lane) % MODULUS).alias(name) for lane, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, orders, known = np.zeros(n_draws), 0, 0
        for batch in batches:
            orders += batch.num_rows
            batch = batch.filter(batch["revenue"].is_valid())
            known += batch.num_rows
            total += _profit_of_draws(*[batch[c].to_numpy() for c in ("revenue", *names)], n_draws)
        if orders:
            columns = [np.arange(n_draws, dtype=np.int32), pa.array(total if known else [None] * n_draws, pa.float64()), np.full(n_draws, orders)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["draw", "total_profit", "orders"])

    each = sample.select(F.col("revenue").cast("double").alias("revenue"), *seeds.values())
    parts = each.mapInArrow(run, "draw int, total_profit double, orders bigint")
    return parts.groupBy("draw").agg(F.sum("total_profit").alias("total_profit"), F.sum("orders").alias("orders"))


def profit_summary(draws: DataFrame) -> DataFrame:
    """Mean, 5/50/95 percentiles and population deviation over the draws (one value per draw)."""
    cuts = F.percentile("total_profit", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return draws.agg(
        F.max("orders").alias("n_orders_in_sim"),
        F.count(F.lit(1)).alias("n_draws"),
        F.avg("total_profit").alias("mean_total_profit"),
        cuts.alias("_q"),
        F.stddev_pop("total_profit").alias("std"),
    ).select(
        "n_orders_in_sim",
        "n_draws",
        "mean_total_profit",
        F.col("_q")[0].alias("p5"),
        F.col("_q")[1].alias("p50"),
        F.col("_q")[2].alias("p95"),
        "std",
    )


def _total_revenue(orders: DataFrame) -> float:
    # DECIMAL: the cents of a whole company need not fit a long.
    return float(orders.agg(F.coalesce(F.sum(to_cents(F.col("revenue")).cast("decimal(20,0)")), F.lit(0))).first()[0]) / 100


def monte_carlo_profit(
    orders: DataFrame,
    key: str,
    n_draws: int = DEFAULT_DRAWS,
    n_orders: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Simulated profit of all orders (or of ``n_orders`` sampled ones) with two margins.

    ``margin_reference`` divides the profit of the simulated orders by the revenue of all
    orders; ``margin_sim`` by the revenue of the simulated ones. Both are NULL without revenue.
    """
    spark = orders.sparkSession
    sample = hash_sample(orders.select(key, "revenue"), n_orders, key, seed)
    total = _total_revenue(orders)
    simulated = total if n_orders is None else _total_revenue(sample)
    # Each row stands for n_draws values: spread the narrow rows first, however few files hold them.
    parts = max(spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    profit = F.col("mean_total_profit")
    return profit_summary(simulate_draws(sample.repartition(parts, key), key, n_draws, seed)).withColumns(
        {"margin_reference": F.try_divide(profit, F.lit(total)), "margin_sim": F.try_divide(profit, F.lit(simulated))}
    )
