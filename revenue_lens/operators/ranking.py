"""Exact cut points and running totals without a single-task window or a global sort.

Cut points come from narrowing: an approximate quantile with a guaranteed rank error
brackets each wanted rank, one pass counts what lies between the brackets and, by value,
what lies inside them; only the values inside are ordered. Rows that share the cut value
are narrowed again by their unique key, so a value held by a third of all rows is no special
case. The ranked table itself is never shuffled.

Running totals range-partition rows that are one per value; positions are written down with
the rows, and what is left is a running sum over the partition sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.operators.storage import materialize


def _accuracy(size: int) -> int:
    """Rank error of the approximation is size / accuracy: about 100,000 rows at most."""
    return max(10_000, size // 100_000)


def _brackets(rows: DataFrame, sizes: dict, ranks: dict, slack: int) -> dict:
    """{group: [(low, high)]} around the wanted ranks; None is an open end."""
    spans = {g: [(None, None)] for g in sizes}
    asked = {g: n for g, n in sizes.items() if ranks[g]}
    if not asked:
        return spans
    accuracy = _accuracy(max(asked.values()))
    margin = slack * 3 / accuracy
    edges = {g: [(r / n - margin, r / n + margin) for r in ranks[g]] for g, n in asked.items()}
    shares = sorted({p for pairs in edges.values() for pair in pairs for p in pair if 0 < p < 1})
    if not shares:
        return spans
    # One row of quantiles per group.
    quantiles = rows.groupBy("group").agg(F.percentile_approx("x", [float(p) for p in shares], accuracy).alias("q"))
    found = {r["group"]: dict(zip(shares, r["q"])) for r in quantiles.collect()}
    for g, pairs in edges.items():
        spans[g] = [(found[g].get(low), found[g].get(high)) for low, high in pairs]
    return spans


def _at_ranks(rows: DataFrame, sizes: dict, ranks: dict) -> dict:
    """{(group, rank): (x, rows below it, rows equal to it)} for (group, x) ``rows``."""
    x, group, number = F.col("x"), F.col("group"), rows.schema["x"].dataType
    slack = 1
    while True:
        inside, lower_end = F.lit(False), [F.lit(None).cast(number)] * 2
        wanted = F.lit(None).cast("array<bigint>")
        for g, spans in _brackets(rows, sizes, ranks, slack).items():
            mine = group == g
            wanted = F.when(mine, F.array(*[F.lit(r).cast("bigint") for r in ranks[g]])).otherwise(wanted)
            for low, high in spans:
                above = F.lit(True) if low is None else x >= F.lit(low)
                below = F.lit(True) if high is None else x <= F.lit(high)
                inside = inside | (mine & above & below)
                if high is not None:
                    lower_end.append(F.when(mine & ~below, F.lit(high).cast(number)))
        # Rows outside the brackets are counted at the end of the last bracket below them.
        placed = rows.select("group", F.when(inside, x).otherwise(F.greatest(*lower_end)).alias("at"), (~inside).alias("outside"))
        counts = placed.groupBy("group", "at", "outside").agg(F.count(F.lit(1)).alias("n"))
        in_order = Window.partitionBy("group").orderBy(F.asc_nulls_first("at"), "outside")
        upto = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        hits = (
            counts.withColumn("upto", upto)
            .withColumn("rank", F.explode(F.filter(wanted, lambda r: (r > F.col("upto") - F.col("n")) & (r <= F.col("upto")))))
            .where("NOT outside")
            .collect()  # one row per wanted rank
        )
        found = {(h["group"], h["rank"]): (h["at"], h["upto"] - h["n"], h["n"]) for h in hits}
        if len(found) == sum(len(r) for r in ranks.values()):
            return found
        slack *= 8


def rows_at_ranks(df: DataFrame, group: str, value: str, key: str, ranks_of: Callable[[int], list[int]]) -> dict:
    """``{group: [(value, key), ...]}`` at the ranks ``ranks_of(group size)``, ordered by
    ``value`` and then by the unique numeric ``key``.

    The key is None where all rows of that value rank at or before the wanted one; the whole
    entry is None for a rank below 1. ``df`` is read a few times; pass a stored, narrow table
    with few groups. Missing values are not ranked.
    """
    rows = df.select(F.col(group).alias("group"), F.col(value).alias("x"), F.col(key).alias("key")).where("x IS NOT NULL")
    sizes = {r["group"]: r["n"] for r in rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranks = {g: sorted({r for r in ranks_of(n) if r >= 1}) for g, n in sizes.items()}
    if not any(ranks.values()):
        return {g: [None for _ in ranks_of(n)] for g, n in sizes.items()}
    hits = _at_ranks(rows.select("group", "x"), sizes, ranks)
    # Ranks that fall among equal values: the same search over the keys of those rows.
    cut_ties = {(g, x): n for (g, r), (x, before, n) in hits.items() if r - before < n}
    tie_number, sizes_of_ties, ranks_in_ties = F.lit(None).cast("int"), {}, {}
    for i, ((g, x), n) in enumerate(cut_ties.items()):
        tie_number = F.when((F.col("group") == g) & (F.col("x") == F.lit(x)), i).otherwise(tie_number)
        sizes_of_ties[i] = n
        ranks_in_ties[i] = sorted({r - before for (h, r), (v, before, _) in hits.items() if (h, v) == (g, x) and r - before < n})
    keys = {}
    if cut_ties:
        tied = rows.select(tie_number.alias("group"), F.col("key").alias("x")).where("group IS NOT NULL")
        keys = _at_ranks(tied, sizes_of_ties, ranks_in_ties)
    numbers = {gx: i for i, gx in enumerate(cut_ties)}

    def row_at(g, r):
        if r < 1:
            return None
        x, before, n = hits[g, r]
        return (x, keys[numbers[g, x], r - before][0]) if r - before < n else (x, None)

    return {g: [row_at(g, r) for r in ranks_of(n)] for g, n in sizes.items()}


def values_at_ranks(df: DataFrame, group: str, value: str, ranks_of: Callable[[int], list[int]]) -> dict:
    """``{group: (size, [value at each rank])}``; ranks from 1."""
    rows = df.select(F.col(group).alias("group"), F.col(value).alias("x")).where("x IS NOT NULL")
    sizes = {r["group"]: r["n"] for r in rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    hits = _at_ranks(rows, sizes, {g: sorted(set(ranks_of(n))) for g, n in sizes.items()})
    return {g: (n, [hits[g, r][0] for r in ranks_of(n)]) for g, n in sizes.items()}


def closing_ranks(size: int, parts: int) -> list[int]:
    """Last rank of parts 1..parts-1 when rank r of n belongs to part ceil(parts * r / n)."""
    return [j * size // parts for j in range(1, parts)]


def beyond(value: Column, key: Column, cut: tuple | None) -> Column:
    """Whether ``(value, key)`` ranks after the cut row; every row ranks after no row."""
    if cut is None:
        return value.isNotNull()
    cut_value, cut_key = cut
    later = value > F.lit(cut_value)
    return later if cut_key is None else later | ((value == F.lit(cut_value)) & (key > F.lit(cut_key)))


def part_of(value: Column, key: Column, cuts: list[tuple | None]) -> Column:
    """1 + the number of cuts that the row lies beyond: comparisons only, no join."""
    return sum((beyond(value, key, cut).cast("int") for cut in cuts), F.lit(1))


def _placed(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` range-partitioned by ``order``, with the partition number of each row (`_block`)."""
    return materialize(df.repartitionByRange(*order).select("*", F.spark_partition_id().alias("_block")))


def running_totals(df: DataFrame, group: str, order: str, sums: list[str]) -> DataFrame:
    """Add ``cum_<s>`` (up to and including the row) and ``all_<s>`` for each of ``sums``.

    ``df`` holds one row per (group, order) value: aggregate by value first, so that a
    frequent value is one row here.
    """
    placed = _placed(df, [group, order])
    blocks = placed.groupBy(group, "_block").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    per_group = Window.partitionBy(group)
    earlier = per_group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        group,
        "_block",
        *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_{s}").over(per_group).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy(group, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({f"_in_{s}": F.sum(s).over(inside) for s in sums})
        .join(F.broadcast(offsets), [group, "_block"])
        .withColumns({f"cum_{s}": F.col(f"_before_{s}") + F.col(f"_in_{s}") for s in sums})
        .drop("_block", *[f"_before_{s}" for s in sums], *[f"_in_{s}" for s in sums])
    )
