"""Seeded pseudo-random numbers that depend on keys only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(seed: int, *keys: Column | str) -> Column:
    parts = [F.lit(str(seed)), *(F.lit(k) if isinstance(k, str) else k.cast("string") for k in keys)]
    return F.md5(F.concat_ws("|", *parts))


def _hex_slice(digest: Column, start: int, width: int) -> Column:
    return F.conv(F.substring(digest, start, width), 16, 10).cast("bigint")


def hash_uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform in (0, 1) from 52 bits of the digest of ``seed`` and ``keys``."""
    return (_hex_slice(_digest(seed, *keys), 1, 13) + F.lit(0.5)) / F.lit(float(2**52))


def hash_int(seed: int, *keys: Column | str, lane: int = 0) -> Column:
    """32-bit integer; lanes 0..3 read disjoint parts of one digest."""
    return _hex_slice(_digest(seed, *keys), 1 + 8 * lane, 8)
