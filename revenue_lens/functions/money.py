"""Money is summed as whole cents: exact, independent of row order, and a primitive long."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    return F.rint(amount * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return cents / F.lit(100.0)
