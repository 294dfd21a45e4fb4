"""Money as whole cents: sums of longs are several times faster than sums of wide decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A two-place decimal as a long."""
    return (amount * 100).cast("long")


def from_cents(amount: Column) -> Column:
    """Back to a decimal; exact."""
    return (amount.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(22,2)")
