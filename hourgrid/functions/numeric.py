"""Null- and NaN-safe numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(column: Column | str) -> Column:
    """Missing (NULL or NaN) becomes 0.0."""
    column = (F.col(column) if isinstance(column, str) else column).cast("double")
    zero = F.lit(0.0)
    return F.coalesce(F.nanvl(column, zero), zero)


def as_flag(column: Column | str) -> Column:
    """Boolean, number or text ('1', 'true') to INT; anything else gives NULL."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(text.try_cast("int"), text.try_cast("boolean").cast("int"))
