"""Numeric coercion and target transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRANSFORMS = ("none", "log1p")


def to_number(col: Column) -> Column:
    """Text to double; unparseable text and NaN become null."""
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_finite(col: Column) -> Column:
    """As ``to_number``, and infinities become null too."""
    number = to_number(col)
    return F.when(F.abs(number) != F.lit(float("inf")), number)


def transform_target(col: Column, transform: str) -> Column:
    if transform == "none":
        return col
    if transform == "log1p":
        return F.log1p(F.greatest(col, F.lit(0.0)))
    raise ValueError(f"unknown target transform: {transform!r} (use one of {TRANSFORMS})")
