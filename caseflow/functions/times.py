"""Date expressions (session zone UTC)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_utc(col: Column, formats: Sequence[str] = ()) -> Column:
    """ISO text, then each extra format in turn; unparseable text becomes null."""
    text = col.cast("string")
    attempts = [F.try_to_timestamp(text)]
    attempts += [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*attempts)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3.6e9)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def month_of_year(ts: Column) -> Column:
    return F.month(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def cyclic(col: Column, period: int) -> tuple[Column, Column]:
    """Position on a circle of ``period`` steps, as (sine, cosine)."""
    angle = 2 * F.pi() * col / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
