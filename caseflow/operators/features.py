"""Time features, target and the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import numbers, times
from caseflow.schema import (
    CATEGORICAL, CREATED, KEY, LEAKING, NUMERIC, TARGET, TIME_FEATURES, present,
)


def with_time_features(df: DataFrame) -> DataFrame:
    """Hour, weekday (Monday = 0), month and weekend flag of the creation date.

    Rows without a creation date are dropped; a frame without the column passes unchanged.
    """
    if CREATED not in df.columns:
        return df
    ts = F.col(CREATED)
    if dict(df.dtypes)[CREATED] == "string":
        df = df.withColumn(CREATED, times.parse_utc(ts))
    return df.where(ts.isNotNull()).withColumns(
        {
            "created_hour": times.hour_of_day(ts),
            "created_dayofweek": times.day_of_week(ts),
            "created_month": times.month_of_year(ts),
            "created_is_weekend": times.is_weekend(ts),
        }
    )


def with_target(df: DataFrame, transform: str = "log1p", target: str = TARGET) -> DataFrame:
    """Add ``y`` to the rows that have a finite target; the others are dropped."""
    if target not in df.columns:
        raise KeyError(f"column missing from the interim table: {target}")
    hours = numbers.to_finite(F.col(target))
    return df.where(hours.isNotNull()).withColumn("y", numbers.transform_target(hours, transform))


def align_to_target(features: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Feature rows whose key has a target, when the two live in separate tables."""
    return features.join(target.select(key), key, "left_semi")


def feature_columns(columns: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """The categorical, numeric and time columns that exist, in the fixed order."""
    columns = list(columns)
    found = tuple(present(columns, c) for c in (CATEGORICAL, NUMERIC, TIME_FEATURES))
    guard_leakage([c for group in found for c in group])
    return found


def guard_leakage(names: Sequence[str]) -> None:
    """The close date and the target must never be features."""
    leaking = [c for c in LEAKING if c in names]
    if leaking:
        raise ValueError(f"leaking feature columns: {', '.join(leaking)}")


def feature_table(df: DataFrame, keep: Sequence[str] = (KEY,)) -> DataFrame:
    """Key columns, then categorical, numeric and time features; numbers are coerced."""
    categorical, numeric, time = feature_columns(df.columns)
    return df.select(
        *keep,
        *[F.col(c).cast("string").alias(c) for c in categorical],
        *[numbers.to_number(F.col(c)).alias(c) for c in numeric],
        *[F.col(c).cast("int").alias(c) for c in time],
    )
