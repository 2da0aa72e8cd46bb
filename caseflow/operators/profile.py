"""Profiles of data, folds and errors: the numbers behind the usual reports and charts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions import text
from caseflow.operators import encode, evaluate, folds, quantiles
from caseflow.schema import N_SPLITS

BINS = 60
DIGITS = 9  # values are binned at this precision
HEAD_NAMES = 40
TOP_TYPES = 12
CLIP_SHARE = 0.99


def target_profile(df: DataFrame, y: str = "y") -> DataFrame:
    """Count, min, mean, median, max and population standard deviation in one row."""
    median = quantiles.exact_quantiles(df, y, [0.5]).select("quantile").scalar()
    stats = df.agg(
        F.count(y).alias("n"), F.min(y).alias("min"), F.avg(y).alias("mean"),
        F.max(y).alias("max"), F.stddev_pop(y).alias("std"),
    )
    return stats.select("n", "min", "mean", median.alias("median"), "max", "std")


def dataset_summary(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """Row count, and number and list of columns per kind: ``(item, count, names)``."""
    kinds = [
        F.struct(
            F.lit(kind).alias("item"), F.lit(len(names)).cast("long").alias("count"),
            F.lit(", ".join(names)).alias("names"),
        )
        for kind, names in columns.items()
    ]
    rows = F.struct(
        F.lit("rows").alias("item"), F.col("n").alias("count"),
        F.lit(None).cast("string").alias("names"),
    )
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(rows, *kinds)))


def fold_widths(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], n_splits: int = N_SPLITS
) -> DataFrame:
    """``(fold, n_train, n_test, width)``: encoded columns when fitted on the train rows."""
    levels = (
        encode.value_counts(df, categorical, n_splits)
        .groupBy(F.col("split").alias("fold"))
        .agg(F.count(F.lit(1)).alias("_levels"))
    )
    width = F.coalesce("_levels", F.lit(0)) + len(numeric)
    return (
        folds.fold_sizes(df)
        .join(levels, "fold", "left")
        .select("fold", "n_train", "n_test", width.alias("width"))
    )


def feature_names(
    df: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    split: int = 0,
    head: int = HEAD_NAMES,
) -> DataFrame:
    """``(position, name)`` of the first encoded columns of one split."""
    per_level = (
        encode.melt(folds.train_rows(df, split), [], categorical, "string")
        .where(F.col("value").isNotNull())
        .distinct()
        .select(
            F.array_position(F.array(*[F.lit(c) for c in categorical]), F.col("feature")).alias(
                "block"
            ),
            F.col("value").alias("level"),
            F.concat(F.lit("cat__"), "feature", F.lit("_"), "value").alias("name"),
        )
    )
    numbers = F.array(
        *[
            F.struct(
                F.lit(len(categorical) + i + 1).cast("long").alias("block"),
                F.lit("").alias("level"), F.lit(f"num__{c}").alias("name"),
            )
            for i, c in enumerate(numeric)
        ]
    )
    named = per_level.unionByName(df.sparkSession.range(1).select(F.inline(numbers)))
    first = named.orderBy("block", "level").limit(head)
    order = Window.orderBy("block", "level")  # at most ``head`` rows
    return first.select((F.row_number().over(order) - 1).alias("position"), "name")


class Span(NamedTuple):
    lo: float
    hi: float


def value_range(df: DataFrame, columns: Sequence[str]) -> Span | None:
    """Lowest and highest value over the columns; a single point is widened by one half on
    each side. ``None`` without any value."""
    ends = [F.min(c).alias(f"{c}_lo") for c in columns] + [
        F.max(c).alias(f"{c}_hi") for c in columns
    ]
    found = [v for v in df.agg(*ends).first() if v is not None]
    if not found:
        return None
    lo, hi = min(found), max(found)
    return Span(lo, hi) if lo < hi else Span(lo - 0.5, hi + 0.5)


def bin_of(value: Column, span: Span | None, bins: int) -> Column:
    """Equal-width bin 0 .. bins-1; the highest value belongs to the last bin."""
    if span is None:
        return F.lit(None).cast("int")
    share = (value - F.lit(span.lo)) / F.lit(span.hi - span.lo)
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, value: Column, bins: int = BINS) -> DataFrame:
    """``(bin, lower, upper, n)`` for all bins, empty ones included.

    One pass for the range, one for the counts; the counts are combined on the map side.
    """
    values = df.select(F.round(value, DIGITS).alias("v")).where(F.col("v").isNotNull())
    span = value_range(values, ["v"])
    counts = values.groupBy(bin_of(F.col("v"), span, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    lo, width = (span.lo, (span.hi - span.lo) / bins) if span else (None, None)
    lower, step = F.lit(lo).cast("double"), F.lit(width).cast("double")
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(counts, "bin", "left").select(
        "bin",
        (lower + F.col("bin") * step).alias("lower"),
        (lower + (F.col("bin") + 1) * step).alias("upper"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def target_hist(df: DataFrame, y: str = "y") -> DataFrame:
    return histogram(df, F.col(y))


def hours_hist_clipped(df: DataFrame, y: str = "y", share: float = CLIP_SHARE) -> DataFrame:
    """Histogram of hours (log scale undone), clipped to [0, exact quantile]."""
    hours = df.select(F.round(F.expm1(F.col(y)), DIGITS).alias("h"))
    top = quantiles.quantile_values(hours, "h", [share])[0]
    return histogram(hours, F.least(F.greatest(F.col("h"), F.lit(0.0)), F.lit(top)))


def residual_hist(preds: DataFrame) -> DataFrame:
    return histogram(preds, F.col("y_pred") - F.col("y_true"))


def pred_vs_true_grid(preds: DataFrame, bins: int = BINS) -> DataFrame:
    """Predicted against actual as counts on a square grid over the common range."""
    pairs = preds.select(
        F.round("y_true", DIGITS).alias("t"), F.round("y_pred", DIGITS).alias("p")
    )
    span = value_range(pairs, ["t", "p"])
    lo, hi = span if span else (0.0, 0.0)  # no rows, no cells
    return (
        pairs.groupBy(
            bin_of(F.col("t"), span, bins).alias("true_bin"),
            bin_of(F.col("p"), span, bins).alias("pred_bin"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .select("true_bin", "pred_bin", "n", F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    )


def abs_error_by_target(preds: DataFrame, bins: int = BINS) -> DataFrame:
    """``(bin, n, mean_abs_error, max_abs_error)`` along the target."""
    rows = preds.select(
        F.round("y_true", DIGITS).alias("t"),
        F.abs(F.col("y_pred") - F.col("y_true")).alias("e"),
    )
    span = value_range(rows, ["t"])
    return rows.groupBy(bin_of(F.col("t"), span, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("e").alias("mean_abs_error"),
        F.max("e").alias("max_abs_error"),
    )


def best_from_results(results: DataFrame) -> DataFrame:
    """``(model, config_id)`` of the best run in a stored result table.

    The flag may be boolean or text; without a flagged row the lowest mean RMSE decides.
    """
    flagged = F.lower(F.col("is_best").cast("string")).isin("true", "1")
    order = Window.partitionBy("model").orderBy(
        F.coalesce(flagged, F.lit(False)).desc(), F.col("rmse_mean").asc_nulls_last(), "config_id"
    )
    return (
        results.where(F.col("row_type") == "summary")
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") == 1)
        .select("model", "config_id")
    )


def best_fold_series(results: DataFrame) -> DataFrame:
    """MAE and RMSE by fold of the best configuration."""
    best = best_from_results(results)
    return (
        results.where(F.col("row_type") == "fold")
        .join(F.broadcast(best), ["model", "config_id"], "left_semi")  # one row per model
        .select("model", "config_id", "fold", "mae", "rmse")
        .orderBy("model", "fold")
    )


def config_ranking(results: DataFrame) -> DataFrame:
    """Configurations by mean RMSE, the best one marked."""
    summary = results.where(F.col("row_type") == "summary").select(
        "model", "tag", "config_id", "mae_mean", "rmse_mean"
    )
    order = Window.partitionBy("model").orderBy(F.col("rmse_mean").asc_nulls_last(), "config_id")
    best = best_from_results(results).select("model", F.col("config_id").alias("_best"))
    return (
        summary.withColumn("place", F.row_number().over(order))
        .join(F.broadcast(best), "model", "left")  # one row per model
        .select(
            "model", "place", "config_id", "rmse_mean",
            (F.col("config_id") == F.col("_best")).alias("is_best"),
        )
    )


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)``; missing values count as a category of their own."""
    return df.groupBy(text.text_category(F.col(column)).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def top_categories(df: DataFrame, column: str, n: int = TOP_TYPES) -> DataFrame:
    return category_counts(df, column).orderBy(F.desc("n"), "value").limit(n)


def mean_target_by(df: DataFrame, column: str, y: str = "y") -> DataFrame:
    """``(value, n, mean_y)``, highest mean first."""
    return (
        df.groupBy(text.text_category(F.col(column)).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_y"))
        .orderBy(F.desc("mean_y"), "value")
    )


def results_from(preds: DataFrame, params: Sequence[str]) -> DataFrame:
    """Predictions to the stored result table."""
    fold_rows = evaluate.fold_results(preds, params)
    return evaluate.stack_results(fold_rows, evaluate.summarise(fold_rows, params))
