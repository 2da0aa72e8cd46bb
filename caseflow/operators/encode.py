"""Per-fold fitted preprocessing.

``fit_*`` functions read a table with a ``fold`` column and return small tables of fitted
values with a ``split`` column: split ``i`` is fitted on all folds but ``i``. The data is
aggregated once by fold; the train statistics of every split are put together from those
per-fold pieces. The apply functions encode each row with the split that leaves its own fold
out, so no row is encoded with statistics it contributed to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions import text, times
from caseflow.operators import lookup, quantiles, sampling
from caseflow.operators.folds import other_folds
from caseflow.schema import KEY, N_SPLITS

SMOOTHING = 15.0

# The columns of the boosting design matrix.
TARGET_ENCODED = [
    "complaint_type", "descriptor", "location_type", "community_board", "police_precinct",
    "incident_zip", "council_district",
]
DUMMIES = ["agency", "borough", "created_month"]
CYCLES = {"created_hour": ("hour", 24), "created_dayofweek": ("day", 7)}


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], dtype: str) -> DataFrame:
    """``(ids..., feature, value)``: one row per column, all cast to ``dtype``."""
    ids, columns = list(ids), list(columns)
    cast = df.select(*ids, *[F.col(c).cast(dtype).alias(c) for c in columns])
    return cast.unpivot(ids, columns, "feature", "value")


def _position(columns: Sequence[str]) -> Column:
    """Place of ``feature`` in a column list."""
    return F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))


def value_counts(df: DataFrame, columns: Sequence[str], n_splits: int | None) -> DataFrame:
    """``(split, feature, value, n)`` of the non-null train values."""
    per_fold = (
        melt(df, ["fold"], columns, "string")
        .where(F.col("value").isNotNull())
        .groupBy("fold", "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        other_folds(per_fold, n_splits)
        .groupBy("split", "feature", "value")
        .agg(F.sum("n").alias("n"))
    )


def fit_modes(
    df: DataFrame, columns: Sequence[str], n_splits: int | None = N_SPLITS, counts: DataFrame | None = None
) -> DataFrame:
    """``(split, feature, mode)``: most frequent train value, the smallest one on ties. ``counts``
    are the ``value_counts`` of the same columns and splits, if they are already written."""
    first = Window.partitionBy("split", "feature").orderBy(F.desc("n"), F.asc("value"))
    return (
        (counts if counts is not None else value_counts(df, columns, n_splits))
        .withColumn("_nth", F.row_number().over(first))
        .where(F.col("_nth") == 1)
        .select("split", "feature", F.col("value").alias("mode"))
    )


def fit_levels(
    df: DataFrame, columns: Sequence[str], n_splits: int | None = N_SPLITS, counts: DataFrame | None = None
) -> DataFrame:
    """``(split, feature, level, slot, n)``: train vocabulary in sorted order (numbers by value).

    ``slot`` is the 0-based column of the level in the encoded matrix, feature after feature;
    ``n`` is how often the level occurs in train. Missing values are filled with a train value
    before encoding, so they add no level. Levels are numbered in ranges of the order, so a
    vocabulary may be of any size. ``counts`` as for ``fit_modes``.
    """
    numbers = [c for c, kind in df.dtypes if kind != "string"]
    by_value = F.when(F.col("feature").isin(numbers), F.col("value").try_cast("double"))
    if counts is None:
        counts = value_counts(df, columns, n_splits)
    placed = counts.withColumns({"_place": _position(columns), "_value": by_value})
    ranked = sampling.range_rank(placed, ["split", "_place", "_value", "value"])
    first = ranked.groupBy("split").agg(F.min("position").alias("_first"))
    return ranked.join(F.broadcast(first), "split").select(  # one row per split
        "split", "feature", F.col("value").alias("level"),
        (F.col("position") - F.col("_first")).cast("int").alias("slot"), "n",
    )


def fit_medians(df: DataFrame, columns: Sequence[str], n_splits: int | None = N_SPLITS) -> DataFrame:
    """``(split, feature, median)``: exact interpolated train median."""
    per_fold = (
        melt(df, ["fold"], columns, "double")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("fold", "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    medians = quantiles.exact_quantiles(
        other_folds(per_fold, n_splits), "value", [0.5], by=["split", "feature"], weight="n"
    )
    return medians.select("split", "feature", F.col("quantile").alias("median"))


def fit_scaling(
    df: DataFrame, columns: Sequence[str], medians: DataFrame, n_splits: int | None = N_SPLITS
) -> DataFrame:
    """``(split, feature, mean, scale)`` of the median-filled train values.

    Population standard deviation; a constant column is scaled by 1. Per-fold means and
    squared deviations are combined around the common mean, which stays accurate where
    subtracting sums of squares would not.
    """
    value = F.col("value")
    per_fold = (
        melt(df, ["fold"], columns, "double")
        .groupBy("fold", "feature")
        .agg(
            F.count(value).alias("n"),
            F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
            F.coalesce(F.var_pop(value), F.lit(0.0)).alias("var"),
            F.count_if(value.isNull()).alias("n_null"),
        )
    )
    train = other_folds(per_fold, n_splits).join(
        F.broadcast(medians), ["split", "feature"]  # one row per split and column
    )
    group = Window.partitionBy("split", "feature")
    weighted = F.col("n") * F.col("mean") + F.col("n_null") * F.col("median")
    centre = F.sum(weighted).over(group) / F.sum(F.col("n") + F.col("n_null")).over(group)
    piece = (
        F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("centre"), F.lit(2.0)))
        + F.col("n_null") * F.pow(F.col("median") - F.col("centre"), F.lit(2.0))
    )
    spread = F.sqrt(F.sum(piece) / F.sum(F.col("n") + F.col("n_null")))
    return (
        train.withColumn("centre", centre)
        .groupBy("split", "feature")
        .agg(F.first("centre").alias("mean"), spread.alias("_std"))
        .select(
            "split", "feature", "mean",
            F.when(F.col("_std") > F.abs("mean") * 1e-12, F.col("_std"))
            .otherwise(F.lit(1.0))
            .alias("scale"),
        )
    )


def fit_target_means(
    df: DataFrame,
    columns: Sequence[str],
    smoothing: float = SMOOTHING,
    n_splits: int | None = N_SPLITS,
    y: str = "y",
) -> DataFrame:
    """``(split, feature, level, encoded, n)``: train mean of ``y`` per category, drawn towards
    the train mean by ``smoothing`` pseudo-rows, and the category's train rows. The row whose
    level is null holds the train mean itself, which is what unseen categories get.
    """
    cats = df.select("fold", F.col(y).alias("_y"), *[text.text_category(F.col(c)).alias(c)
                                                     for c in columns])
    per_fold = (
        cats.unpivot(["fold", "_y"], list(columns), "feature", "level")
        .groupBy("fold", "feature", "level")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("total"))
    )
    train = (
        other_folds(per_fold, n_splits)
        .groupBy("split", "feature", "level")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    overall = train.groupBy("split", "feature").agg(
        (F.sum("total") / F.sum("n")).alias("overall")
    )
    encoded = (F.col("total") + F.col("overall") * smoothing) / (F.col("n") + smoothing)
    return (
        train.join(F.broadcast(overall), ["split", "feature"])  # one row per split and column
        .select("split", "feature", "level", encoded.alias("encoded"), "n")
        .unionByName(
            overall.select(
                "split", "feature",
                F.lit(None).cast("string").alias("level"),
                F.col("overall").alias("encoded"),
                F.lit(0).cast("long").alias("n"),
            )
        )
    )


def by_split(stats: DataFrame, value: str, columns: Sequence[str], suffix: str) -> DataFrame:
    """One row per fold with a column per feature: the fitted values its rows are to use."""
    wide = stats.groupBy("split").pivot("feature", list(columns)).agg(F.first(value))
    return wide.select(
        F.col("split").alias("fold"), *[F.col(c).alias(f"{c}{suffix}") for c in columns]
    )


def impute_modes(df: DataFrame, modes: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = by_split(modes, "mode", columns, "_mode")
    filled = {c: F.coalesce(F.col(c), F.col(f"{c}_mode")) for c in columns}
    return (
        df.join(F.broadcast(wide), "fold", "left")  # one row per fold
        .withColumns(filled)
        .drop(*[f"{c}_mode" for c in columns])
    )


def impute_medians(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = by_split(medians, "median", columns, "_median")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}_median")) for c in columns}
    return (
        df.join(F.broadcast(wide), "fold", "left")  # one row per fold
        .withColumns(filled)
        .drop(*[f"{c}_median" for c in columns])
    )


def standardise(
    df: DataFrame, medians: DataFrame, scaling: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Fill with the train median, then centre and scale with the train moments."""
    means = by_split(scaling, "mean", columns, "_mean")
    scales = by_split(scaling, "scale", columns, "_scale")
    filled = impute_medians(df, medians, columns)
    scaled = {c: (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_scale") for c in columns}
    return (
        filled.join(F.broadcast(means), "fold", "left")  # one row per fold
        .join(F.broadcast(scales), "fold", "left")  # one row per fold
        .withColumns(scaled)
        .drop(*[f"{c}{s}" for c in columns for s in ("_mean", "_scale")])
    )


def one_hot(
    df: DataFrame, levels: DataFrame, columns: Sequence[str], key: str = KEY
) -> DataFrame:
    """The ones of the encoded matrix: ``(key, fold, feature, level, slot)``.

    A missing or unseen category has no row. Pass ``levels`` as a written table.
    """
    known = levels.select(F.col("split").alias("fold"), "feature",
                          F.col("level").alias("value"), "slot", "n")
    long = melt(df, [key, "fold"], columns, "string").where(F.col("value").isNotNull())
    on = ["fold", "feature", "value"]
    if lookup.fits_broadcast(known):
        met = long.join(F.broadcast(known), on)
    else:
        met = lookup.attach_counted(long, known, on, "n")
    return (
        met.where(F.col("slot").isNotNull())
        .select(key, "fold", "feature", F.col("value").alias("level"), "slot")
    )


def with_slots(df: DataFrame, levels: DataFrame, columns: Sequence[str], name: str = "slots") -> DataFrame:
    """Add the array of a row's slots, rising, in the matrix of one split; rows do not move.

    A missing or unseen category has no slot. Each column's levels are broadcast: ``levels`` must be
    of one split, and fit (see ``lookup.fits_broadcast``).
    """
    out = df
    for i, c in enumerate(columns):
        own = levels.where(F.col("feature") == c).select(F.col("level").alias("_level"), F.col("slot").alias(f"_slot_{i}"))
        out = out.withColumn("_level", F.col(c).cast("string")).join(F.broadcast(own), "_level", "left").drop("_level")
    slots = [f"_slot_{i}" for i in range(len(columns))]
    return out.withColumn(name, F.array_compact(F.array(*slots))).drop(*slots)


def target_encode(
    df: DataFrame,
    means: DataFrame,
    columns: Sequence[str],
    key: str = KEY,
    split: int | None = None,
) -> DataFrame:
    """Replace categories by their smoothed train mean; unseen ones by the train mean.

    Every row uses the split that leaves its fold out, or the one given. Pass ``means`` as a
    written table.
    """
    if split is None:
        means = means.withColumnRenamed("split", "fold")
        on = ["fold", "_level"]
        overall = by_split(
            means.where(F.col("level").isNull()).withColumnRenamed("fold", "split"),
            "encoded", columns, "_overall",
        )
        out = df.join(F.broadcast(overall), "fold", "left")  # one row per fold
    else:
        means = means.where(F.col("split") == split).drop("split")
        on = ["_level"]
        fallback = fitted_values(means.where(F.col("level").isNull()), "encoded")
        out = df.withColumns({f"{c}_overall": F.lit(fallback[c]) for c in columns})
    known = means.where(F.col("level").isNotNull()).withColumnRenamed("level", "_level")
    if lookup.fits_broadcast(known):
        for c in columns:
            one = known.where(F.col("feature") == c).select(
                *on, F.col("encoded").alias(f"{c}_encoded")
            )
            out = out.withColumn("_level", text.text_category(F.col(c)))
            out = out.join(F.broadcast(one), on, "left").drop("_level")
    else:
        out = out.join(_encoded_by_key(df, known, columns, key, on), key, "left")
    encoded = {c: F.coalesce(F.col(f"{c}_encoded"), F.col(f"{c}_overall")) for c in columns}
    return out.withColumns(encoded).drop(
        *[f"{c}{s}" for c in columns for s in ("_encoded", "_overall")]
    )


def _encoded_by_key(
    df: DataFrame, known: DataFrame, columns: Sequence[str], key: str, on: Sequence[str]
) -> DataFrame:
    """``(key, column_encoded...)``: all columns in long form, so that one join serves them all."""
    ids = [key, "fold"] if "fold" in on else [key]
    cats = df.select(*ids, *[text.text_category(F.col(c)).alias(c) for c in columns])
    long = cats.unpivot(ids, list(columns), "feature", "_level")
    met = lookup.attach_counted(long, known, [*on, "feature"], "n")
    return met.groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("encoded"))).alias(f"{c}_encoded") for c in columns]
    )


def fitted_values(stats: DataFrame, value: str) -> dict:
    """Fitted values of one split by feature: one number or text per column."""
    return {r["feature"]: r[value] for r in stats.select("feature", value).collect()}


def cyclic_encode(df: DataFrame) -> DataFrame:
    """Replace hour and weekday by sine and cosine."""
    for column, (name, period) in CYCLES.items():
        if column in df.columns:
            sine, cosine = times.cyclic(F.col(column), period)
            df = df.withColumns({f"{name}_sin": sine, f"{name}_cos": cosine}).drop(column)
    return df


def numeric_only(df: DataFrame, keep: Sequence[str] = (KEY,)) -> DataFrame:
    """Numeric and boolean columns with nulls (and NaN) as 0; ``keep`` columns pass as they are."""
    numeric = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in keep
    ]
    booleans = [c for c in numeric if dict(df.dtypes)[c] == "boolean"]
    cast = {c: F.col(c).cast("int") for c in booleans}
    return df.select(*keep, *numeric).withColumns(cast).na.fill(0, numeric)
