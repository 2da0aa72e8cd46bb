"""Snapshot -> interim table -> processed bundle, with a written table between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.operators import clean, features, folds, sampling
from caseflow.schema import KEY, N_SPLITS, SEED, STRAT_BINS
from caseflow.session import materialise, use_utc


def build_interim(
    raw: DataFrame,
    outlier_mode: str = "percentile",
    outlier_value: float | None = None,
    keep: Sequence[str] = (),
    formats: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and the row-count funnel.

    The deduplicated rows are written once: the outlier quantile, the cut and the funnel all
    read them, and none of them repeats the dedup shuffle.
    """
    use_utc(raw.sparkSession)
    unique = materialise(clean.last_ordered(raw, formats), "unique")
    valid = clean.keep_valid_target(unique)
    interim = clean.cut_outliers(clean.keep_columns(valid, keep), outlier_mode, outlier_value)
    return interim, clean.funnel(raw, unique, outlier_mode, outlier_value, formats)


def build_interim_live(
    raw: DataFrame, outlier_mode: str = "percentile", outlier_value: float | None = None,
    formats: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """As ``build_interim``, with a funnel that is counted while the two tables are written."""
    spark = use_utc(raw.sparkSession)
    live = clean.LiveFunnel()
    unique = materialise(live.unique(raw, formats), "unique")
    cut = clean.cut_outliers(clean.keep_valid_target(unique), outlier_mode, outlier_value)
    interim = materialise(live.kept(cut), "interim")
    return interim, live.counts(spark)


def with_features_and_target(
    interim: DataFrame, transform: str = "log1p", max_rows: int = 0, seed: int = SEED
) -> DataFrame:
    """Key, features and ``y`` on one row; nothing is aligned by position."""
    dated = features.with_time_features(interim)
    sampled = sampling.seeded_sample(dated, max_rows, KEY, seed)
    table = features.feature_table(
        features.with_target(sampled, transform), keep=[KEY, "y"]
    )
    return table.select(*[c for c in table.columns if c != "y"], "y")


def build_bundle(
    interim: DataFrame,
    transform: str = "log1p",
    n_splits: int = N_SPLITS,
    n_bins: int = STRAT_BINS,
    max_rows: int = 0,
    seed: int = SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Features, ``y``, ``y_bin`` and ``fold``, written by fold. With ``columns``, only these features
    are moved and written beside the key.

    ``interim`` is read for the edges of the bins, for the sizes of the folds' ranges and for the
    rows, the first two times in a few columns: pass a written table or a filter on one.
    """
    use_utc(interim.sparkSession)
    table = with_features_and_target(interim, transform, max_rows, seed)
    if columns is not None:
        table = table.select(KEY, *[c for c in table.columns if c in columns], "y")
    dealt = folds.stratified_folds(folds.quantile_bins(table, n_bins), n_splits, seed)
    return materialise(dealt, "bundle", partition_by=["fold"])


def show_times(df: DataFrame) -> DataFrame:
    """Timestamps as UTC text, doubles to six digits: the form results are compared in."""
    shown = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "timestamp":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "double":
            c = F.round(c, 6)
        shown.append(c.alias(name))
    return df.select(*shown)
