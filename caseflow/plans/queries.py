"""Query registry: one function per query, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import clean, encode, evaluate, features, folds, profile, sampling
from caseflow.plans import pipeline
from caseflow.plans.pipeline import show_times, with_features_and_target
from caseflow.plans.stages import BASELINE_COLUMN, RAW_WITH_ARRIVAL, TAG, Stages
from caseflow.schema import (
    CATEGORICAL, CLOSED, CREATED, KEY, N_SPLITS, NUMERIC, RAW_COLUMNS, SEED, TARGET, TIME_FEATURES,
)
from caseflow.session import new_path
from caseflow.sources import snapshots, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SAMPLE_ROWS = 500
SOURCE_ROWS = 1000


Make = Callable[[Stages], DataFrame]


def query(make: Make, reads: Sequence[str] | None = None) -> Make:
    """Register a function of the stage tables under its own name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return show_times(make(Stages(spark, sf_dir, reads)))

    QUERIES[make.__name__] = run
    return make


def query_on(*reads: str) -> Callable[[Make], Make]:
    """As ``query``, of one that reads no features but these: the stage tables store no others."""
    return lambda make: query(make, reads)


# ---- sources ------------------------------------------------------------------------------

@query
def scan_pages(s: Stages) -> DataFrame:
    return snapshots.scan_pages(s.spark, s.pages(), RAW_WITH_ARRIVAL).drop("page")


@query
def source_select(s: Stages) -> DataFrame:
    return snapshots.select_tickets(s.raw(), RAW_COLUMNS)


@query
def source_where(s: Stages) -> DataFrame:
    since = "created_date >= '2000-01-01T00:00:00.000' and borough = 'ASIA'"
    return snapshots.select_tickets(s.raw(), RAW_WITH_ARRIVAL, where=since)


@query
def source_limit(s: Stages) -> DataFrame:
    return snapshots.select_tickets(
        s.raw(), RAW_WITH_ARRIVAL, limit=SOURCE_ROWS, order_by=[KEY, "arrival"]
    )


@query
def snapshot_digest(s: Stages) -> DataFrame:
    return snapshots.snapshot_digest(s.spark, s.pages())


@query
def row_digest(s: Stages) -> DataFrame:
    """Rows of the landed pages and a digest of their canonical text that no order changes."""
    return snapshots.row_digest(snapshots.scan_pages(s.spark, s.pages(), RAW_WITH_ARRIVAL), RAW_WITH_ARRIVAL)


@query
def deliveries(s: Stages) -> DataFrame:
    """Rows of every delivery: all of them together are the raw table."""
    return s.snapshots().groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


@query
def latest_snapshot(s: Stages) -> DataFrame:
    return snapshots.latest_snapshot(s.snapshots()).select("snapshot_date", KEY, "arrival")


@query_on()
def fold_slice(s: Stages) -> DataFrame:
    return folds.test_rows(s.bundle(), 2).select(KEY, "y", "fold")


def _spec(s: Stages) -> tables.FeatureSpec:
    categorical, numeric, time = features.feature_columns(s.bundle().columns)
    return tables.FeatureSpec(
        tag=TAG, source_interim="interim", created_at_utc="",
        categorical_cols=categorical, numeric_cols=numeric, time_feature_cols=time,
    )


@query
def feature_report(s: Stages) -> DataFrame:
    return tables.feature_report(_spec(s), s.fold_sizes())


@query
def feature_spec(s: Stages) -> DataFrame:
    """The written and reread specification, its lists joined, with the bundle's row count."""
    path = new_path(s.spark, "spec")
    tables.write_spec(s.spark, _spec(s), path)
    frame = tables.spec_frame(s.spark, tables.read_spec(s.spark, path))
    lists = ("categorical_cols", "numeric_cols", "time_feature_cols")
    joined = frame.withColumns({c: F.concat_ws(",", c) for c in lists})
    return joined.crossJoin(F.broadcast(s.bundle().agg(F.count(F.lit(1)).alias("n_rows"))))  # one row each


@query_on(BASELINE_COLUMN)
def head_export(s: Stages) -> DataFrame:
    return tables.head_export(s.best_predictions())


# ---- cleaning -----------------------------------------------------------------------------

@query
def blank_to_null(s: Stages) -> DataFrame:
    return clean.blanks_to_null(s.raw())


@query
def parse_timestamps(s: Stages) -> DataFrame:
    return clean.parsed(s.raw()).select(KEY, "arrival", CREATED, CLOSED)


@query
def required_dates(s: Stages) -> DataFrame:
    return clean.parsed(s.raw()).transform(clean.keep_dated).select(KEY, "arrival")


def _ordered(s: Stages) -> DataFrame:
    return clean.parsed(s.raw()).transform(clean.keep_dated).transform(clean.keep_ordered)


@query
def time_sanity(s: Stages) -> DataFrame:
    return _ordered(s).select(KEY, "arrival")


@query
def dedup_keep_last(s: Stages) -> DataFrame:
    return clean.keep_last(_ordered(s)).select(KEY, "arrival", "agency", CREATED, CLOSED)


@query
def resolution_hours(s: Stages) -> DataFrame:
    return clean.with_hours(_ordered(s)).select(KEY, "arrival", TARGET)


@query
def valid_target(s: Stages) -> DataFrame:
    dated = clean.parsed(s.raw()).transform(clean.keep_dated)
    return clean.keep_valid_target(clean.with_hours(dated)).select(KEY, "arrival", TARGET)


@query
def keep_columns(s: Stages) -> DataFrame:
    return clean.keep_columns(s.unique(), ["borough", "agency", "no_such_column"])


@query
def outlier_percentile(s: Stages) -> DataFrame:
    return clean.cut_outliers(s.unique(), "percentile").select(KEY, TARGET)


@query
def outlier_cap(s: Stages) -> DataFrame:
    return clean.cut_outliers(s.unique(), "cap_hours").select(KEY, TARGET)


@query
def clean_funnel(s: Stages) -> DataFrame:
    return clean.funnel(s.raw(), s.unique())


@query
def live_funnel(s: Stages) -> DataFrame:
    """The funnel, counted while the cleaned tables are written."""
    return pipeline.build_interim_live(s.raw())[1]


@query
def cleaning_report(s: Stages) -> DataFrame:
    counts = clean.funnel(s.raw(), s.unique())
    return clean.cleaning_report(counts, s.interim().columns, "percentile", source="raw", target="interim")


@query
def clean_tickets(s: Stages) -> DataFrame:
    return clean.cut_outliers(s.unique())


# ---- features, target, folds --------------------------------------------------------------

@query_on()
def time_features(s: Stages) -> DataFrame:
    return features.with_time_features(s.interim()).select(KEY, *TIME_FEATURES)


@query_on()
def seeded_sample(s: Stages) -> DataFrame:
    return sampling.seeded_sample(s.interim(), SAMPLE_ROWS, KEY, SEED).select(KEY, TARGET)


@query
def target_numeric(s: Stages) -> DataFrame:
    return features.with_target(s.unique(), "none", target="latitude").select(KEY, "y")


@query_on()
def target_log1p(s: Stages) -> DataFrame:
    return features.with_target(s.interim()).select(KEY, "y")


@query
def align_semi(s: Stages) -> DataFrame:
    located = features.with_target(s.unique(), "none", target="latitude")
    return features.align_to_target(s.unique(), located).select(KEY, "borough", "latitude")


@query
def align_bucketed(s: Stages) -> DataFrame:
    """The same rows from two tables bucketed by key, which are not shuffled to be aligned."""
    located = features.with_target(s.unique(), "none", target="latitude").select(KEY, "y")
    sides = [tables.write_bucketed(t, name) for t, name in ((s.unique(), "rows"), (located, "targets"))]
    return features.align_to_target(*sides).select(KEY, "borough", "latitude")


@query_on(BASELINE_COLUMN, "borough")
def predictions_bucketed(s: Stages) -> DataFrame:
    """Stored predictions beside the category they are for, both bucketed by key."""
    preds = s.best_predictions().select(KEY, "fold", "y_true", "y_pred")
    rows = s.bundle().select(KEY, "borough")
    sides = [tables.write_bucketed(t, name) for t, name in ((preds, "preds"), (rows, "rows"))]
    joined = sides[0].join(sides[1], KEY)
    return joined.groupBy("borough").agg(F.count(F.lit(1)).alias("n"), evaluate.mae().alias("mae"), evaluate.rmse().alias("rmse"))


@query
def numeric_coerce(s: Stages) -> DataFrame:
    return features.feature_table(s.unique()).select(KEY, *NUMERIC)


@query
def feature_table(s: Stages) -> DataFrame:
    return with_features_and_target(s.interim()).drop("y")


@query_on()
def quantile_bins(s: Stages) -> DataFrame:
    return folds.quantile_bins(features.with_target(s.interim())).select(KEY, "y_bin")


@query_on()
def stratified_folds(s: Stages) -> DataFrame:
    dealt = folds.stratified_folds(s.bundle().select(KEY, "y_bin"))
    return dealt.select(KEY, "y_bin", "fold")


@query_on()
def fold_sizes(s: Stages) -> DataFrame:
    return s.fold_sizes()


@query_on()
def fold_train_test(s: Stages) -> DataFrame:
    """Train and test rows of every split."""
    def part(rows: DataFrame, split: int, name: str) -> DataFrame:
        return rows.select(KEY, F.lit(split).alias("split"), F.lit(name).alias("part"))

    parts = [
        part(take(s.bundle(), i), i, name)
        for i in range(N_SPLITS)
        for take, name in ((folds.train_rows, "train"), (folds.test_rows, "test"))
    ]
    return reduce(DataFrame.unionByName, parts)


# ---- fitted preprocessing -----------------------------------------------------------------

@query_on(*CATEGORICAL)
def impute_mode(s: Stages) -> DataFrame:
    categorical, _ = s.columns()
    return encode.impute_modes(s.bundle(), s.modes(), categorical).select(
        KEY, "fold", *categorical
    )


@query_on(*CATEGORICAL)
def onehot_long(s: Stages) -> DataFrame:
    categorical, _ = s.columns()
    filled = encode.impute_modes(s.bundle(), s.modes(), categorical)
    return encode.one_hot(filled, s.levels(), categorical)


@query_on(*NUMERIC, *TIME_FEATURES)
def impute_median(s: Stages) -> DataFrame:
    _, numeric = s.columns()
    return encode.impute_medians(s.bundle(), s.medians(), numeric).select(KEY, "fold", *numeric)


@query_on(*NUMERIC, *TIME_FEATURES)
def standardize(s: Stages) -> DataFrame:
    _, numeric = s.columns()
    scaled = encode.standardise(s.bundle(), s.medians(), s.scaling(), numeric)
    return scaled.select(KEY, "fold", *numeric)


@query_on()
def holdout_split(s: Stages) -> DataFrame:
    """Both hold-outs of the train rows of every split."""
    def marked(split: int) -> DataFrame:
        train = folds.train_rows(s.bundle(), split).select(KEY, F.lit(split).alias("split"))
        tenth = sampling.mark_holdout(train, 0.1, KEY, SEED, "holdout_tenth")
        return sampling.mark_holdout(tenth, 0.2, KEY, SEED, "holdout_fifth")

    return reduce(DataFrame.unionByName, [marked(i) for i in range(N_SPLITS)])


@query_on(*encode.TARGET_ENCODED)
def target_encode(s: Stages) -> DataFrame:
    encoded = encode.target_encode(s.bundle(), s.target_means(), encode.TARGET_ENCODED)
    return encoded.select(KEY, "fold", *encode.TARGET_ENCODED)


@query_on(*TIME_FEATURES)
def cyclic_encode(s: Stages) -> DataFrame:
    return encode.cyclic_encode(s.bundle()).select(
        KEY, "hour_sin", "hour_cos", "day_sin", "day_cos"
    )


@query_on(*encode.DUMMIES)
def dummies_long(s: Stages) -> DataFrame:
    return encode.one_hot(s.bundle(), s.dummy_levels(), encode.DUMMIES)


@query_on(*NUMERIC, *TIME_FEATURES)
def numeric_fill_zero(s: Stages) -> DataFrame:
    matrix = encode.cyclic_encode(s.bundle().drop("y", "y_bin", "fold", "created_month"))
    return encode.numeric_only(matrix)


# ---- evaluation ---------------------------------------------------------------------------

@query_on()
def param_grid(s: Stages) -> DataFrame:
    return evaluate.run_list(s.fold_sizes(), list(evaluate.GRIDS))


@query_on(BASELINE_COLUMN)
def fold_metrics(s: Stages) -> DataFrame:
    return s.fold_results()


@query_on(BASELINE_COLUMN)
def config_summary(s: Stages) -> DataFrame:
    return s.summary()


@query_on(BASELINE_COLUMN)
def best_config(s: Stages) -> DataFrame:
    return evaluate.best_config(s.summary())


@query_on(BASELINE_COLUMN)
def mark_best(s: Stages) -> DataFrame:
    best = evaluate.best_config(s.summary())
    return evaluate.mark_best(s.fold_results(), best)


@query_on(BASELINE_COLUMN)
def results_union(s: Stages) -> DataFrame:
    return evaluate.stack_results(s.fold_results(), s.summary())


@query_on(BASELINE_COLUMN)
def top_configs(s: Stages) -> DataFrame:
    return evaluate.top_configs(s.summary())


# ---- profiles -----------------------------------------------------------------------------

@query_on()
def target_profile(s: Stages) -> DataFrame:
    return profile.target_profile(s.bundle())


@query_on()
def dataset_summary(s: Stages) -> DataFrame:
    categorical, numeric = s.columns()
    return profile.dataset_summary(
        s.bundle(), {"raw feature columns": categorical + numeric, "categorical": categorical,
                     "numeric and time": numeric},
    )


@query_on(*CATEGORICAL)
def fold_widths(s: Stages) -> DataFrame:
    return profile.fold_widths(s.bundle(), *s.columns())


@query_on(*CATEGORICAL)
def feature_names(s: Stages) -> DataFrame:
    return profile.feature_names(s.bundle(), *s.columns())


@query_on()
def target_hist(s: Stages) -> DataFrame:
    return profile.target_hist(s.bundle())


@query_on()
def hours_hist_clipped(s: Stages) -> DataFrame:
    return profile.hours_hist_clipped(s.bundle())


@query_on(BASELINE_COLUMN)
def residual_hist(s: Stages) -> DataFrame:
    return profile.residual_hist(s.best_predictions())


@query_on(BASELINE_COLUMN)
def pred_vs_true_grid(s: Stages) -> DataFrame:
    return profile.pred_vs_true_grid(s.best_predictions())


@query_on(BASELINE_COLUMN)
def abs_error_by_target(s: Stages) -> DataFrame:
    return profile.abs_error_by_target(s.best_predictions())


@query_on(BASELINE_COLUMN)
def best_fold_series(s: Stages) -> DataFrame:
    return profile.best_fold_series(s.results())


@query_on(BASELINE_COLUMN)
def best_from_results(s: Stages) -> DataFrame:
    return profile.best_from_results(s.results())


@query_on(BASELINE_COLUMN)
def config_ranking(s: Stages) -> DataFrame:
    return profile.config_ranking(s.results())


@query_on("complaint_type")
def top_types(s: Stages) -> DataFrame:
    return profile.top_categories(s.bundle(), "complaint_type")


@query_on("borough")
def borough_counts(s: Stages) -> DataFrame:
    return profile.category_counts(s.bundle(), "borough")


@query_on("borough")
def borough_mean_target(s: Stages) -> DataFrame:
    return profile.mean_target_by(s.bundle(), "borough")


# ---- models -------------------------------------------------------------------------------

@query
def rf_oof(s: Stages) -> DataFrame:
    """Out-of-fold predictions of the best forest: rows, keys, range, and what the train mean errs by."""
    preds = s.forest_predictions()
    params = list(evaluate.FOREST_GRID)
    summary = evaluate.summarise(evaluate.fold_results(preds, params), params)
    return evaluate.run_facts(evaluate.best_predictions(preds, evaluate.best_config(summary)), s.bundle())


@query
def boost_oof(s: Stages) -> DataFrame:
    """The same of the boosted trees, whose sums may leave the range of the train rows."""
    return evaluate.run_facts(s.boosted_predictions(), s.bundle()).drop("n_within")


@query
def boost_results(s: Stages) -> DataFrame:
    """Fold and summary rows of boosting with their errors, in the stored form."""
    return profile.results_from(s.boosted_predictions(), ["n_estimators", "learning_rate"])


@query
def forest_results(s: Stages) -> DataFrame:
    """Fold and summary rows of the forest grid with their errors, in the stored form."""
    return profile.results_from(s.forest_predictions(), list(evaluate.FOREST_GRID))


@query
def cv_grid(s: Stages) -> DataFrame:
    """Shape of the forest grid's stored results: every configuration's folds, rows and sound errors."""
    results = profile.results_from(s.forest_predictions(), list(evaluate.FOREST_GRID))
    sound = (F.col("mae") > 0) & (F.col("mae") <= F.col("rmse"))
    return results.where("row_type = 'fold'").groupBy("model", "tag", "config_id", *evaluate.FOREST_GRID).agg(
        F.count(F.lit(1)).alias("n_folds"), F.sum("n_train").alias("n_train"), F.sum("n_test").alias("n_test"),
        F.count_if(sound).alias("n_sound"),
    )


@query
def model_compare(s: Stages) -> DataFrame:
    """The models compared, on which common rows, and the train mean's errors there."""
    preds = s.all_predictions()
    best = evaluate.best_config(evaluate.summarise(evaluate.fold_results(preds)))
    facts = evaluate.run_facts(evaluate.best_predictions(preds, best), s.bundle())
    return facts.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_folds"), F.sum("n_keys").alias("n_keys"), F.sum("n_missing").alias("n_missing"),
        F.avg("base_mae").alias("base_mae"), F.avg("base_rmse").alias("base_rmse"),
    )


@query
def model_ranking(s: Stages) -> DataFrame:
    """The best configuration of every model, ranked by its errors, and whether it beats the train mean."""
    preds = s.all_predictions()
    ranked = evaluate.compare_models(evaluate.summarise(evaluate.fold_results(preds)))
    return evaluate.with_baseline(ranked, evaluate.best_predictions(preds, ranked), s.bundle())
