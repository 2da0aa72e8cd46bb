"""Grids, metrics, model selection and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions import text
from caseflow.operators import lookup
from caseflow.operators.folds import other_folds
from caseflow.schema import KEY, N_SPLITS
from caseflow.session import materialise

RUN = ["model", "tag", "config_id"]

# The searched hyper-parameters and the form of a configuration's name. The
# deepest forest is 30, the most the engine grows.
FOREST_GRID = {
    "n_estimators": [200, 300], "max_depth": [20, 30], "min_samples_leaf": [1, 5, 10],
}
MLP_GRID = {
    "hidden_size": [128, 256], "learning_rate": [1e-3, 3e-4], "dropout": [0.2],
    "batch_size": [512],
}
RESIDUAL_GRID = {
    "hidden_size": [256], "n_blocks": [2, 4], "learning_rate": [1e-3, 3e-4],
    "dropout": [0.1, 0.3], "batch_size": [512],
}
NAME_FORMS = {
    "random_forest_regressor": "rf_n{n_estimators}_d{max_depth}_leaf{min_samples_leaf}",
    "mlp_regressor": "mlp_h{hidden_size}_lr{learning_rate:.0e}_do{dropout}",
    "resnet_regressor": "resnet_h{hidden_size}_b{n_blocks}_lr{learning_rate:.0e}_do{dropout}",
}
GRIDS = {
    "random_forest_regressor": FOREST_GRID,
    "mlp_regressor": MLP_GRID,
    "resnet_regressor": RESIDUAL_GRID,
}


def grid_configs(model: str, axes: dict[str, list] | None = None) -> list[dict]:
    """All combinations of the axes, the last axis varying fastest, each with its name."""
    configs: list[dict] = [{}]
    for axis, values in (axes or GRIDS[model]).items():
        configs = [{**c, axis: v} for c in configs for v in values]
    return [{"config_id": NAME_FORMS[model].format(**c), **c} for c in configs]


def run_list(sizes: DataFrame, models: Sequence[str]) -> DataFrame:
    """``(model, config_id, fold, n_train, n_test)``: every fit of a grid search.

    The configurations are a literal array on each fold row; nothing is joined.
    """
    runs = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.lit(c["config_id"]).alias("config_id"))
            for m in models
            for c in grid_configs(m)
        ]
    )
    return sizes.select(F.inline(runs), "fold", "n_train", "n_test")


def category_mean_predictions(
    df: DataFrame,
    column: str,
    smoothings: Sequence[float],
    tag: str,
    n_splits: int = N_SPLITS,
    model: str = "category_mean",
) -> DataFrame:
    """Out-of-fold predictions of a smoothed category mean, one configuration per smoothing.

    The fixed baseline every regressor is compared with. The sums it needs are written once, so the
    predictions can be read more than once without being written: pass a written ``df``.
    """
    level = text.text_category(F.col(column))
    per_fold = materialise(
        df.groupBy("fold", level.alias("level"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total")),
        "category_sums",
    )
    train = (
        other_folds(per_fold, n_splits)
        .groupBy("split", "level")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    overall = (
        other_folds(per_fold, n_splits)
        .groupBy(F.col("split").alias("fold"))
        .agg((F.sum("total") / F.sum("n")).alias("overall"))
    )
    known = train.withColumnRenamed("split", "fold")
    rows = df.select(KEY, "fold", F.col("y").alias("y_true"), level.alias("level"))
    scored = lookup.attach(
        rows, known, ["fold", "level"], KEY, lookup.fits_broadcast(known)
    ).join(F.broadcast(overall), "fold", "left")  # one row per fold
    n, total = F.coalesce("n", F.lit(0)), F.coalesce("total", F.lit(0.0))
    configs = F.array(
        *[
            F.struct(
                F.lit(f"mean_{column}_m{m:g}").alias("config_id"),
                F.lit(float(m)).alias("smoothing"),
                ((total + F.col("overall") * float(m)) / (n + float(m))).alias("y_pred"),
            )
            for m in smoothings
        ]
    )
    return scored.select(KEY, "fold", "y_true", F.explode(configs).alias("c")).select(
        F.lit(model).alias("model"), F.lit(tag).alias("tag"), "c.config_id", "c.smoothing",
        KEY, "fold", "y_true", "c.y_pred",
    )


def mae(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    return F.avg(F.abs(F.col(y_true) - F.col(y_pred)))


def rmse(y_true: str = "y_true", y_pred: str = "y_pred") -> Column:
    error = F.col(y_true) - F.col(y_pred)
    return F.sqrt(F.avg(error * error))


def fold_results(preds: DataFrame, params: Sequence[str] = ()) -> DataFrame:
    """One row per run and fold with row counts and errors, from one long prediction table."""
    run = [*RUN, *params]
    scored = preds.groupBy(*run, "fold").agg(
        F.count(F.lit(1)).alias("n_test"), mae().alias("mae"), rmse().alias("rmse")
    )
    whole_run = Window.partitionBy(*run)  # one row per fold
    n_train = F.sum("n_test").over(whole_run) - F.col("n_test")
    return scored.select(*RUN, "fold", n_train.alias("n_train"), "n_test", *params, "mae", "rmse")


def summarise(fold_rows: DataFrame, params: Sequence[str] = ()) -> DataFrame:
    """Mean and sample standard deviation over folds, per configuration."""
    return fold_rows.groupBy(*RUN, *params).agg(
        F.avg("mae").alias("mae_mean"),
        F.stddev_samp("mae").alias("mae_std"),
        F.avg("rmse").alias("rmse_mean"),
        F.stddev_samp("rmse").alias("rmse_std"),
    )


def best_first() -> list[Column]:
    """Lowest mean RMSE, then lowest mean MAE, then name; a missing metric is never best."""
    return [F.col(c).asc_nulls_last() for c in ("rmse_mean", "mae_mean", "config_id")]


def best_config(summary: DataFrame) -> DataFrame:
    """The summary row with the lowest mean RMSE, then lowest mean MAE, of each model."""
    order = Window.partitionBy("model", "tag").orderBy(*best_first())
    return (
        summary.withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") == 1)
        .drop("_nth")
    )


def mark_best(rows: DataFrame, best: DataFrame) -> DataFrame:
    """Add ``is_best`` to fold or summary rows."""
    chosen = best.select("model", "tag", F.col("config_id").alias("_best"))
    return (
        rows.join(F.broadcast(chosen), ["model", "tag"], "left")  # one row per model
        .withColumn("is_best", F.col("config_id").eqNullSafe(F.col("_best")))
        .drop("_best")
    )


def best_predictions(preds: DataFrame, best: DataFrame) -> DataFrame:
    """Out-of-fold predictions of the best configuration, from the predictions of the grid:
    nothing is fitted again."""
    return preds.join(F.broadcast(best.select(*RUN)), RUN, "left_semi")  # one row per model


def stack_results(fold_rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Fold rows and summary rows in one table; columns of the other kind are null."""
    best = best_config(summary)
    return mark_best(fold_rows, best).withColumn("row_type", F.lit("fold")).unionByName(
        mark_best(summary, best).withColumn("row_type", F.lit("summary")),
        allowMissingColumns=True,
    )


def top_configs(summary: DataFrame, n: int = 5) -> DataFrame:
    return mark_best(summary, best_config(summary)).orderBy(*best_first()).limit(n)


def compare_models(summary: DataFrame) -> DataFrame:
    """The best configuration of every model, ranked on the common folds."""
    order = Window.orderBy(*best_first())  # one row per model
    return best_config(summary).withColumn("place", F.row_number().over(order))


def mean_baseline(df: DataFrame) -> DataFrame:
    """``(fold, low, high, mean)`` of the train rows of each fold: the range of ``y``, and the mean
    that a model must beat."""
    sums = df.groupBy("fold").agg(
        F.count("y").alias("n"), F.sum("y").alias("total"), F.min("y").alias("low"), F.max("y").alias("high")
    )
    train = other_folds(sums, N_SPLITS).groupBy(F.col("split").alias("fold"))
    return train.agg(
        F.min("low").alias("low"), F.max("high").alias("high"), (F.sum("total") / F.sum("n")).alias("mean")
    )


def run_facts(preds: DataFrame, df: DataFrame) -> DataFrame:
    """``(model, fold, n, n_keys, n_missing, n_within, base_mae, base_rmse)`` of a prediction table.

    ``n_within`` predictions lie in the range of the train rows; the base errors are those of always
    predicting the train mean, over the same rows.
    """
    joined = preds.join(F.broadcast(mean_baseline(df)), "fold")  # one row per fold
    return joined.groupBy("model", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(KEY).alias("n_keys"),
        F.count_if(F.col("y_pred").isNull()).alias("n_missing"),
        F.count_if(F.col("y_pred").between(F.col("low"), F.col("high"))).alias("n_within"),
        mae("y_true", "mean").alias("base_mae"), rmse("y_true", "mean").alias("base_rmse"),
    )


def with_baseline(ranked: DataFrame, preds: DataFrame, df: DataFrame) -> DataFrame:
    """Ranked models beside the train mean's RMSE on the same rows, and whether they beat it."""
    base = run_facts(preds, df).groupBy("model").agg(F.avg("base_rmse").alias("base_rmse"))
    return ranked.join(F.broadcast(base), "model").withColumn(  # one row per model
        "beats_mean", F.col("rmse_mean") < F.col("base_rmse")
    )
