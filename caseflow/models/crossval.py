"""Cross-validated runs: every split fits on the other folds and predicts its own.

The driver only loops over configurations and splits; each fit, encoding and scoring is a Spark job.
Preprocessing is fitted once per split and shared by all configurations. Forests that differ only in
the number or the depth of their trees are grown once: the smaller ones are read from the largest
one's tree table, since a greedy tree that may use all columns splits its upper levels alike under any
depth limit. Finished fits are stored with their model in a ledger, so a run that was stopped goes on
with what is missing, and the best configuration is never fitted a second time.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.models import boosting, forest, ledger
from caseflow.models.design import Fitted, boosting_table, encoded
from caseflow.models.ledger import Ledger
from caseflow.operators import folds
from caseflow.operators.evaluate import RUN
from caseflow.schema import KEY
from caseflow.session import new_path

CONCURRENT_FITS = 4

FOREST = "random_forest_regressor"
BOOSTED = "boosted_trees_regressor"


def _tagged(preds: DataFrame, model: str, tag: str, config: dict) -> DataFrame:
    params = {k: v for k, v in config.items() if k != "config_id"}
    labelled = preds.withColumns(
        {"model": F.lit(model), "tag": F.lit(tag), "config_id": F.lit(config["config_id"])}
        | {k: F.lit(v) for k, v in params.items()}
    )
    return labelled.select(*RUN, *params, KEY, "fold", "y_true", "y_pred")


def _tagged_all(preds: DataFrame, model: str, tag: str, configs: Sequence[dict]) -> DataFrame:
    """The same of rows that hold the predictions of several configurations, in their order."""
    labels = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in c.items()]) for c in configs])
    long = preds.withColumn("labels", labels).select(
        KEY, "fold", "y_true", F.explode(F.arrays_zip("labels", "y_preds")).alias("c")
    )
    return long.select(
        F.lit(model).alias("model"), F.lit(tag).alias("tag"), "c.labels.*", KEY, "fold", "y_true",
        F.col("c.y_preds").alias("y_pred"),
    )


def _ledger(bundle: DataFrame, store: Ledger | None) -> Ledger:
    spark = bundle.sparkSession
    return store or Ledger(spark, new_path(spark, "runs"))


def families(configs: Sequence[dict]) -> list[list[dict]]:
    """Forest configurations in groups that one forest serves: the same smallest leaf."""
    found: dict[int, list[dict]] = {}
    for config in configs:
        found.setdefault(config["min_samples_leaf"], []).append(config)
    return list(found.values())


def _once[T](make: Callable[[], T]) -> Callable[[], T]:
    """A table that is made when first asked for, by one thread."""
    lock, made = threading.Lock(), []

    def get() -> DataFrame:
        with lock:
            if not made:
                made.append(make())
            return made[0]

    return get


def forest_grid(
    bundle: DataFrame,
    fitted: Fitted,
    categorical: Sequence[str],
    numeric: Sequence[str],
    configs: Sequence[dict],
    tag: str,
    n_splits: int,
    store: Ledger | None = None,
    concurrent: int = CONCURRENT_FITS,
) -> DataFrame:
    """Out-of-fold predictions of every configuration. Fits that ``store`` holds are not done
    again; without one, nothing is kept beyond this run."""
    store = _ledger(bundle, store)
    done = store.finished()

    def grow(split: int, design: Callable[[], DataFrame], train: Callable[[], forest.Coded], family: list[dict]) -> None:
        began = time.time()
        largest = {
            "n_estimators": max(c["n_estimators"] for c in family),
            "max_depth": max(c["max_depth"] for c in family),
            "min_samples_leaf": family[0]["min_samples_leaf"],
        }
        whole = forest.fit(train(), largest)
        test = folds.test_rows(design(), split).withColumnRenamed("y", "y_true").drop("features")
        seconds = time.time() - began
        missing = [c for c in family if (FOREST, c["config_id"], split) not in done]
        parts = [(c["n_estimators"], c["max_depth"]) for c in missing]
        scored = _tagged_all(whole.score_parts(test, parts), FOREST, tag, missing)
        fits = [(FOREST, c["config_id"], split) for c in missing]
        store.record(fits, tag, scored, whole, parts, seconds)

    jobs = []
    for split in range(n_splits):
        design = _once(lambda i=split: encoded(fitted, i, bundle, categorical, numeric, f"forest_{i}"))
        train = _once(lambda i=split, d=design: forest.coded(folds.train_rows(d(), i)))
        for family in families(configs):
            if any((FOREST, c["config_id"], split) not in done for c in family):
                name = f"leaf{family[0]['min_samples_leaf']}-fold{split}"
                jobs.append((name, lambda i=split, d=design, t=train, f=family: grow(i, d, t, f)))
    ledger.run(bundle.sparkSession, jobs, concurrent)
    return store.predictions((FOREST, c["config_id"], i) for c in configs for i in range(n_splits))


def boosted_run(
    bundle: DataFrame,
    tag: str,
    n_splits: int,
    rounds: int = boosting.ROUNDS,
    rate: float = boosting.RATE,
    patience: int = boosting.PATIENCE,
    store: Ledger | None = None,
    concurrent: int = CONCURRENT_FITS,
) -> DataFrame:
    """Out-of-fold predictions of the boosted trees, with early stopping on a hold-out; as
    ``forest_grid``, fits that ``store`` holds are not done again."""
    store = _ledger(bundle, store)
    done = store.finished()
    config = {"config_id": f"boost_n{rounds}_lr{rate:g}", "n_estimators": rounds,
              "learning_rate": rate}

    def grow(split: int) -> None:
        began = time.time()
        table = boosting_table(bundle, split)
        booster = boosting.fit(table, rounds, rate, patience)
        test = table.where(F.col("part") == "test")
        scored = _tagged(boosting.predict(booster, test), BOOSTED, tag, config)
        model = booster.table(bundle.sparkSession)
        store.record([(BOOSTED, config["config_id"], split)], tag, scored, model,
                     [(model.n_trees, model.depth)], time.time() - began)

    missing = [i for i in range(n_splits) if (BOOSTED, config["config_id"], i) not in done]
    ledger.run(bundle.sparkSession, [(f"boost-fold{i}", lambda i=i: grow(i)) for i in missing], concurrent)
    return store.predictions((BOOSTED, config["config_id"], i) for i in range(n_splits))
