"""Stage tables over the test tables, each derived and written once for a query."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow import fixtures
from caseflow.models import crossval
from caseflow.models.design import Fitted
from caseflow.models.ledger import Ledger
from caseflow.operators import clean, encode, evaluate, features, folds
from caseflow.plans import pipeline
from caseflow.schema import KEY, N_SPLITS, RAW_COLUMNS
from caseflow.session import materialise, new_path, run_folder, use_utc
from caseflow.sources import snapshots

SMOOTHINGS = [1, 5, 15, 50, 150, 500]
TAG = "processed_cv5"
BASELINE_COLUMN = "complaint_type"
FIRST_DELIVERY = "1900-12-31"


class Stages:
    """The tables one step hands to the next, as a user of the library would store them.

    A written table is a barrier to column pruning. A query that knows which features it ``reads`` says
    so, and only these are stored beside key, dates and target, and moved to find a key's latest row; every
    row is, whatever it reads.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, reads: Sequence[str] | None = None):
        self.spark = use_utc(spark)
        self.reads = reads
        self.sf_dir = sf_dir.rstrip("/")
        self._made: dict[str, object] = {}

    def _once(self, name: str, make: Callable[[], object]):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def raw(self) -> DataFrame:
        """Raw tickets (all text); a plan, not a written table."""
        return self._once("raw", lambda: fixtures.raw_tickets(self.spark, self.sf_dir))

    def pages(self) -> str:
        """The same tickets landed as CSV pages."""
        def land() -> str:
            path = new_path(self.spark, "pages")
            snapshots.write_pages(self.raw(), path)
            return path

        return self._once("pages", land)

    def snapshots(self) -> DataFrame:
        """Tickets as yearly deliveries, one partition per snapshot date; those without a
        readable create date came with the first delivery."""
        def land() -> DataFrame:
            year = F.substring("created_date", 1, 4)
            day = F.when(year.rlike("^[0-9]{4}$"), F.concat(year, F.lit("-12-31")))
            dated = self.raw().withColumn("snapshot_date", F.coalesce(day, F.lit(FIRST_DELIVERY)))
            return materialise(dated, "snapshots", partition_by=["snapshot_date"])

        return self._once("snapshots", land)

    def unique(self) -> DataFrame:
        """Dated, ordered, deduplicated tickets with hours."""
        kept = () if self.reads is None else (KEY, *self.reads)
        return self._once(
            "unique",
            lambda: materialise(clean.dated_and_unique(self.raw(), keep=kept), "unique"),
        )

    def interim(self) -> DataFrame:
        """The unique rows below the limit, which is found once: a filter on the written table."""
        return self._once("interim", lambda: clean.cut_outliers(self.unique()))

    def bundle(self) -> DataFrame:
        return self._once("bundle", lambda: pipeline.build_bundle(self.interim(), columns=self.reads))

    def columns(self) -> tuple[list[str], list[str]]:
        """Categorical columns, and numeric plus time columns, of the whole bundle: of its plan, nothing
        is run for them."""
        def plan() -> tuple[list[str], list[str]]:
            whole = pipeline.with_features_and_target(clean.with_hours(clean.parsed(self.raw())))
            categorical, numeric, time = features.feature_columns(whole.columns)
            return categorical, numeric + time

        return self._once("columns", plan)

    def value_counts(self) -> DataFrame:
        """Train counts of the categorical values, from which modes and levels are both read."""
        return self._once(
            "value_counts",
            lambda: materialise(
                encode.value_counts(self.bundle(), self.columns()[0], N_SPLITS), "value_counts"
            ),
        )

    def modes(self) -> DataFrame:
        return self._once(
            "modes",
            lambda: materialise(
                encode.fit_modes(self.bundle(), self.columns()[0], counts=self.value_counts()), "modes"
            ),
        )

    def levels(self) -> DataFrame:
        return self._once(
            "levels",
            lambda: materialise(
                encode.fit_levels(self.bundle(), self.columns()[0], counts=self.value_counts()), "levels"
            ),
        )

    def dummy_levels(self) -> DataFrame:
        return self._once(
            "dummy_levels",
            lambda: materialise(
                encode.fit_levels(self.bundle(), encode.DUMMIES), "dummy_levels"
            ),
        )

    def medians(self) -> DataFrame:
        return self._once(
            "medians",
            lambda: materialise(encode.fit_medians(self.bundle(), self.columns()[1]), "medians"),
        )

    def scaling(self) -> DataFrame:
        return self._once(
            "scaling",
            lambda: materialise(
                encode.fit_scaling(self.bundle(), self.columns()[1], self.medians()), "scaling"
            ),
        )

    def target_means(self) -> DataFrame:
        return self._once(
            "target_means",
            lambda: materialise(
                encode.fit_target_means(self.bundle(), encode.TARGET_ENCODED), "target_means"
            ),
        )

    def fold_sizes(self) -> DataFrame:
        return folds.fold_sizes(self.bundle())

    def predictions(self) -> DataFrame:
        """Out-of-fold predictions of the baseline grid: a plan over the bundle and its stored sums,
        since a row is sooner predicted again than written once for each configuration."""
        return self._once(
            "predictions",
            lambda: evaluate.category_mean_predictions(
                self.bundle(), BASELINE_COLUMN, SMOOTHINGS, TAG
            ),
        )

    def fold_results(self) -> DataFrame:
        return self._once(
            "fold_results",
            lambda: materialise(
                evaluate.fold_results(self.predictions(), ["smoothing"]), "fold_results"
            ),
        )

    def summary(self) -> DataFrame:
        return evaluate.summarise(self.fold_results(), ["smoothing"])

    def results(self) -> DataFrame:
        return self._once(
            "results",
            lambda: materialise(
                evaluate.stack_results(self.fold_results(), self.summary()), "results"
            ),
        )

    def best_predictions(self) -> DataFrame:
        return evaluate.best_predictions(
            self.predictions(), evaluate.best_config(self.summary())
        )

    def fitted(self) -> Fitted:
        return Fitted(self.modes(), self.levels(), self.medians(), self.scaling())

    def runs(self) -> Ledger:
        """The stored fits over this bundle: queries of one application fit a model once."""
        def find() -> Ledger:
            bundle = self.bundle()
            row = F.xxhash64(*sorted(bundle.columns))
            seen = bundle.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("digest")).first()
            return Ledger(self.spark, f"{run_folder(self.spark)}/runs-{seen['n']}-{seen['digest']}")

        return self._once("runs", find)

    def forest_predictions(self) -> DataFrame:
        """The forest grid over all folds."""
        configs = evaluate.grid_configs(crossval.FOREST)
        return self._once(
            "forest_predictions",
            lambda: crossval.forest_grid(
                self.bundle(), self.fitted(), *self.columns(), configs, TAG, N_SPLITS, self.runs()
            ),
        )

    def boosted_predictions(self) -> DataFrame:
        """Boosted trees with their real number of rounds and early stopping."""
        return self._once(
            "boosted_predictions",
            lambda: crossval.boosted_run(self.bundle(), TAG, N_SPLITS, store=self.runs()),
        )

    def all_predictions(self) -> DataFrame:
        """The baseline, the forests and the boosted trees in one long table."""
        columns = [*evaluate.RUN, KEY, "fold", "y_true", "y_pred"]
        tables = (self.predictions(), self.forest_predictions(), self.boosted_predictions())
        return reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])


RAW_WITH_ARRIVAL = [*RAW_COLUMNS, "arrival"]
