"""A stored record of finished fits, so that a grid run that was stopped goes on with the rest.

A fit of one fold may serve several configurations. It writes its predictions and its model below
the root; its entries, one for each configuration, are written last, as one small file in a
folder of their own. A fit that was cut off has no entry and is done again; what it left is never
read. Nothing is kept on the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.models import tree_table
from caseflow.models.tree_table import TreeTable
from caseflow.session import exists

ENTRY = (
    "model string, tag string, config_id string, fold int, n_trees int, depth int, n_test long, "
    "seconds double, place string"
)

Fit = tuple[str, str, int]  # model, configuration, fold


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    def entries(self) -> DataFrame:
        """One row for each finished fit; the last one where a fit was done twice."""
        if not exists(self.spark, f"{self.root}/entries"):
            return self.spark.createDataFrame([], ENTRY)
        found = self.spark.read.schema(ENTRY).json(f"{self.root}/entries/*")
        run = ("model", "tag", "config_id", "fold")
        rest = [c for c in found.columns if c not in run]
        last = F.max_by(F.struct(*rest), F.element_at(F.split("place", "/"), -1)).alias("last")
        return found.groupBy(*run).agg(last).select(*run, "last.*")

    def finished(self) -> set[Fit]:
        """At most one row for each configuration and fold."""
        return {(r["model"], r["config_id"], r["fold"]) for r in self.entries().collect()}

    def record(
        self, fits: Sequence[Fit], tag: str, predictions: DataFrame, fitted: TreeTable,
        parts: Sequence[tuple[int, int]], seconds: float,
    ) -> None:
        """Store the fits of one fold that one model serves; with their entries they count.

        ``parts`` has for each fit the trees and the depth to which it uses the model.
        """
        model, _, fold = fits[0]
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        place = f"{self.root}/fits/{model}/{fold}/{name}"
        predictions.write.parquet(f"{place}/predictions")
        fitted.save(f"{place}/fitted")
        counted = self.spark.read.parquet(f"{place}/predictions").groupBy("config_id").count()
        sizes = {r["config_id"]: r["count"] for r in counted.collect()}  # one row for each fit
        rows = [
            (model, tag, config_id, fold, *part, sizes.get(config_id, 0), seconds, place)
            for (_, config_id, _), part in zip(fits, parts, strict=True)
        ]
        self.spark.createDataFrame(rows, ENTRY).coalesce(1).write.json(f"{self.root}/entries/{name}")

    def _found(self, fits: Iterable[Fit]) -> list:
        wanted = set(fits)
        return [r for r in self.entries().collect() if (r["model"], r["config_id"], r["fold"]) in wanted]

    def predictions(self, fits: Iterable[Fit]) -> DataFrame:
        """Stored predictions of the given fits; one scan of their folders, which may hold others."""
        found = self._found(fits)
        if not found:
            raise FileNotFoundError("none of these fits has been finished yet")
        paths = sorted({f"{r['place']}/predictions" for r in found})
        schema = self.spark.read.parquet(paths[0]).schema
        stored = self.spark.read.schema(schema).parquet(*paths)
        mine = [F.lit(f"{r['config_id']}/{r['fold']}") for r in found]
        return stored.where(F.concat_ws("/", "config_id", "fold").isin(*mine))

    def fitted(self, fit: Fit) -> TreeTable:
        """A stored model, as it can be scored in any session."""
        for r in self._found([fit]):
            return tree_table.load(self.spark, f"{r['place']}/fitted").first_trees(r["n_trees"]).cut_at(r["depth"])
        raise KeyError(fit)


def run(spark: SparkSession, jobs: Sequence[tuple[str, Callable[[], None]]], concurrent: int) -> None:
    """Run the jobs side by side, each in its own scheduler pool, so that with fair scheduling a
    long fit does not hold back the others. All jobs are tried; the first error is raised after."""

    def one(name: str, job: Callable[[], None]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            job()
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(one), name, job) for name, job in jobs]
        errors = [f.exception() for f in running]
    for error in errors:
        if error:
            raise error
