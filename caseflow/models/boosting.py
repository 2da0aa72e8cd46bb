"""Boosted regression trees on squared loss, with a random column sample per round."""

from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.models import candidates, tree_table
from caseflow.models.design import with_vectors
from caseflow.models.training import EarlyStop
from caseflow.models.tree_table import TreeTable
from caseflow.schema import SEED
from caseflow.session import new_path, remove

# Fixed values of the boosted model.
ROUNDS = 100
RATE = 0.5
PATIENCE = 5
DEPTH = 6
SMALLEST_LEAF = 50
COLUMN_SHARE = 0.6

STORED_ROUNDS = 10
MOST_CODES = 32  # more than the codes of a column: every place between two codes can be a split


@dataclass
class Booster:
    base: float
    rate: float
    places: list[list[float]]
    trees: list[list[tuple]] = field(default_factory=list)
    best_round: int = 0
    train_mae: list[float] = field(default_factory=list)
    validate_mae: list[float] = field(default_factory=list)

    def table(self, spark: SparkSession) -> TreeTable:
        """The trees up to the best round, by the columns' values (a tree has at most 127 nodes)."""
        rows = [node for tree in self.trees[: self.best_round] for node in tree]
        nodes = spark.createDataFrame(rows, tree_table.NODES).coalesce(1)
        return TreeTable(nodes, self.best_round, self.base, self.rate, DEPTH)

    def score(self, df: DataFrame, name: str = "y_pred") -> DataFrame:
        """Base value plus the scaled trees up to the best round."""
        return self.table(df.sparkSession).score(df, look(df), name)


def look(df: DataFrame) -> tree_table.Lookup:
    """How to read a column of a row: from its sparse entries where the table has them."""
    if {"indices", "values"} <= set(df.columns):
        return tree_table.sparse("indices", "values")
    return tree_table.dense("features")


def _coded(table: DataFrame) -> tuple[DataFrame, list[list[float]], int]:
    """``(y, part, features)`` with every number replaced by its code, the codes' places, and the
    width. The columns behind the numbers are dummies, which are their own code. Written once;
    every round reads it."""
    if "numbers" not in table.columns:  # all columns are numbers
        table = table.select("y", "part", "features", vector_to_array("features").alias("numbers"))
    first = table.select(F.size("numbers").alias("n"), "features").first()
    n, width = first["n"], first["features"].size
    places = candidates.split_candidates(table.where(F.col("part") == "train"), "numbers")
    places += [[] for _ in range(n - len(places))]
    own = F.array(*[F.lit(i) for i in range(n)])
    coded = candidates.codes(F.col("numbers"), places)
    if n < width:
        own, coded = (
            F.concat(lead, F.slice(c, n + 1, F.size("indices")))
            for lead, c in ((own, "indices"), (coded, "values"))
        )
    rows = table.select("y", "part", own.alias("indices"), coded.alias("values"))
    return with_vectors(rows, width, "boost_codes").select("y", "part", "features"), places, width


def fit(
    table: DataFrame,
    rounds: int = ROUNDS,
    rate: float = RATE,
    patience: int = PATIENCE,
    seed: int = SEED,
) -> Booster:
    """``table`` has ``y``, ``features`` and ``part`` (``train`` / ``validate``), and ``numbers``,
    ``indices`` and ``values`` where only its first columns are numbers.

    Each round fits a tree to the residuals and adds it to the running prediction, which
    stays a column of the data. The running table is kept between rounds and written every few
    of them, so neither the plan nor a recovery grows with the round number. Only the last
    written one is needed; the one before it is removed.
    """
    spark, stored, last = table.sparkSession, None, None
    coded, places, width = _coded(table.where(F.col("part") != "test"))
    train = F.col("part") == "train"
    base = coded.where(train).agg(F.avg("y")).first()[0]
    state = coded.withColumn("so_far", F.lit(base)).persist(StorageLevel.MEMORY_AND_DISK)
    booster, stop, chosen = Booster(base, rate, places), EarlyStop(patience), random.Random(seed)

    def place(column: int, code: float) -> float:
        return places[column][int(code)] if column < len(places) else code

    for turn in range(1, rounds + 1):
        columns = sorted(chosen.sample(range(width), max(1, int(width * COLUMN_SHARE))))
        residuals = state.where(train).withColumn("residual", F.col("y") - F.col("so_far"))
        subset = VectorSlicer(inputCol="features", outputCol="subset", indices=columns)
        tree = DecisionTreeRegressor(
            featuresCol="subset", labelCol="residual", predictionCol="step", maxDepth=DEPTH,
            minInstancesPerNode=SMALLEST_LEAF, maxBins=MOST_CODES, seed=seed,
        ).fit(subset.transform(residuals))
        booster.trees.append(tree_table.rows_of_tree(
            tree, turn - 1, lambda f, own=columns: own[f], lambda f, t, own=columns: place(own[f], t)
        ))
        scored = tree.transform(subset.transform(state))
        scored = scored.withColumn("so_far", F.col("so_far") + rate * F.col("step")).drop("subset", "step")
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        if turn % STORED_ROUNDS == 0:
            last, stored = stored, new_path(spark, "boost_state")
            scored.write.parquet(stored)
            scored.unpersist()
            scored = spark.read.schema(scored.schema).parquet(stored).persist(StorageLevel.MEMORY_AND_DISK)
        error = F.abs(F.col("y") - F.col("so_far"))
        found = scored.agg(
            F.avg(F.when(train, error)).alias("train"),
            F.avg(F.when(~train, error)).alias("validate"),
        ).first()
        state.unpersist()
        if last:  # the rows are read from the newer table now
            remove(spark, last)
            last = None
        state = scored
        booster.train_mae.append(found["train"])
        watched = found["validate"] if found["validate"] is not None else found["train"]
        booster.validate_mae.append(watched)
        stop.improved(watched)
        if stop.done:
            break
    state.unpersist()
    if stored:
        remove(spark, stored)
    booster.best_round = stop.best_round
    return booster


def predict(booster: Booster, table: DataFrame) -> DataFrame:
    scored = booster.score(table).withColumnRenamed("y", "y_true")
    return scored.drop("features", "part", "numbers", "indices", "values")
