"""Fitted trees as a table, one row per node, and one expression that scores rows with all of them.

A model of any number of trees is ``(tree, node, feature, threshold, left, right, value)``; nodes
are numbered from 0 within a tree, a leaf has ``left = -1``, and an inner node keeps the mean it
had as a leaf. So fewer trees, or trees cut off at a lower depth, are read from the same table:
a greedy tree that may use every column splits its upper levels the same way at any depth limit.

Scoring packs the table into one constant, which goes to the tasks with the plan and is walked
inside the engine; the plan has the same size for one tree and for a hundred. A table of more than
``MOST_NODES`` nodes is scored in blocks of trees, each written before the next, so that no task
holds more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.session import materialise, new_path

NODES = (
    "tree int, node int, feature int, threshold double, left int, right int, value double"
)
PACKED = (
    "struct<feature: array<int>, threshold: array<double>, left: array<int>, right: array<int>, "
    "value: array<double>, roots: array<int>>"
)
MOST_NODES = 200_000
MOST_WALKED = 1_000_000  # as arrays, for ``score_parts``
DENSE_VALUES = 1 << 22  # values of rows that are laid out by column at a time
DEEPEST = 30  # the deepest tree the engine grows

Lookup = Callable[[Column], Column]


def dense(features: str = "features") -> Lookup:
    """Reads a column of a vector by its number."""
    values = vector_to_array(F.col(features))
    return lambda at: F.get(values, at)


def sparse(indices: str, values: str) -> Lookup:
    """Reads a column of a row kept as the numbers of its non-zero columns and their values."""
    def read(at: Column) -> Column:
        place = F.array_position(F.col(indices), at).cast("int")
        return F.coalesce(F.get(F.col(values), place - 1), F.lit(0.0))

    return read


@dataclass(frozen=True)
class TreeTable:
    """``base + weight * (sum of the trees' values)``."""

    nodes: DataFrame
    n_trees: int
    base: float
    weight: float
    depth: int

    def first_trees(self, n: int) -> TreeTable:
        """The model of the first ``n`` trees; a mean over trees stays a mean."""
        mean = abs(self.weight * self.n_trees - 1) < 1e-9
        kept = self.nodes.where(F.col("tree") < n)
        return replace(self, nodes=kept, n_trees=n, weight=1 / n if mean else self.weight)

    def cut_at(self, depth: int) -> TreeTable:
        """The same trees, read no deeper than ``depth``."""
        return replace(self, depth=min(depth, self.depth))

    def save(self, path: str) -> None:
        facts = [(self.n_trees, self.base, self.weight, self.depth)]
        spark = self.nodes.sparkSession
        self.nodes.write.parquet(f"{path}/nodes")
        spark.createDataFrame(facts, "n_trees int, base double, weight double, depth int").coalesce(
            1
        ).write.json(f"{path}/model")

    def blocks(self, most_nodes: int = MOST_NODES) -> list[tuple[int, int]]:
        """Runs of trees (first, last) of at most ``most_nodes`` nodes, or of one tree."""
        sizes = self.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()
        runs: list[list[int]] = []
        for row in sorted(sizes, key=lambda r: r["tree"]):  # one row per tree
            if runs and runs[-1][2] + row["n"] <= most_nodes:
                runs[-1][1:] = [row["tree"], runs[-1][2] + row["n"]]
            else:
                runs.append([row["tree"], row["tree"], row["n"]])
        return [(first, last) for first, last, _ in runs]

    def score(
        self, df: DataFrame, look: Lookup, name: str = "y_pred", most_nodes: int = MOST_NODES
    ) -> DataFrame:
        """Add the prediction; ``look`` reads a feature of a row by its number."""
        runs = self.blocks(most_nodes)
        total = F.lit(0.0)
        for i, (first, last) in enumerate(runs):
            part = _sum_of_trees(_packed(self.nodes, first, last), self.depth, look)
            if len(runs) == 1:
                total = part
            else:
                kept = F.col("_total") if i else F.lit(0.0)
                df = materialise(df.withColumn("_total", kept + part), "scored")
                total = F.col("_total")
        return df.withColumn(name, F.lit(self.base) + self.weight * total).drop("_total")

    def score_parts(
        self, df: DataFrame, parts: Sequence[tuple[int, int]], name: str = "y_preds", most_nodes: int = MOST_WALKED
    ) -> DataFrame:
        """Add the array of the predictions of the models that use only (trees, depth) of this one, of rows
        kept as ``indices`` and ``values``: a tree is walked once for all of them."""
        runs = self.blocks(most_nodes)
        df = df.withColumn("_sums", F.array(*[F.lit(0.0)] * len(parts)))
        for first, last in runs:
            own = _walker(self.nodes, first, last, [(n, min(depth, self.depth)) for n, depth in parts])
            df = df.withColumn("_sums", F.zip_with("_sums", own("indices", "values"), lambda a, b: a + b))
            if len(runs) > 1:
                df = materialise(df, "scored")
        weights = [self.first_trees(n).weight for n, _ in parts]
        scaled = [F.lit(self.base) + w * F.get("_sums", F.lit(i)) for i, w in enumerate(weights)]
        return df.withColumn(name, F.array(*scaled)).drop("_sums")


def padded(indices: pd.Series, values: pd.Series, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse rows as two matrices: column numbers, behind a row's last one -1, and values, there 0."""
    sizes = indices.map(len).to_numpy(np.int64)
    wide = max(int(sizes.max(initial=0)), 1) if width is None else width
    own = np.arange(wide) < sizes[:, None]
    columns, numbers = np.full(own.shape, -1, np.int64), np.zeros(own.shape)
    if own.any():
        columns[own], numbers[own] = np.concatenate(indices.to_list()), np.concatenate(values.to_list())
    return columns, numbers


def _walker(nodes: DataFrame, first: int, last: int, parts: Sequence[tuple[int, int]]) -> Callable[..., Column]:
    """A function of sparse rows: for each of ``parts`` the sum of the values its trees reach."""
    found = nodes.where(F.col("tree").between(first, last)).toArrow().to_pandas().sort_values(["tree", "node"])
    trees = {
        int(t): [own[c].to_numpy() for c in ("feature", "left", "right")] + [own[c].to_numpy(float) for c in ("threshold", "value")]
        for t, own in found.groupby("tree")  # at most MOST_WALKED nodes, or one tree
    }
    depths = sorted({depth for _, depth in parts})
    asked = np.unique([f for feature, *_ in trees.values() for f in np.unique(feature[feature >= 0])]).astype(np.int64)
    for own in trees.values():  # a column's place among those that are asked for
        own[0] = np.searchsorted(asked, own[0])

    def walked(columns: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros((len(columns), len(parts)))
        dense = np.zeros((max(len(asked), 1), len(columns)))
        if len(asked):
            place = np.minimum(np.searchsorted(asked, columns), len(asked) - 1)
            row, j = np.nonzero(asked[place] == columns)
            dense[place[row, j], row] = numbers[row, j]
        for t, (feature, left, right, threshold, value) in trees.items():
            at, level, rows = np.zeros(len(columns), np.int64), 0, np.arange(len(columns))
            for depth in depths:
                while level < depth:
                    level += 1
                    rows = rows[left[at[rows]] >= 0]
                    here = at[rows]
                    at[rows] = np.where(dense[feature[here], rows] <= threshold[here], left[here], right[here])
                for i, (n, wanted) in enumerate(parts):
                    if t < n and wanted == depth:
                        out[:, i] += value[at]
        return out

    @F.pandas_udf("array<double>")
    def sums(indices: pd.Series, values: pd.Series) -> pd.Series:
        columns, numbers = padded(indices, values)
        some = max(1, DENSE_VALUES // max(len(asked), 1))
        out = [walked(columns[i : i + some], numbers[i : i + some]) for i in range(0, len(columns), some)]
        return pd.Series([row for part in out for row in part])

    return sums


def load(spark: SparkSession, path: str) -> TreeTable:
    facts = spark.read.schema("n_trees int, base double, weight double, depth int").json(
        f"{path}/model"
    ).first()
    nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
    return TreeTable(nodes, facts["n_trees"], facts["base"], facts["weight"], facts["depth"])


def _packed(nodes: DataFrame, first: int, last: int) -> Column:
    """The nodes of a run of trees as one constant: parallel arrays, and the places of the roots.

    Children become places in the arrays. A leaf has no threshold; it is given one.
    """
    ordered = F.array_sort(
        F.collect_list(F.struct("tree", "node", "feature", "threshold", "left", "right", "value"))
    )
    some = nodes.where(F.col("tree").between(first, last)).agg(ordered.alias("n"))

    def child(side: str) -> Column:
        return F.transform(
            "n", lambda x, i: F.when(x["left"] < 0, F.lit(-1)).otherwise(i - x["node"] + x[side])
        ).alias(side)

    roots = F.transform("n", lambda x, i: F.when(x["node"] == 0, i).otherwise(F.lit(-1)))
    threshold = F.transform("n", lambda x: F.coalesce(x["threshold"], F.lit(0.0)))
    packed = F.struct(
        F.col("n.feature").alias("feature"), threshold.alias("threshold"),
        child("left"), child("right"), F.col("n.value").alias("value"),
        F.filter(roots, lambda i: i >= 0).alias("roots"),
    )
    # At most MOST_NODES nodes, or one tree. Parsing a constant is done once, by the optimizer.
    return F.from_json(F.lit(some.select(F.to_json(packed)).first()[0]), PACKED)


def _sum_of_trees(packed: Column, depth: int, look: Lookup) -> Column:
    """Walk every tree from its root, one level a step, and add up the values reached."""
    def of(field: str, at: Column) -> Column:
        return F.get(packed[field], at)

    def step(at: Column, _: Column) -> Column:
        goes_left = look(of("feature", at)) <= of("threshold", at)
        return (
            F.when(of("left", at) < 0, at)
            .when(goes_left, of("left", at))
            .otherwise(of("right", at))
        )

    levels = F.array(*[F.lit(i) for i in range(max(depth, 1))])
    if depth == 0:
        return F.aggregate(packed["roots"], F.lit(0.0), lambda s, r: s + of("value", r))
    return F.aggregate(
        packed["roots"], F.lit(0.0), lambda s, r: s + of("value", F.aggregate(levels, r, step))
    )


def of_forest(spark: SparkSession, model: RandomForestRegressionModel, depth: int) -> TreeTable:
    """The stored rows of a fitted forest: saving writes its nodes as a table, which is read back."""
    path = new_path(spark, "forest")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    nodes = stored.select(
        "tree", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        F.col("prediction").alias("value"),
    )
    n = model.getNumTrees
    return TreeTable(nodes, n, 0.0, 1 / n, depth)


def rows_of_tree(
    model: DecisionTreeRegressionModel,
    number: int,
    feature: Callable[[int], int] = lambda f: f,
    threshold: Callable[[int, float], float] = lambda f, t: t,
) -> list[tuple]:
    """Node rows of one small tree (of the boosting depth), with its columns and bounds renamed."""
    rows: list[tuple] = []

    def add(node) -> int:
        at = len(rows)
        rows.append(())
        if node.subtreeDepth() == 0:
            rows[at] = (number, at, -1, None, -1, -1, float(node.prediction()))
        else:
            split = node.split()
            f, t = split.featureIndex(), split.threshold()
            left, right = add(node.leftChild()), add(node.rightChild())
            rows[at] = (
                number, at, feature(f), float(threshold(f, t)), left, right,
                float(node.prediction()),
            )
        return at

    add(model._java_obj.rootNode())
    return rows
