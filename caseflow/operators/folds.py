"""Quantile bins of the target and stratified, shuffled, reproducible folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators import quantiles, sampling
from caseflow.schema import KEY, N_SPLITS, SEED, STRAT_BINS

EDGE_DIGITS = 9  # edges and values are compared at this precision


def inner_edges(df: DataFrame, value: str, n_bins: int, weight: str | None = None) -> list[float]:
    """Edges between the bins, without empty bins: edges equal to the lowest or highest value
    are dropped, and so are repeats."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    found = quantiles.quantile_values(df, value, probs, weight)
    edges = sorted({round(e, EDGE_DIGITS) for e in found if e is not None})
    return edges[1:-1]


def bin_code(value: Column, edges: list[float]) -> Column:
    """Right-closed bin of ``value``: how many inner edges lie strictly below it."""
    code = F.lit(0)
    for edge in edges:
        code = code + (value > F.lit(edge)).cast("int")
    return code


def quantile_bins(df: DataFrame, n_bins: int = STRAT_BINS, value: str = "y") -> DataFrame:
    """Add ``y_bin``: code of the equal-count bin, 0 .. at most ``n_bins - 1``.

    ``df`` is read twice (edges, then codes): pass a written stage table. Equal values are
    counted before they are rounded.
    """
    rounded = F.round(F.col(value), EDGE_DIGITS)
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    edges = inner_edges(counted.select(rounded.alias("_y"), "_rows"), "_y", n_bins, "_rows")
    marked = df.withColumn("_rounded", rounded)  # once for all edges
    return marked.withColumn("y_bin", bin_code(F.col("_rounded"), edges)).drop("_rounded")


def stratified_folds(
    binned: DataFrame, n_splits: int = N_SPLITS, seed: int = SEED, key: str = KEY
) -> DataFrame:
    """Add ``fold``: rows are dealt out in turn, bin after bin, in hash order within a bin.

    Every bin is spread over all folds (counts differ by at most one) and fold sizes differ
    by at most one overall.
    """
    dealt = sampling.hash_rank(binned, key, str(seed), after=["y_bin"])
    return dealt.withColumn("fold", (F.col("position") % n_splits).cast("int")).drop("position")


def fold_sizes(df: DataFrame) -> DataFrame:
    """``(fold, n_train, n_test)``; train is everything else."""
    sizes = df.groupBy("fold").agg(F.count(F.lit(1)).alias("n_test"))
    everyone = Window.partitionBy(F.lit(0))  # one row per fold
    return sizes.select(
        "fold", (F.sum("n_test").over(everyone) - F.col("n_test")).alias("n_train"), "n_test"
    )


def test_rows(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("fold") == fold)


def train_rows(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("fold") != fold)


def other_folds(stats: DataFrame, n_splits: int | None) -> DataFrame:
    """Turn per-fold statistics into train statistics of every split.

    Each small row ``(fold, ...)`` is handed to all splits but its own, as ``split``; grouping
    by ``split`` then sees exactly what training on the other folds would see. The table
    itself is aggregated once, not once per split. Without ``n_splits`` all rows are train
    rows of the one split 0.
    """
    if n_splits is None:
        return stats.withColumn("split", F.lit(0)).drop("fold")
    splits = F.array(*[F.lit(i) for i in range(n_splits)])
    others = F.filter(splits, lambda i: i != F.col("fold"))
    return stats.withColumn("split", F.explode(others)).drop("fold")
