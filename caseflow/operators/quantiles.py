"""Exact interpolated quantiles without holding all values in one task.

The built-in ``percentile`` merges a map of every distinct value into one task per group.
Here equal values are counted first (map-side combine, then a shuffle by value, so a hot
value costs nothing), the distinct values are dealt into ranges that hold about as many of them
each, however closely they lie, the counts are summed by range, and only the few ranges that
contain a wanted rank are ordered value by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators import sampling


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``(by..., prob, quantile)``: linear interpolation between the two nearest ranks.

    Null values are ignored. ``weight`` names a count column of pre-counted values. ``by``
    must be a bounded grouping (folds, features): its targets are broadcast, at most
    ``2 * len(probs)`` per group.
    """
    by = list(by)
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = sampling.ranged(
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(amount.alias("_n")),
        [*by, "_v"],
    )

    everything = Window.partitionBy(*by)
    ranges = (
        counts.groupBy(*by, "_part")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(everything.orderBy("_part")))
        .withColumn("_total", F.sum("_n").over(everything))
    )
    before = F.col("_upto") - F.col("_n")
    wanted, inside = [], F.lit(False)
    for prob in probs:
        position = F.lit(float(prob)) * (F.col("_total") - 1)
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            inside = inside | ((rank >= before) & (rank < F.col("_upto")))
            wanted.append(
                F.struct(
                    F.lit(float(prob)).alias("prob"),
                    F.lit(side).alias("side"),
                    rank.cast("long").alias("rank"),
                    (position - F.floor(position)).alias("share"),
                )
            )
    targets = (
        ranges.where(inside)
        .withColumn(
            "_targets",
            F.filter(
                F.array(*wanted),
                lambda t: (t["rank"] >= before) & (t["rank"] < F.col("_upto")),
            ),
        )
        .select(*by, "_part", before.alias("_before"), "_targets")
    )

    within = Window.partitionBy(*by, "_part").orderBy("_v")
    hits = (
        counts.join(F.broadcast(targets), [*by, "_part"])
        .withColumn("_last", F.col("_before") + F.sum("_n").over(within))
        .select(*by, "_v", "_n", "_last", F.explode("_targets").alias("_t"))
        .where(
            (F.col("_t.rank") >= F.col("_last") - F.col("_n"))
            & (F.col("_t.rank") < F.col("_last"))
        )
    )
    low = F.max(F.when(F.col("_t.side") == "low", F.col("_v")))
    high = F.max(F.when(F.col("_t.side") == "high", F.col("_v")))
    return hits.groupBy(*by, F.col("_t.prob").alias("prob")).agg(
        (low + (high - low) * F.max("_t.share")).alias("quantile")
    )


def quantile_values(
    df: DataFrame, value: str, probs: Sequence[float], weight: str | None = None
) -> list[float | None]:
    """Quantiles of one column as plain numbers, one per probability: a job that returns
    ``len(probs)`` rows. As literals they can be pushed into later scans."""
    found = {r["prob"]: r["quantile"] for r in exact_quantiles(df, value, probs, weight=weight).collect()}
    return [found.get(float(p)) for p in probs]
