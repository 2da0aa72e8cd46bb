"""Seeded order, samples and hold-outs by the md5 of the key.

The order is the same on every run and every cluster size. Ranks are two-level: rows are dealt
into ranges of the order, counts per range give each its offset, and only rows of one range are
ordered against each other, so no task ever sorts a whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.session import materialise

PREFIX_DIGITS = 4  # hexadecimal digits: 65,536 prefixes
RANK_DIGITS = 3  # 4,096 ranges for each group


def key_hash(key: str, label: str) -> Column:
    return F.md5(F.concat(F.lit(f"{label}:"), F.col(key)))


def _prefix(digits: int = PREFIX_DIGITS) -> Column:
    return F.substring("_hash", 1, digits)


def ranged(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """``df``, written in ranges of the order, with ``_part``: the number of a row's range.

    The ranges follow the rows (a sample of them tells the bounds), so each holds about as many
    as the others; the order must tell all rows apart.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialise(
        df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranged"
    )


def range_rank(
    df: DataFrame, order: Sequence[str], name: str = "position", parts: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row in the order, which must tell all rows apart.

    Ranges of the order are counted; the counts (one number for each range) give each its offset,
    and rows are only ordered against those of their own range.
    """
    written = ranged(df, order, parts)
    sizes = {r["_part"]: r["count"] for r in written.groupBy("_part").count().collect()}
    offsets, upto = [], 0
    for part in range(max(sizes, default=-1) + 1):
        offsets.append(upto)
        upto += sizes.get(part, 0)
    start = F.get(F.lit(offsets).cast("array<bigint>"), F.col("_part")) if offsets else F.lit(0)
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return written.withColumn(name, (local + start - 1).cast("long")).drop("_part")


def hash_rank(
    df: DataFrame, key: str, label: str, after: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row in the order (``after``..., hash).

    Hashes lie evenly, so their prefixes are ranges of the order that need no sample: one pass
    counts the rows of each, which gives its offset, and the rows move once, to be ordered in
    their range. ``df`` is read twice: pass a written table or a plain selection of one.
    ``after`` must be a bounded grouping: with each prefix it has an offset, which is broadcast.
    """
    groups = [*after, "_prefix"]
    placed = df.withColumn("_prefix", F.substring(key_hash(key, label), 1, RANK_DIGITS))
    sizes = placed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    upto = F.sum("_size").over(Window.orderBy(*groups))  # one row for each range
    offsets = sizes.select(
        *[F.col(c).alias(f"_{c}_") for c in groups], (upto - F.col("_size")).alias("_before")
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in groups])
    # The hash itself is made anew behind the exchange instead of being moved.
    moved = placed.repartition(*groups).withColumn("_hash", key_hash(key, label))
    local = F.row_number().over(Window.partitionBy(*groups).orderBy("_hash", key))
    return (
        moved.withColumn("_nth", local)
        .join(F.broadcast(offsets), same)
        .select(*df.columns, (F.col("_before") + F.col("_nth") - 1).cast("long").alias(name))
    )


def hash_cutoff(
    df: DataFrame,
    key: str,
    label: str,
    take: Callable[[Column], Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by..., cutoff)``: the hash of the last row taken, ``take(group size)`` rows in all.

    Taking rows is then a plain filter ``hash <= cutoff``, without moving them. Only rows of
    the boundary prefix are ordered. Keys must be unique; groups that take no row are absent.
    """
    by = list(by)
    hashed = df.select(*by, key_hash(key, label).alias("_hash")).withColumn("_prefix", _prefix())
    group = Window.partitionBy(*by)
    need = F.col("_want") - (F.col("_upto") - F.col("_size"))
    boundary = (
        hashed.groupBy(*by, "_prefix")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_upto", F.sum("_size").over(group.orderBy("_prefix")))
        .withColumn("_want", take(F.sum("_size").over(group)).cast("long"))
        .where((need >= 1) & (need <= F.col("_size")))
        .select(*by, "_prefix", need.alias("_need"))
    )
    local = Window.partitionBy(*by, "_prefix").orderBy("_hash")
    return (
        hashed.join(F.broadcast(boundary), [*by, "_prefix"])  # one row per group
        .withColumn("_nth", F.row_number().over(local))
        .where(F.col("_nth") == F.col("_need"))
        .select(*by, F.col("_hash").alias("cutoff"))
    )


def seeded_sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run; 0 or less keeps all."""
    if n <= 0:
        return df
    label = str(seed)
    last = hash_cutoff(df, key, label, lambda total: F.least(F.lit(n), total))
    return df.where(key_hash(key, label) <= last.scalar())


def holdout_size(total: Column, share: float) -> Column:
    return F.ceil(F.lit(share) * total)


def mark_holdout(
    df: DataFrame, share: float, key: str, seed: int, name: str = "is_holdout"
) -> DataFrame:
    """Flag ``ceil(share * rows)`` rows for validation."""
    label = f"holdout:{seed}"
    last = hash_cutoff(df, key, label, lambda total: holdout_size(total, share))
    taken = key_hash(key, label) <= last.scalar()
    return df.withColumn(name, F.coalesce(taken, F.lit(False)))  # no cutoff: nothing is taken
