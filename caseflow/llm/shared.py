"""What several text operators need: reliable checkpoints, stable document keys, small caches in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word or a line: space and the five ASCII controls.
SPACE = r"[\x20\x09-\x0D]+"
#: Bits of the filter in front of a join that fetches few texts, and of one of its rows.
FILTER_BITS, PART_BITS = 1 << 24, 1 << 15


def checkpoint_ready(spark: SparkSession) -> None:
    """Make checkpoint() usable: the session's own folder, or one in the warehouse where none is set."""
    if spark.sparkContext.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        where = given or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(where)


def held(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder and cut off from their lineage."""
    checkpoint_ready(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, at most so many rows go to Python at a time; for eager work on wide rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def doc_key(id_col: str, text_col: str) -> Column:
    """A key of a document's row that also holds for null and repeated ids.

    Rows with equal id and equal text are one document to every operator that joins by this key.
    """
    return F.struct(
        F.col(id_col).isNull().alias("none"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
    )


def prefiltered(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """texts(hash, ...) without most rows whose hash is not in wanted(text_hash).

    A bitmap of fixed size is broadcast (FILTER_BITS / 8 bytes, whatever the table); it lets every
    wanted row pass, so that the join behind it moves little else.
    """
    def parts(c: Column) -> tuple[Column, Column]:
        bit = F.pmod(c, F.lit(FILTER_BITS))
        return F.floor(bit / PART_BITS).cast("int"), F.pmod(bit, F.lit(PART_BITS))

    part, at = parts(F.col("text_hash"))
    bitmap = wanted.select(part.alias("part"), at.alias("at")).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    part, at = parts(F.col("hash"))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_bit = F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
    met = texts.withColumn("part", part).join(F.broadcast(bitmap), "part")
    return met.where(set_bit).select(*texts.columns)


class BoundedCache(dict):
    """A dict that fills itself from a function and starts anew when it has grown to its bound."""

    def __init__(self, make, bound: int = 60_000, longest: int = 64):
        super().__init__()
        self.make, self.bound, self.longest = make, bound, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.bound:
                self.clear()
            self[key] = value
        return value
