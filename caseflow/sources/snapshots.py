"""Dated snapshots of raw tickets: landed CSV pages, digest, manifest, discovery.

A snapshot root holds one ``snapshot_date=YYYY-MM-DD`` folder per delivery, with any number
of CSV page files inside.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import text
from caseflow.schema import KEY, RAW_COLUMNS, text_schema

DEFAULT_LIMIT = 200_000
PAGE_ROWS = 50_000
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def select_tickets(
    df: DataFrame,
    select: Sequence[str] = RAW_COLUMNS,
    where: str = "",
    limit: int | None = None,
    order_by: Sequence[str] = (KEY,),
) -> DataFrame:
    """Source query: projection, optional predicate (blank = none), optional exact row cap.

    Projection and predicate reach the scan. The cap takes the first rows by key, then by all
    other columns, so the same snapshot always gives the same rows.
    """
    if where.strip():
        df = df.where(where.strip())
    if limit is not None:
        rest = [c for c in df.columns if c not in order_by]
        df = df.orderBy(*order_by, *rest).limit(limit)
    return df.select(*select)


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS, multi_line: bool = False
) -> DataFrame:
    """CSV with a header in every file, all columns text, missing-value spellings as null."""
    lines = (
        spark.read.schema(text_schema(list(columns)))
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    return lines.select(*[text.na_to_null(F.col(c)).alias(c) for c in columns])


def scan_pages(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = RAW_COLUMNS,
    limit: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All landed pages as one table plus ``page`` (the file name), which carries page order.

    Headers are dropped per page. With ``limit`` the rows of the first pages are taken, whole
    pages in order and the last one by key, until the cap is reached exactly.
    """
    lines = (
        spark.read.schema(text_schema(list(columns)))
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
        .select("*", F.col("_metadata.file_name").alias("page"))
    )
    pages = lines.select(*[text.na_to_null(F.col(c)).alias(c) for c in columns], "page")
    if limit is None:
        return pages
    first = ["page", KEY] if KEY in columns else ["page"]
    return pages.orderBy(*first, *[c for c in columns if c not in first]).limit(limit)


def write_pages(df: DataFrame, path: str, page_rows: int = PAGE_ROWS) -> None:
    """Land a snapshot as CSV pages of at most ``page_rows`` rows, header in each."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", page_rows)
        .csv(path)
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes, sha256)`` per page file, read in parallel.

    A file is hashed whole, as one value of at most 2 GB: land large snapshots as pages.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def snapshot_digest(spark: SparkSession, path: str) -> DataFrame:
    """``(n_files, bytes, sha256)`` of a snapshot.

    One file: its own digest. Several pages: the digest of the sorted page digests (one short
    text per file, so the list stays small).
    """
    pages = file_digests(spark, path)
    ordered = F.sort_array(F.collect_list("sha256"))
    return pages.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("bytes").alias("bytes"),
        F.when(F.count(F.lit(1)) == 1, F.first("sha256"))
        .otherwise(F.sha2(F.array_join(ordered, "").cast("binary"), 256))
        .alias("sha256"),
    )


def manifest(
    spark: SparkSession,
    path: str,
    source: str,
    limit: int | None = None,
    page_rows: int = PAGE_ROWS,
    select: Sequence[str] = RAW_COLUMNS,
    where: str = "",
) -> DataFrame:
    """What was fetched, when and from where, with size and digest; one row, for JSON."""
    predicate = where.strip()
    return snapshot_digest(spark, path).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at_utc"),
        F.lit(source).alias("source"),
        F.lit(limit).cast("long").alias("limit"),
        F.lit(page_rows).alias("chunk_size"),
        F.struct(
            F.lit(",".join(select)).alias("select"),
            F.lit(predicate or None).cast("string").alias("where"),
        ).alias("query"),
        F.lit(path).alias("snapshot"),
        "n_files",
        F.col("bytes").alias("file_bytes"),
        "sha256",
    )


def date_tag(name: Column) -> Column:
    """The date at the end of a file or folder name; today's date (UTC) when there is none."""
    found = F.regexp_extract(name, DATE_IN_NAME + r"(\.[A-Za-z]+)?/?$", 1)
    return F.when(found != "", found).otherwise(F.date_format(F.current_timestamp(), "yyyy-MM-dd"))


def latest_snapshot(snapshots: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows of the newest delivery.

    The newest date comes from the folder names in the table's file listing, without a job;
    as a literal it prunes the scan to that one partition.
    """
    folder = re.compile(rf"/{re.escape(column)}=([^/]+)/")
    found = {m[1] for m in map(folder.search, snapshots.inputFiles()) if m}
    if not found:
        raise FileNotFoundError("no snapshot has been landed yet")
    return snapshots.where(F.col(column) == F.lit(max(found)))


def row_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(n_rows, digest)``: the sum of a 32-bit part of every row's md5, which no order and no
    layout of the files changes. Null and empty values differ."""
    shown = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in columns]
    part = F.conv(F.substring(F.md5(F.concat_ws("|", *shown)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(part).alias("digest"))
