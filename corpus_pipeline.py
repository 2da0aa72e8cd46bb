"""Training-data pipeline over the documents table, a stage for each function in STAGES.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame: the
first four return the columns of documents, the last adds tokens to the id. run() chains them; a caller
may as well write each stage's rows and read them again for the next.
"""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import bpe, decontaminate, language, lines, simhash
from caseflow.llm.queries import language_model

#: Texts that a stage sends to Python at a time: workers keep what a batch took, stage after stage.
TEXTS_AT_ONCE = 1000


def in_small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers for what the session runs from here on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXTS_AT_ONCE:
        spark.conf.set(name, str(TEXTS_AT_ONCE))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told: those that the operator leaves undetermined, because they
    are null or hold no letter, go. All others stay, however alike two languages are in them.

    The model learns from the stage's own input; a null label is filled with the prediction.
    """
    in_small_batches(spark)
    columns = docs.columns
    whole = docs.select(F.struct(*columns).alias("row"), F.col("text").alias("text"))
    found = language.identify(whole, language_model(docs))
    known = found.where(F.col("lang_pred") != language.UNDETERMINED)
    return known.select(*(F.coalesce("row.lang", "lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line has; empty ones go."""
    in_small_batches(spark)
    kept = lines.apply(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    in_small_batches(spark)
    return simhash.keep_one(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exact or edited."""
    in_small_batches(spark)
    return decontaminate.clean_only(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives its text back."""
    in_small_batches(spark)
    path, pattern = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN
    ids = bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"), path, pattern)
    both = bpe.decode_documents(ids, path, pattern)
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    return both.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", (F.col("decoded") == text).alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_copies),
    ("bpe_encoding", encode),
]

#: Models, fingerprints and edit distances cannot be written in SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
