"""Queries of the text operators over the driver's tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as vocabularies
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloomlm, bpe, decontaminate, divergence, fim, language, lines, pii, secrets, simhash, tokencount, whitening, windows


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the rank file, and the bytes they decode to, as digests."""
    path, pattern = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN
    ids = bpe.encode_documents(_documents(spark, sf_dir).select("doc_id", "text"), path, pattern)
    both = bpe.decode_documents(ids.select("doc_id", "token_ids"), path, pattern)
    listed = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def _held_out(doc_id: Column) -> Column:
    """The documents that no language model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def language_model(docs: DataFrame) -> language.Model:
    """A model learned from the texts and languages of the documents that are not held out."""
    taught = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("doc_id", "text", "lang")
    return language.train(taught, "text", "lang", F.col("doc_id"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model that has not seen the held-out quarter."""
    docs = _documents(spark, sf_dir)
    found = language.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document by passages of fifty words or more that it shares, and those passages."""
    found = windows.repeated_passages(_documents(spark, sf_dir).select("doc_id", "text"))
    listed = F.array_join(F.transform("passages", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return found.select("doc_id", "class_id", "n_links", F.size("passages").cast("long").alias("n_passages"), listed.alias("passages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the strict spans, and all spans."""
    found = pii.redactions(_documents(spark, sf_dir).select("doc_id", "text"))
    names = F.array(*map(F.lit, pii.KINDS))
    named = {c: F.transform(c, lambda x: F.struct(F.get(names, x["kind"]).alias("kind"), x["start"], x["end"])) for c in ("base", "spans")}
    made = found.withColumns(named)
    counts = [_count_of("base", k) for k in pii.KINDS]
    return made.select("row.doc_id", *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, in the order given, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document the numbers of the lines that go: equal to, or one word from, an earlier line."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    gone = lines.removed_lines(docs)
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    met = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left")
    removed = F.coalesce("lines", F.array().cast("array<int>"))
    return met.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def _count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base rules, and all spans."""
    found = secrets.scan(_documents(spark, sf_dir).select("doc_id", "text"))
    kinds = [r.kind for r in secrets.RULES if r.base]
    base = F.filter("secrets", lambda x: x["kind"].isin(kinds))
    counts = [_count_of("secrets", k) for k in kinds]
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))


def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether its distributions fit a language's references."""
    docs = _documents(spark, sf_dir)
    refs, rest = divergence.references(docs)
    judged = divergence.judge(docs.select("doc_id", "text"), refs, rest=rest)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", "class_distance", "word_distance")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    counted = tokencount.count_tokens(docs, vocabularies.path("byte_bpe_50k.json"), vocabularies.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document, exact or edited."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    items = F.array_sort(F.col("matches.item_id"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.size("matches").cast("long").alias("n_items"), items.alias("item_ids"), F.array_min("matches.edits").alias("least_edits"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the leading components, each of unit variance over all of them."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whitening.whiten(vectors, "vec_id", "embedding")


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact base score and the model's score of every document; a seventh of them is not learned from."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    model = bloomlm.learn(docs, "text", ~held_out)
    found = bloomlm.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, form and cuts of every document, with digests of its output and of the text rebuilt from it."""
    made = fim.transform(_documents(spark, sf_dir).select("doc_id", "text"))
    own = F.col("fim")
    again = fim.restored(own["output"], own["form"])
    return made.select(
        "doc_id", own["n"].alias("n"), own["form"].alias("form"), own["prefix_chars"].alias("prefix_chars"), own["middle_chars"].alias("middle_chars"),
        F.sha2(own["output"].cast("binary"), 256).alias("output_sha256"), F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_language_id": op2_language_id,
    "op3_passages": op3_passages,
    "op4_simhash": op4_simhash,
    "op5_pii": op5_pii,
    "op6_line_dedup": op6_line_dedup,
    "op7_secrets": op7_secrets,
    "op8_divergence": op8_divergence,
    "op9_token_counts": op9_token_counts,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_lm_score": op12_lm_score,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: Statements for the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op13_fill_in_middle": r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
         WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
}
