"""The pipeline's stages on awkward rows, chained as run() does it, and on empty tables."""

import corpus_pipeline
from caseflow.llm import decontaminate, simhash
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if i == 2:
            prints = [simhash.fingerprint_of(r.text) for r in docs.collect()]
            assert not any((a ^ b).bit_count() <= 3 for k, a in enumerate(prints) for b in prints[:k])
    assert all(a >= b for a, b in zip(counts, counts[1:])) and counts[0] > counts[2] and counts[3] > counts[4]
    assert docs.where("not round_trip").count() == 0
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect())


def test_brute_force_on_small_table(spark):
    """What stays is what plain code says should stay, stage by stage on the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    stages = dict(corpus_pipeline.STAGES)
    before = stages["language_id"](spark, docs, SF)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in before.collect()} == {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    holds = {r.doc_id for r in docs.collect() if any(t in decontaminate.normal(r.text) for t in items)}
    assert not clean & holds and len(clean) > 80


def test_awkward_rows(spark, folder, table):
    docs = table.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    rows = docs.collect()
    assert rows and all(r.round_trip for r in rows)


def test_empty_table(spark, empty_folder):
    docs = spark.read.parquet(f"{empty_folder}/documents.parquet").withColumn("extra", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, empty_folder)
        assert docs.columns[-1] == "extra" and docs.count() == 0
    assert corpus_pipeline.run(spark, empty_folder).count() == 0
