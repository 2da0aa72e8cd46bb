"""Language identification: held-out accuracy, undetermined texts, sparsity, calibration."""

import zlib

import numpy as np
from caseflow.llm import language, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert found[1] > 150 and found[0] >= 0.98


def test_query_on_odd_rows(spark, folder, rows):
    got = queries.op2_language_id(spark, folder).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id not in (3, None)}
    for i, t, *_ in rows:
        if i in (3, None):
            continue
        r = by_id[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
        assert r.lang_pred in ("aa", "bb", "und") and 0 <= r.score <= 1


def test_nothing_to_learn_from(spark, empty_folder, table):
    assert queries.op2_language_id(spark, empty_folder).collect() == []
    model = language.train(table.withColumn("lang", F.lit(None).cast("string")), "text", "lang", F.col("doc_id"))
    got = language.identify(table, model)
    assert {r.lang_pred for r in got.collect()} == {"und"}


def test_one_language(table):
    model = language.train(table.withColumn("lang", F.lit("xx")), "text", "lang", F.col("doc_id"))
    assert model.predict("some words") == ("xx", 1.0)


def test_long_text_in_parts(monkeypatch):
    text = "abc déf 12 ghi " * 50
    want = language.gram_counts(text)
    monkeypatch.setattr(language, "AT_ONCE", 17)
    assert (language.gram_counts(text) == want).all()


def test_elastic_net_leaves_zero_weights():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        slots = np.unique(np.append(rng.integers(10, 2000, 20), i % 2))
        rows.append((slots, np.full(len(slots), 0.2), i % 2))
    weights, _ = language.fit_weights(rows, 2, rate=1.0, l1=0.5, l2=0.01, rounds=2)
    assert (weights[:2] != 0).all() and (weights[10:2000] == 0).mean() > 0.5


def test_temperature_softens_wrong_certainty():
    logits = np.array([[5.0, 0.0]] * 10)
    assert language.fit_temperature(logits, np.array([0] * 6 + [1] * 4)) > 5
