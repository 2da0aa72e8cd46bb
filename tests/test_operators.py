"""Micro-tables for guards, ties, empty input, and both sides of every switch."""

import hashlib
from datetime import datetime

import pytest
from caseflow.models import boosting, forest
from caseflow.models.training import EarlyStop
from caseflow.operators import clean, encode, evaluate, features, folds, lookup, profile, quantiles, sampling
from caseflow.plans import pipeline
from caseflow.sources import snapshots, tables
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

RAW = "unique_key string, created_date string, closed_date string, agency string"


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_blanks(spark):
    df = spark.createDataFrame([("\t x \n",), ("",), (" nan ",), (None,)], "a string")
    assert [r.a for r in clean.blanks_to_null(df).collect()] == ["x", None, None, None]


def test_funnel_counts_with_date_formats(spark):
    raw = spark.createDataFrame([("1", "2024-01-01T00:00:00", "2024-01-02T00:00:00", "a"), ("2", "01/03/2024", "01/05/2024", "a")], RAW)
    counts = [r.n_rows for r in clean.funnel(raw, mode="none", formats=["MM/dd/yyyy"]).orderBy("step").collect()]
    assert counts == [2] * 8
    interim, funnel = pipeline.build_interim(raw, "none", formats=["MM/dd/yyyy"])
    assert interim.count() == 2 and {r.n_rows for r in funnel.collect()} == {2}


def test_live_funnel_counts_while_it_writes(spark):
    raw = spark.createDataFrame([(str(i % 40), f"2024-01-{1 + i % 28:02d}", None if i % 9 == 0 else f"2024-01-{1 + i % 27:02d}", "a") for i in range(200)], RAW)
    interim, live = pipeline.build_interim_live(raw)
    want = clean.funnel(raw, clean.last_ordered(raw))
    assert rows(live, "step", "stage", "n_rows") == rows(want, "step", "stage", "n_rows")
    assert interim.count() == live.where("stage = 'outlier_filter'").first().n_rows > 0


def test_bucketed_tables_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(500).select(F.col("id").cast("string").alias("unique_key"), F.col("id").alias("v"))
        sides = [tables.write_bucketed(t, n, 4) for t, n in ((left, "left"), (left.where("v % 3 = 0").select("unique_key", F.col("v").alias("w")), "right"))]
        for joined, n in ((features.align_to_target(*sides), 167), (sides[0].join(sides[1], "unique_key"), 167)):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan and joined.count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_and_predictions_are_written(spark, tmp_path):
    preds = spark.createDataFrame([("m", "t", "a", "1", 0, 1.0, 2.0), ("m", "t", "a", "2", 1, 1.0, 0.5)], "model string, tag string, config_id string, unique_key string, fold int, y_true double, y_pred double")
    tables.write_predictions(preds, f"{tmp_path}/preds")
    stored = spark.read.parquet(f"{tmp_path}/preds")
    results = profile.results_from(stored, [])
    tables.write_results(results, f"{tmp_path}/results")
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_path}/results")
    assert rows(back, "row_type", "fold", "mae", "is_best") == rows(results, "row_type", "fold", "mae", "is_best") and back.count() == 3
    assert len(list((tmp_path / "results").glob("part-*.csv"))) == 1


def test_older_valid_row_survives_an_invalid_newer_one(spark):
    raw = spark.createDataFrame([("1", "2024-01-01", "2024-01-02", "a"), ("1", "2024-03-01", "2024-02-01", "b"), ("1", None, "2024-05-01", "c")], RAW)
    assert rows(clean.dated_and_unique(raw), "agency") == [("a",)]


def test_keep_last_has_a_total_order(spark):
    one = [("1", "2024-01-01", "2024-01-02", a) for a in "abc"]
    picked = {rows(clean.keep_last(spark.createDataFrame(p, RAW)), "agency")[0] for p in (one, one[::-1], one[1:] + one[:1])}
    assert picked == {("c",)}
    assert clean.keep_last(spark.range(3)).count() == 3


def test_only_what_is_wanted_is_moved_to_find_the_latest_row(spark):
    """The order is followed down to the last wanted column; the rows are those of the whole order."""
    kind = f"{RAW}, arrival string, borough string, zip string"
    days, texts = ["2024-01-02", "2024-01-03", None], ["a", "b", None]
    data = [(k, "2024-01-01", days[i % 3], texts[i // 3 % 3], texts[i // 9 % 3], texts[i // 5 % 3], texts[i % 2]) for i in range(60) for k in ("1", "2", None)[: 1 + i % 3]]
    raw = spark.createDataFrame(data + data[:9], kind)
    whole = clean.dated_and_unique(raw)
    for keep in (["unique_key"], ["agency"], ["borough"], ["zip", "arrival"], ["no_such_column"], []):
        some = clean.dated_and_unique(raw, keep=keep)
        want = clean.keep_columns(whole, keep)
        assert some.columns == want.columns and rows(some, *some.columns) == rows(want, *want.columns)
    plan = clean.dated_and_unique(raw, keep=["agency"])._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    assert "max(struct(" in plan and "arrival" in plan and "borough" not in plan and "zip" not in plan
    given = clean.keep_last(raw, order=[F.col("closed_date").desc(), F.col("zip").desc()], wanted=["agency"])
    assert given.columns == ["unique_key", "agency"] and given.count() == 3


def test_target_guards(spark):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (0.0,), (5.0,), (None,)], "resolution_time_hours double")
    assert rows(clean.keep_valid_target(df), "resolution_time_hours") == [(0.0,), (5.0,)]
    with pytest.raises(KeyError, match="closed_date"):
        clean.keep_dated(spark.createDataFrame([("x",)], "created_date string"))
    for mode, value in (("no such mode", None), ("percentile", 1.0), ("percentile", 0.0)):
        with pytest.raises(ValueError):
            clean.outlier_limit(df, mode, value)
    assert clean.outlier_limit(df, "none") is None
    with pytest.raises(ValueError):
        features.guard_leakage(["agency", "closed_date"])


def test_weekday_and_median(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 5),), (None,)], "created_date timestamp")
    assert rows(features.with_time_features(df), "created_dayofweek", "created_is_weekend") == [(0, 0)]
    values = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0, None)], "v double")
    assert quantiles.quantile_values(values, "v", [0.5]) == [2.5]
    assert quantiles.quantile_values(values.where("v is null"), "v", [0.5]) == [None]


def test_median_in_a_narrow_band(spark):
    df = spark.range(4001).select((F.lit(40.5) + F.col("id") / 10000).alias("v"))
    assert quantiles.quantile_values(df, "v", [0.5])[0] == pytest.approx(40.7)


def test_fitted_values(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("b", 1), (None, 1)], "c string, fold int")
    assert rows(encode.fit_modes(df, ["c"], n_splits=None), "mode") == [("a",)]
    levels = encode.fit_levels(df.withColumn("n", F.col("fold")), ["c", "n"], n_splits=None)
    assert rows(levels, "feature", "level", "slot") == [("c", "a", 0), ("c", "b", 1), ("n", "0", 2), ("n", "1", 3)]


def test_folds_are_balanced(spark):
    df = spark.range(13).select(F.col("id").cast("string").alias("unique_key"), (F.col("id") % 2).cast("int").alias("y_bin"))
    dealt = folds.stratified_folds(df, 5)
    assert sorted(r["count"] for r in dealt.groupBy("fold").count().collect()) == [2, 2, 3, 3, 3]
    per_bin = [r["count"] for r in dealt.groupBy("fold", "y_bin").count().collect()]
    assert max(per_bin) - min(per_bin) <= 1


def test_many_equal_values_make_no_empty_bins(spark):
    df = spark.createDataFrame([(0.0,)] * 50 + [(float(i),) for i in range(1, 51)], "y double")
    codes = sorted(r.y_bin for r in folds.quantile_bins(df, 10).select("y_bin").distinct().collect())
    assert codes == list(range(len(codes)))


def test_holdout_shares(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("unique_key"))
    for share, n in ((0.0, 0), (0.1, 2), (0.12, 3), (1.0, 20)):
        flags = [r.is_holdout for r in sampling.mark_holdout(df, share, "unique_key", 42).collect()]
        assert sum(flags) == n and None not in flags


def test_rank_is_the_same_for_any_number_of_ranges(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"))
    want = {str(i): n for n, i in enumerate(sorted(range(300), key=lambda i: hashlib.md5(f"s:{i}".encode()).hexdigest()))}
    assert {r.k: r.position for r in sampling.hash_rank(df, "k", "s").collect()} == want
    hashed = df.withColumn("_hash", sampling.key_hash("k", "s"))
    for parts in (1, 3, 50):
        assert {r.k: r.position for r in sampling.range_rank(hashed, ["_hash"], parts=parts).collect()} == want
    assert sampling.range_rank(hashed.where("false"), ["_hash"]).count() == 0


def test_both_ways_to_attach_give_the_same(spark):
    big = spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("on"))
    small = spark.createDataFrame([(0, "x"), (1, "y")], "on long, v string")
    assert lookup.fits_broadcast(small) and not lookup.fits_broadcast(small, 1)
    sides = [rows(lookup.attach(big, small, ["on"], "k", b), "k", "v") for b in (True, False)]
    assert sides[0] == sides[1] and len(sides[0]) == 200


def test_missing_metric_is_never_best(spark):
    df = spark.createDataFrame([("m", "t", "a", None, None), ("m", "t", "b", 2.0, 1.0)], "model string, tag string, config_id string, mae_mean double, rmse_mean double")
    assert rows(evaluate.best_config(df), "config_id") == [("b",)]
    assert rows(evaluate.top_configs(df, 1), "config_id") == [("b",)]
    assert rows(evaluate.compare_models(df), "config_id", "place") == [("b", 1)]


def test_empty_predictions(spark):
    none = spark.createDataFrame([], "y_true double, y_pred double")
    assert profile.pred_vs_true_grid(none).count() == 0
    assert profile.abs_error_by_target(none).count() == 0
    assert profile.residual_hist(none).agg(F.sum("n")).first()[0] == 0


def test_grid_names_are_what_is_fitted():
    assert all(c["max_depth"] <= forest.DEEPEST and f"_d{c['max_depth']}_" in c["config_id"] for c in evaluate.grid_configs("random_forest_regressor"))
    for depth in (40, None):
        with pytest.raises(ValueError, match="deepest"):
            forest.fit(None, {"max_depth": depth})


def test_early_stop():
    stop = EarlyStop(2)
    seen = [stop.improved(x) or stop.done for x in (5, 4, 4.1, 4.2)]
    assert stop.done and stop.best_round == 2 and len(seen) == 4


def test_boosting_learns_a_step(spark):
    data = [(float(i % 2) * 3, ("train", "train", "validate")[i % 3], Vectors.dense(float(i % 2), float(i % 7))) for i in range(600)]
    booster = boosting.fit(spark.createDataFrame(data, ["y", "part", "features"]), rounds=4)
    assert booster.train_mae[-1] < booster.train_mae[0] < 1.5


def test_snapshots(spark, tmp_path):
    df = spark.createDataFrame([("1", "x"), ("1", "a"), ("2", None), ("3", "NA")], "unique_key string, agency string")
    assert rows(snapshots.select_tickets(df, ["unique_key", "agency"], limit=1), "agency") == [("a",)]
    pages = f"{tmp_path}/pages"
    snapshots.write_pages(df.coalesce(1), pages, page_rows=3)
    files = sorted((tmp_path / "pages").glob("part-*.csv"))
    got = snapshots.scan_pages(spark, pages, ["unique_key", "agency"])
    assert len(files) == 2 and rows(got, "unique_key", "agency") == rows(df.withColumn("agency", F.expr("nullif(agency, 'NA')")), "unique_key", "agency")
    assert snapshots.scan_pages(spark, pages, ["unique_key", "agency"], limit=2).count() == 2
    digests = sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in files)
    said = snapshots.manifest(spark, pages, "api").first()
    assert said.n_files == 2 and said.sha256 == hashlib.sha256("".join(digests).encode()).hexdigest() and said.file_bytes == sum(f.stat().st_size for f in files)
    df.withColumn("snapshot_date", F.concat(F.lit("202"), "unique_key", F.lit("-12-31"))).write.partitionBy("snapshot_date").parquet(f"{tmp_path}/all")
    assert rows(snapshots.latest_snapshot(spark.read.parquet(f"{tmp_path}/all")), "unique_key") == [("3",)]
    with pytest.raises(FileNotFoundError):
        snapshots.latest_snapshot(df)
    tags = spark.createDataFrame([("tickets_2026-03-13.csv",), ("no date",)], "n string").select(snapshots.date_tag(F.col("n")).alias("t"))
    assert tags.first().t == "2026-03-13" and len(tags.collect()[1].t) == 10


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("1", "x", 0)], "unique_key string, agency string, fold int")
    for end in ("parquet", "csv"):
        tables.write_interim(df, f"{tmp_path}/t.{end}")
        assert tables.read_interim(spark, f"{tmp_path}/t.{end}", df.columns).count() == 1
    for bad in ("t.txt", "t"):
        with pytest.raises(ValueError):
            tables.read_interim(spark, bad)
        with pytest.raises(ValueError):
            tables.write_interim(df, bad)
    with pytest.raises(ValueError):
        tables.read_interim(spark, f"{tmp_path}/t.csv")
    assert tables.latest_interim(["a_2.csv", "a_1.parquet"]) == "a_1.parquet"
    with pytest.raises(FileNotFoundError):
        tables.latest_interim([])
    for day in ("2024-01-01", "2025-01-01"):
        tables.write_interim(df, f"{tmp_path}/interim/tickets_{day}.parquet")
        tables.write_spec(spark, tables.FeatureSpec(day, "i", "now"), f"{tmp_path}/interim/feature_spec_{day}.json")
    assert tables.find_interim(spark, f"{tmp_path}/interim") == f"{tmp_path}/interim/tickets_2025-01-01.parquet"
    assert tables.find_tag(spark, f"{tmp_path}/interim") == "2025-01-01"
    with pytest.raises(FileNotFoundError):
        tables.find_interim(spark, f"{tmp_path}/nowhere")
    with pytest.raises(FileNotFoundError):
        tables.find_tag(spark, f"{tmp_path}/t.csv")
    tables.write_bundle(df, f"{tmp_path}/bundle")
    assert rows(tables.read_bundle(spark, f"{tmp_path}/bundle").where("fold = 0"), "unique_key") == [("1",)]
    spec = tables.FeatureSpec("t", "i", "now", categorical_cols=["agency"])
    tables.write_spec(spark, spec, f"{tmp_path}/spec")
    assert tables.read_spec(spark, f"{tmp_path}/spec") == spec


def test_a_bundle_writes_its_rows_once(spark, tmp_path):
    """The rows were written four times and moved three times on their way to the folds."""
    import os

    from caseflow import session
    from caseflow.plans import pipeline
    from pyspark.sql import functions as F

    rows = spark.range(300).select(
        F.col("id").cast("string").alias("unique_key"), F.lit("2020-01-05T10:00:00.000").alias("created_date"),
        (F.col("id") % 50).cast("double").alias("resolution_time_hours"), F.lit("a").alias("borough"),
    )
    rows.write.parquet(str(tmp_path / "interim"))
    session.clear(spark)
    bundle = pipeline.build_bundle(spark.read.parquet(str(tmp_path / "interim")))
    folder = session.run_folder(spark).removeprefix("file:")
    wide = [n for n in os.listdir(folder) if "borough" in spark.read.parquet(f"{folder}/{n}").columns]
    assert [n.split("-")[0] for n in wide] == ["bundle"]
    assert sorted(r["count"] for r in bundle.groupBy("fold").count().collect()) == [60] * 5
    plan = bundle.groupBy("fold", "y_bin").count().collect()
    per_bin = {}
    for r in plan:
        per_bin.setdefault(r["y_bin"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in per_bin.values())


def test_hash_rank_is_the_order(spark):
    """Positions follow (group, hash), null groups and keys first; every row has its own."""
    import hashlib

    from caseflow.operators import sampling

    keys = [(str(i), i % 3 if i % 7 else None) for i in range(200)] + [(None, 1)]
    found = sampling.hash_rank(spark.createDataFrame(keys, "k string, g int"), "k", "42", after=["g"]).collect()
    digest = {k: "" if k is None else hashlib.md5(f"42:{k}".encode()).hexdigest() for k, _ in keys}
    want = sorted(keys, key=lambda r: (-1 if r[1] is None else r[1], digest[r[0]]))
    assert [(r["k"], r["g"]) for r in sorted(found, key=lambda r: r["position"])] == want


def test_strip_of_odd_texts(spark):
    from caseflow.functions import text
    from pyspark.sql import functions as F

    odd = ["", " ", "a", " a", "a ", " a b　", "é", "é ", "\ta\x7f", "a\x1c", "nan", None, "x y"]
    got = [r[0] for r in spark.createDataFrame([(o,) for o in odd], "c string").select(text.strip(F.col("c"))).collect()]
    assert got == [o if o is None else o.strip(text.WHITE_SPACE) for o in odd]


def test_predictions_are_not_written_for_each_configuration(spark):
    import os

    from caseflow import session
    from caseflow.operators import evaluate

    rows = [("a", 0, "x", 1.0), ("b", 1, "x", 2.0), ("c", 2, None, 3.0)]
    session.clear(spark)
    df = spark.createDataFrame(rows, "unique_key string, fold int, kind string, y double")
    preds = evaluate.category_mean_predictions(df, "kind", [1, 2], "t", n_splits=3)
    assert preds.count() == 6
    folder = session.run_folder(spark).removeprefix("file:")
    assert [n.split("-")[0] for n in os.listdir(folder)] == ["category_sums"]
