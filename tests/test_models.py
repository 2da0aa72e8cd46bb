"""Stored trees, resumable grids, split candidates, wide encodings: on planted targets and small tables."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from caseflow.models import boosting, candidates, crossval, design, tree_table
from caseflow.models.ledger import Ledger
from caseflow.operators import encode, evaluate, lookup, quantiles, sampling
from caseflow.schema import CATEGORICAL, NUMERIC, TIME_FEATURES
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

CATS = [c for c in CATEGORICAL if c != "city"]
NUMS = NUMERIC + TIME_FEATURES


def planted(spark, n=600, seed=3):
    """A bundle whose target follows two of its columns."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        cats = [f"{c}{rng.randint(0, 3)}" if rng.random() > 0.05 else None for c in CATS]
        nums = [rng.uniform(40, 41), rng.uniform(-74, -73), rng.randint(0, 23), rng.randint(0, 6), rng.randint(1, 12), 0]
        y = 2.0 * (cats[0] == f"{CATS[0]}1") + 3.0 * (nums[0] > 40.5) + rng.gauss(0, 0.1)
        rows.append((f"k{i}", *cats, *nums, y, i % 3))
    kinds = [f"{c} string" for c in ("unique_key", *CATS)] + [f"{c} double" for c in NUMERIC] + [f"{c} int" for c in TIME_FEATURES]
    return spark.createDataFrame(rows, ", ".join([*kinds, "y double", "fold int"])).repartition(3).persist()


@pytest.fixture(scope="module")
def bundle(spark):
    return planted(spark)


@pytest.fixture(scope="module")
def fitted(bundle):
    medians = encode.fit_medians(bundle, NUMS, 3)
    return design.Fitted(encode.fit_modes(bundle, CATS, 3), encode.fit_levels(bundle, CATS, 3), medians, encode.fit_scaling(bundle, NUMS, medians, 3))


CONFIGS = evaluate.grid_configs(crossval.FOREST, {"n_estimators": [2, 3], "max_depth": [3, 6], "min_samples_leaf": [1, 5, 10]})


def grid(bundle, fitted, store, configs=CONFIGS, concurrent=2):
    return crossval.forest_grid(bundle, fitted, CATS, NUMS, configs, "t", 3, store, concurrent)


def test_a_killed_grid_goes_on_with_the_rest(spark, bundle, fitted, tmp_path, monkeypatch):
    """All twelve configurations; the run dies after a few fits, the next one does only the others."""
    store = Ledger(spark, f"{tmp_path}/runs")
    grown, real = [], crossval.forest.fit

    def fragile(train, config):
        if len(grown) == 4:
            raise KeyboardInterrupt("killed")
        grown.append(config["min_samples_leaf"])
        return real(train, config)

    monkeypatch.setattr(crossval.forest, "fit", fragile)
    with pytest.raises(KeyboardInterrupt):
        grid(bundle, fitted, store, concurrent=1)
    halfway = store.finished()
    assert len(grown) == 4 and len(halfway) == 16  # four fits, each for four configurations
    again = []
    monkeypatch.setattr(crossval.forest, "fit", lambda train, config: again.append(config) or real(train, config))
    preds = grid(bundle, fitted, store)
    assert len(again) == 9 - 4 and len(store.finished()) == 36 > len(halfway)
    assert preds.count() == 12 * bundle.count() and preds.select("config_id", "unique_key").distinct().count() == 12 * bundle.count()
    assert grid(bundle, fitted, store).count() == preds.count() and len(again) == 5
    results = evaluate.fold_results(preds)
    assert results.count() == 36 and results.agg(F.max("rmse")).first()[0] < 1.0  # the mean's is about 1.7


def test_what_a_killed_fit_left_is_not_read(spark, bundle, fitted, tmp_path, monkeypatch):
    store, one = Ledger(spark, f"{tmp_path}/runs"), CONFIGS[:1]
    monkeypatch.setattr(tree_table.TreeTable, "save", lambda *_: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        grid(bundle, fitted, store, one)
    assert store.finished() == set() and any(Path(tmp_path).rglob("predictions"))
    monkeypatch.undo()
    assert grid(bundle, fitted, store, one).count() == bundle.count()


def test_saved_models_score_in_a_fresh_session(spark, bundle, fitted, tmp_path):
    store = Ledger(spark, f"{tmp_path}/runs")
    config = CONFIGS[3]
    preds = grid(bundle, fitted, store, [config])
    encoded = design.encoded(fitted, 1, bundle, CATS, NUMS, "again").where("fold = 1")
    encoded.write.parquet(f"{tmp_path}/rows")
    preds.where("fold = 1").select("unique_key", "y_pred").write.parquet(f"{tmp_path}/want")
    place = store.entries().where("fold = 1").first()["place"]
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).parent.parent)!r})
from pyspark.sql import SparkSession, functions as F
from caseflow.models import tree_table
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
model = tree_table.load(spark, {place!r} + "/fitted")
rows = spark.read.parquet("{tmp_path}/rows")
both = model.score(rows, tree_table.sparse("indices", "values"), "own").join(spark.read.parquet("{tmp_path}/want"), "unique_key")
print("off", both.count(), both.agg(F.max(F.abs(F.col("own") - F.col("y_pred")))).first()[0])
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert said[-3:-1] == ["off", str(bundle.where("fold = 1").count())] and float(said[-1]) < 1e-12
    with pytest.raises(KeyError):
        store.fitted(("no", "such", 1))


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(1)
    rows = [(rng.random(), Vectors.sparse(6, {0: rng.random(), 2: rng.random(), 3: float(rng.randint(0, 1))})) for _ in range(1500)]
    df = spark.createDataFrame(rows, ["y", "features"]).repartition(3)
    return df.persist()


def farthest(df):
    return df.agg(F.max(F.abs(F.col("prediction") - F.col("y_pred")))).first()[0]


def test_scores_equal_the_fitted_object(spark, vectors):
    forest = RandomForestRegressor(labelCol="y", numTrees=8, maxDepth=9, seed=1, featureSubsetStrategy="all")
    whole = forest.fit(vectors)
    table = tree_table.of_forest(spark, whole, 9)
    assert farthest(table.score(whole.transform(vectors), tree_table.dense())) < 1e-12
    assert len(table.blocks(300)) > 2  # scored in blocks of trees, with the same result
    assert farthest(table.score(whole.transform(vectors), tree_table.dense(), most_nodes=300)) < 1e-12
    shallow = forest.copy({forest.maxDepth: 4}).fit(vectors)
    assert farthest(table.cut_at(4).score(shallow.transform(vectors), tree_table.dense())) < 1e-12
    first = whole.trees[0].transform(vectors)
    assert farthest(table.first_trees(1).score(first, tree_table.dense())) < 1e-12
    stump = forest.copy({forest.maxDepth: 0}).fit(vectors)
    assert farthest(tree_table.of_forest(spark, stump, 0).score(stump.transform(vectors), tree_table.dense())) < 1e-12


def test_plan_does_not_grow_with_the_trees(spark, vectors):
    def steps(n):
        rows = [r for i in range(n) for r in ((i, 0, 0, 0.5, 1, 2, 0.0), (i, 1, -1, None, -1, -1, 1.0), (i, 2, -1, None, -1, -1, 2.0))]
        table = tree_table.TreeTable(spark.createDataFrame(rows, tree_table.NODES), n, 0.0, 0.1, 6)
        plan = table.score(vectors, tree_table.dense())._jdf.queryExecution().optimizedPlan()
        return plan.numberedTreeString().count("\n")
    assert steps(1) == steps(100)


def test_small_tree_rows(spark, vectors):
    tree = DecisionTreeRegressor(labelCol="y", maxDepth=5, seed=1).fit(vectors)
    rows = tree_table.rows_of_tree(tree, 0)
    table = tree_table.TreeTable(spark.createDataFrame(rows, tree_table.NODES), 1, 0.0, 1.0, 5)
    assert farthest(table.score(tree.transform(vectors), tree_table.dense())) == 0


def test_split_candidates_on_ties(spark):
    rng = random.Random(2)
    rows = [([rng.random(), float(rng.randint(0, 3)), float(int(rng.expovariate(0.02))), 5.0, None if i % 9 == 0 else float(i % 21), 0.0 if i % 4 else rng.random(), None],) for i in range(3000)]
    df = spark.createDataFrame(rows, "x array<double>").repartition(4)
    found = candidates.split_candidates(df, "x")
    for f in range(6):
        v = np.array([r[0][f] for r in rows if r[0][f] is not None])
        own = np.unique(v)
        want = own if len(own) <= 20 else np.unique(np.percentile(v, np.linspace(0, 100, 20), method="inverted_cdf"))
        assert found[f] == want.tolist() and len(found[f]) <= 20
    for r in df.select("x", candidates.codes(F.col("x"), [*found, []]).alias("code")).limit(200).collect():
        assert [c for x, c in zip(r.x, r.code) if x is not None] == [sum(p < x for p in own) for x, own in zip(r.x, found) if x is not None]


def test_sketch_is_close_beyond_its_size(spark):
    df = spark.range(60_000).select(F.array(F.col("id").cast("double")).alias("x")).repartition(4)
    found = candidates.split_candidates(df, "x", keep=512)[0]
    assert len(found) == 20 and all(abs(p - i / 19 * 60_000) < 600 for i, p in enumerate(found))


def test_boosting_splits_at_places_and_learns(spark, bundle):
    table = design.boosting_table(bundle, 0)
    booster = boosting.fit(table, rounds=12)
    test = boosting.predict(booster, table.where("part = 'test'"))
    r = test.agg(evaluate.rmse().alias("rmse"), F.stddev_pop("y_true").alias("mean")).first()
    assert r.rmse < 0.5 * r.mean
    n = len(booster.places)
    used = {(f, t) for tree in booster.trees for _, _, f, t, *_ in tree if f >= 0}
    assert used and all(t in booster.places[f] if f < n else t == 0.5 for f, t in used)
    assert all(len(p) <= 20 for p in booster.places)


def test_boosting_scores_equal_its_rounds(spark):
    """The stored trees, by values, give the training error that the coded rounds had."""
    rng = random.Random(4)
    data = [(3 * (x > 0.3) + rng.gauss(0, 0.2), ("train", "train", "validate")[i % 3], Vectors.dense(x, rng.random())) for i, x in enumerate(rng.random() for _ in range(900))]
    table = spark.createDataFrame(data, ["y", "part", "features"]).persist()
    booster = boosting.fit(table, rounds=5, patience=9)
    booster.best_round = 5
    for part, seen in (("train", booster.train_mae), ("validate", booster.validate_mae)):
        own = booster.score(table.where(F.col("part") == part)).agg(F.avg(F.abs(F.col("y") - F.col("y_pred")))).first()[0]
        assert own == pytest.approx(seen[-1], rel=1e-9)


def test_encoded_rows(spark, bundle, fitted):
    """Categories, then numbers, as the fitted tables of the split have them; unseen levels are zeros."""
    out = design.encoded(fitted, 2, bundle, CATS, NUMS, "e")
    levels = {(r.feature, r.level): r.slot for r in fitted.levels.where("split = 2").collect()}
    modes = encode.fitted_values(fitted.modes.where("split = 2"), "mode")
    got = {r.unique_key: r.features for r in out.collect()}
    assert len(got) == bundle.count()
    for r in bundle.collect():
        v = got[r.unique_key]
        assert isinstance(v, SparseVector) and v.size == len(levels) + len(NUMS)
        want = {levels[c, r[c] or modes[c]] for c in CATS if (c, r[c] or modes[c]) in levels}
        assert set(v.indices[: len(want)].tolist()) == want and list(v.indices) == sorted(v.indices)


def test_very_wide_vocabulary(spark):
    """200,000 levels: numbered in ranges, encoded sparsely, on both sides of the size check."""
    n = 200_000
    df = spark.range(n).select(F.col("id").cast("string").alias("unique_key"), (F.col("id") % 2).cast("int").alias("fold"), F.col("id").cast("double").alias("y"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("c"))
    levels = encode.fit_levels(df, ["c"], n_splits=None).persist()
    n_levels = levels.count()
    facts = levels.agg(F.min("slot"), F.max("slot"), F.count_distinct("slot")).first()
    assert n_levels == n - (n + 2) // 3 + 1 and tuple(facts) == (0, n_levels - 1, n_levels)
    ordered = [r.level for r in levels.orderBy("slot").limit(5).collect()]
    assert ordered == sorted(ordered) and ordered[0] == "hot"
    one = df.withColumn("fold", F.lit(0))
    sides = []
    for small in (True, False):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lookup, "fits_broadcast", lambda *_: small)
            sides.append(encode.one_hot(one, levels, ["c"]).agg(F.count("*"), F.sum("slot"), F.sum(F.xxhash64("unique_key", "slot") % 1000)).first())
    assert sides[0] == sides[1] and sides[0][0] == n
    rows = design.sparse_rows(encode.one_hot(one, levels, ["c"]).select("unique_key", "slot", F.lit(1.0).alias("value")), ["unique_key"])
    vectors = design.with_vectors(rows, n_levels, "wide")
    assert vectors.count() == n and vectors.first()["features"].size == n_levels


def test_ranges_hold_a_narrow_band(spark):
    """Values in a band are spread over as many ranges as asked for, none of which holds a multiple of its share."""
    df = spark.range(40_000).select((F.lit(40.5) + F.col("id") / 100_000).alias("v")).unionByName(spark.createDataFrame([(-1e9,), (1e12,)], "v double"))
    cells = [r["count"] for r in sampling.ranged(df, ["v"], 2000).groupBy("_part").count().collect()]
    assert len(cells) > 1500 and max(cells) < 40_000 / 2000 * 8
    assert quantiles.quantile_values(df, "v", [0.0, 0.5, 1.0]) == pytest.approx([-1e9, 40.7, 1e12], abs=1e-5)


def test_frequent_keys_are_not_shuffled(spark):
    """A third of the rows has one key: broadcast it, join the rest, repeat nothing."""
    big = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_011).alias("on")).persist()
    small = big.groupBy("on").agg(F.count("*").alias("n")).where("on % 7 <> 3").withColumn("v", F.col("on") * 2)
    got = lookup.attach_counted(big, small, ["on"], "n")
    want = big.join(small.drop("n"), "on", "left")
    assert got.count() == 30_000 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_target_means_by_one_join(spark, bundle):
    columns = CATS[1:4]
    means = encode.fit_target_means(bundle, columns, n_splits=3).persist()
    sides = []
    for small in (True, False):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lookup, "fits_broadcast", lambda *_: small)
            out = encode.target_encode(bundle, means, columns).select("unique_key", *(F.round(c, 9) for c in columns))
            sides.append(sorted(map(tuple, out.collect())))
            joins = [encode.target_encode(bundle, means, columns[:n])._jdf.queryExecution().optimizedPlan().numberedTreeString().count(" Join ") for n in (1, 3)]
            assert small or joins[0] == joins[1]
    assert sides[0] == sides[1]


def test_rows_of_few_levels_are_encoded_where_they_lie(spark):
    """encoding rows moved every entry with its whole row; the slots are the same either way."""
    from caseflow.operators import encode
    from pyspark.sql import functions as F

    rows = [("a", "x", 1), ("b", None, 2), ("c", "z", 1), (None, "y", 2), ("a", "x", 1)]
    df = spark.createDataFrame(rows, "unique_key string, kind string, size int").withColumn("fold", F.lit(0))
    levels = spark.createDataFrame(
        [("kind", "x", 0), ("kind", "y", 1), ("size", "1", 2), ("size", "2", 3)], "feature string, level string, slot int"
    )
    found = encode.with_slots(df, levels, ["kind", "size"])
    assert sorted((r["unique_key"] or "", r["slots"]) for r in found.collect()) == [
        ("", [1, 3]), ("a", [0, 2]), ("a", [0, 2]), ("b", [3]), ("c", [2])]
    assert "Exchange hashpartitioning" not in found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_boosting_leaves_no_running_table_behind(spark, monkeypatch):
    """the table of every tenth round stayed on disk."""
    import os

    from caseflow import session
    from caseflow.models import boosting
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    monkeypatch.setattr(boosting, "STORED_ROUNDS", 2, raising=False)
    monkeypatch.setattr(boosting, "SMALLEST_LEAF", 1)
    session.clear(spark)
    part = F.when(F.col("id") % 5 == 0, "validate").otherwise("train")
    table = spark.range(60).select(
        F.col("id").cast("double").alias("y"), part.alias("part"),
        array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 3).cast("double"))).alias("features"))
    booster = boosting.fit(table, rounds=5, patience=5)
    assert len(booster.trees) == 5
    folder = session.run_folder(spark).removeprefix("file:")
    assert [n for n in os.listdir(folder) if n.startswith("boost_state")] == []


def sparse_rows(spark, n=3000, seed=5):
    """A target of one category, one number and both together, in rows of few entries among 400 columns."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        c, x = rng.choice((rng.randint(0, 3), rng.randint(4, 389))), rng.uniform(-2, 2)
        y = 3.0 * (c == 1) + 2.0 * (x > 0.5) - 4.0 * (c == 2 and x < -1) + rng.gauss(0, 0.1)
        data.append((f"k{i}", y, sorted({c, 390 + i % 8}) + [399], [1.0, 1.0, x]))
    return spark.createDataFrame(data, "unique_key string, y double, indices array<int>, values array<double>").repartition(3).persist()


def test_forests_by_level_and_in_one_task_are_the_same(spark, monkeypatch):
    """Large nodes are split by level; a row is its entries, whatever the width."""
    from caseflow.models import forest

    rows, config = sparse_rows(spark), {"n_estimators": 3, "max_depth": 12, "min_samples_leaf": 5}
    parts, found = [(3, 12), (2, 12), (3, 2), (1, 0)], []
    for large in (65_536, 400, 40):
        monkeypatch.setattr(forest, "LARGE", large)
        model = forest.fit(rows, config)
        found.append({r.unique_key: list(r.y_preds) for r in model.score_parts(rows, parts).collect()})
        numbers = model.nodes.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("node").alias("m"), F.max("node").alias("last")).collect()
        assert len(numbers) == 3 and all(r.n == r.m == r.last + 1 for r in numbers)
    worst = max(abs(a - b) for k, v in found[0].items() for other in found[1:] for a, b in zip(v, other[k]))
    assert worst < 1e-9
    want = {r.unique_key: r.y for r in rows.collect()}
    error = sum(abs(found[0][k][0] - y) for k, y in want.items()) / len(want)
    assert error < 0.3 < sum(abs(found[0][k][3] - y) for k, y in want.items()) / len(want)


def test_parts_of_a_forest_score_as_the_plan_does(spark):
    from caseflow.models import forest

    rows = sparse_rows(spark, 800)
    model = forest.fit(rows, {"n_estimators": 4, "max_depth": 9, "min_samples_leaf": 1})
    parts = [(4, 9), (2, 9), (4, 3), (1, 0)]
    for most in (tree_table.MOST_NODES, 50):
        out = model.score_parts(rows, parts, most_nodes=most)
        for i, (n, depth) in enumerate(parts):
            one = model.first_trees(n).cut_at(depth).score(rows.select("unique_key", "indices", "values"), tree_table.sparse("indices", "values"))
            both = out.select("unique_key", F.get("y_preds", F.lit(i)).alias("p")).join(one, "unique_key")
            assert both.count() == 800 and both.agg(F.max(F.abs(F.col("p") - F.col("y_pred")))).first()[0] < 1e-12


def test_a_leaf_holds_the_least_drawn_rows(spark):
    """Every split is the best one: against trying all of them on the drawn rows of one tree."""
    from caseflow.models import forest

    rows = sparse_rows(spark, 300)
    model = forest.fit(rows, {"n_estimators": 1, "max_depth": 1, "min_samples_leaf": 20})
    got = rows.select(F.xxhash64(F.lit(forest.SEED), "unique_key", "y", "indices", "values").alias("h"), "y", "indices", "values").toPandas()
    w, (columns, numbers) = forest.draws(got.h.to_numpy(), 0), tree_table.padded(got.indices, got["values"])
    dense = np.zeros((len(got), 400))
    for r, c, v in zip(got.index, got.indices, got["values"]):
        dense[r, c] = v
    y, best = got.y.to_numpy(), []
    root = {r.node: r for r in model.nodes.collect()}[0]
    for c in range(400):
        for t in ([0.5] if c < 399 else forest.space_of(rows).places[0]):
            left = dense[:, c] <= t
            a, b = w[left].sum(), w[~left].sum()
            if min(a, b) >= 20:
                best.append(((w * y)[left].sum() ** 2 / a + (w * y)[~left].sum() ** 2 / b, c, float(t)))
    assert (root.feature, root.threshold) == max(best)[1:] and abs(root.value - (w * y).sum() / w.sum()) < 1e-9


def test_forests_of_one_split_read_rows_coded_once(spark, monkeypatch):
    """Rows become bins once, not at every level; entries are ordered by digits as by a stable sort."""
    from caseflow.models import forest

    keys = np.random.default_rng(1).integers(0, 1 << 34, 20_000)
    for some in (keys, keys % 70_000, keys % 5, keys[:0]):
        assert (forest.stable_order(some) == np.argsort(some, kind="stable")).all()
    monkeypatch.setattr(forest, "LARGE", 100)
    rows = sparse_rows(spark, 900)
    once = forest.coded(rows)
    for leaf in (1, 5):
        model = forest.fit(once, {"n_estimators": 2, "max_depth": 8, "min_samples_leaf": leaf})
        assert model.nodes.where("left >= 0").count() > 10
    assert once.rows.count() == 900 and dict(once.rows.dtypes)["bins"] == "binary"


def test_rows_end_where_a_walk_of_each_ends(monkeypatch):
    from caseflow.models import forest

    monkeypatch.setattr(forest, "SIDES_AT_ONCE", 64)
    space = forest.Space(6, 2, np.array([5]), [np.array([-1.0, 0.0, 2.0])], np.array([6]))
    assert space.kind is np.int16
    rng = np.random.default_rng(2)
    bins = np.column_stack([rng.integers(-1, 5, 300), rng.integers(6, 10, 300)]).astype(space.kind)
    one, stump = forest.Upper(), forest.Upper()
    _, b = one.grow(0, 5, 0.0, 7, [0.0, 0.0])
    c, _ = one.grow(b, 2, 0.5, 2, [0.0, 0.0])
    one.grow(c, 5, 2.0, 8, [0.0, 0.0])
    want = [1 if x <= 7 else 4 if k == 2 else 5 if x <= 8 else 6 for k, x in bins.tolist()]
    got, none = forest.end_nodes(bins, [one, stump], space)
    assert got.tolist() == want and not none.any()


def test_queries_run_the_whole_forest_grid(spark, monkeypatch):
    """The registered queries grow all trees of the grid, and its statement counts them."""
    from caseflow.plans import oracle, stages

    asked = []
    monkeypatch.setattr(stages.crossval, "forest_grid", lambda *a: asked.extend(a[4]))
    own = stages.Stages(spark, "none")
    for name in ("bundle", "fitted", "runs"):
        monkeypatch.setattr(own, name, lambda: None)
    monkeypatch.setattr(own, "columns", lambda: ([], []))
    own.forest_predictions()
    assert asked == evaluate.grid_configs(crossval.FOREST)
    assert {c["n_estimators"] for c in asked} == {200, 300} and len(asked) == 12
    assert "unnest([200, 300])" in oracle.ORACLE["cv_grid"]


def test_trees_by_tables_and_by_sorted_entries_are_the_same(monkeypatch):
    """The table of a large node's larger child is what its parent's has beside the smaller one's."""
    from caseflow.models import forest

    rng = np.random.default_rng(3)
    n, space = 4000, forest.Space(40, 4, np.array([39]), [np.array([-1.0, 0.0, 2.0])], np.array([40]))
    bins = np.column_stack([rng.integers(0, 4, n), 4 + rng.integers(-5, 35, n), np.full(n, -1), rng.integers(40, 44, n)])
    bins = np.where(bins < 4, np.where(bins < 0, -1, bins), bins).astype(space.kind)
    y = 3.0 * (bins[:, 0] == 1) + (bins[:, 3] > 41) * (bins[:, 1] == 7) + rng.normal(0, 0.2, n)
    w, found = rng.integers(1, 4, n).astype(float), []
    for table, alone in ((1e9, 10**9), (2, 10**9), (2, 100), (0, 1)):
        monkeypatch.setattr(forest, "TABLE", table)
        monkeypatch.setattr(forest, "ALONE", alone)
        found.append(forest.subtree(bins, y, w, 9, 3, space))
    assert len(found[0]["value"]) > 50
    for other in found[1:]:
        assert all((found[0][k] == other[k]).all() for k in ("feature", "threshold", "left", "right"))
        assert abs(found[0]["value"] - other["value"]).max() < 1e-12
    order = rng.permutation(n)
    other = forest.subtree(bins[order], y[order], w[order], 9, 3, space)
    assert (found[0]["feature"] == other["feature"]).all() and (found[0]["threshold"] == other["threshold"]).all()
