"""Every registered query of the core library against its DuckDB statement, on the small tables."""

import pytest
from caseflow.plans import oracle
from caseflow.plans import queries as registry
from oracle_check import SMALL, compare, duck

#: Results of models, which no statement can compute; what they must hold is in the queries beside them.
NO_STATEMENT = {"snapshot_digest", "boost_results", "forest_results", "model_ranking"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.fixture(scope="module")
def stages(spark):
    """One set of stage tables for all queries here; each query on its own derives them anew."""
    return registry.Stages(spark, SMALL)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_statement(spark, con, stages, monkeypatch, name):
    monkeypatch.setattr(registry, "Stages", lambda *_: stages)
    got = registry.QUERIES[name](spark, SMALL).toPandas()
    assert compare(got, con.execute(oracle.ORACLE[name]).df()) == ""


def test_a_query_alone_gives_the_same(spark, con):
    got = registry.QUERIES["fold_slice"](spark, SMALL).toPandas()
    assert compare(got, con.execute(oracle.ORACLE["fold_slice"]).df()) == ""


def test_every_query_has_a_statement():
    assert set(registry.QUERIES) - set(oracle.ORACLE) == NO_STATEMENT


def test_text_operators_are_optional(tmp_path):
    """Without their folder the entry module still imports and offers the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(top, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(registry.QUERIES)), str(len(oracle.ORACLE))]


@pytest.fixture(scope="module")
def narrow(spark):
    """Stage tables as a query on its own has them: one set for each choice of columns."""
    real, made = registry.Stages, {}
    return lambda _, __, reads=None: made.setdefault(reads, real(spark, SMALL, reads))


NARROW = (
    "fold_slice fold_train_test fold_sizes stratified_folds param_grid holdout_split dataset_summary quantile_bins seeded_sample "
    "time_features target_log1p target_profile target_hist hours_hist_clipped fold_metrics best_config best_from_results top_configs "
    "residual_hist pred_vs_true_grid predictions_bucketed head_export abs_error_by_target best_fold_series config_ranking config_summary "
    "mark_best results_union impute_mode onehot_long impute_median standardize numeric_fill_zero target_encode cyclic_encode dummies_long "
    "feature_names fold_widths top_types borough_counts borough_mean_target"
).split()


@pytest.mark.parametrize("name", NARROW)
def test_a_query_is_right_from_only_what_it_reads(spark, con, narrow, monkeypatch, name):
    """A query's stage tables hold the features that it reads and no others."""
    seen = []
    monkeypatch.setattr(registry, "Stages", lambda *a: seen.append((a[2], narrow(*a))) or seen[0][1])
    got = registry.QUERIES[name](spark, SMALL).toPandas()
    assert compare(got, con.execute(oracle.ORACLE[name]).df()) == ""
    reads, stages = seen[0]
    assert reads is not None and set(stages.unique().columns) - set(reads) <= {"unique_key", "created_date", "closed_date", "resolution_time_hours"}
    if "bundle" in stages._made:
        assert set(stages.bundle().columns) - set(reads) == {"unique_key", "y", "y_bin", "fold"}
