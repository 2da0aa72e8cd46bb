"""Interim and processed tables, feature specification, results and predictions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators.features import guard_leakage
from caseflow.schema import KEY, N_SPLITS, SEED, STRAT_BINS, TARGET
from caseflow.session import new_path
from caseflow.sources import snapshots

HEAD_ROWS = 50
BUCKETS = 64


def read_interim(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Parquet or CSV, by extension; CSV needs its column list."""
    lowered = path.rstrip("/").lower()
    if lowered.endswith(".parquet"):
        return spark.read.parquet(path)
    if lowered.endswith(".csv"):
        if not columns:
            raise ValueError("a CSV table needs its column list")
        return snapshots.read_csv(spark, path, columns)
    raise ValueError(f"unsupported table type: {path}")


def latest_interim(names: Sequence[str]) -> str:
    """The newest interim table by name; parquet is preferred over CSV."""
    for ending in (".parquet", ".csv"):
        found = sorted(n for n in names if n.rstrip("/").endswith(ending))
        if found:
            return found[-1]
    raise FileNotFoundError("no interim table found: run the cleaning step first")


def stored_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables in a folder of any storage that Spark can list."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def find_interim(spark: SparkSession, folder: str) -> str:
    """Path of the newest interim table in a folder."""
    return f"{folder.rstrip('/')}/{latest_interim(stored_names(spark, folder))}"


def find_tag(spark: SparkSession, folder: str, prefix: str = "feature_spec_") -> str:
    """The newest tag for which the folder holds a feature specification."""
    tags = sorted(n[len(prefix):].removesuffix(".json") for n in stored_names(spark, folder) if n.startswith(prefix))
    if not tags:
        raise FileNotFoundError("no processed table found: run the feature step first")
    return tags[-1]


def write_interim(df: DataFrame, path: str) -> None:
    lowered = path.rstrip("/").lower()
    if lowered.endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    elif lowered.endswith(".csv"):
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"unsupported table type: {path}")


def write_bundle(df: DataFrame, path: str) -> None:
    """Features, target and fold on the same row, one folder per fold.

    Every task writes its own file per fold.
    """
    guard_leakage(df.columns)
    df.write.mode("overwrite").partitionBy("fold").parquet(path)


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Filters on ``fold`` prune the scan to whole folders."""
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, buckets: int = BUCKETS, key: str = KEY) -> DataFrame:
    """Write a table bucketed and sorted by its key below the shared folder, and read it back.

    Tables with the same number of buckets are joined on the key, or aligned to each other, where
    they lie: neither side is shuffled. Rows are dealt by key first, so a bucket is one file.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


@dataclass(frozen=True)
class FeatureSpec:
    """What a processed bundle contains and how it is meant to be encoded."""

    tag: str
    source_interim: str
    created_at_utc: str
    target_col: str = TARGET
    target_transform: str = "log1p"
    categorical_cols: list[str] = field(default_factory=list)
    numeric_cols: list[str] = field(default_factory=list)
    time_feature_cols: list[str] = field(default_factory=list)
    n_splits: int = N_SPLITS
    strat_bins: int = STRAT_BINS
    random_seed: int = SEED
    categorical_imputer: str = "most_frequent"
    categorical_encoder: str = "one_hot(unseen=zeros)"
    numeric_imputer: str = "median"
    numeric_scaler: str = "standard(population)"


SPEC_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "tag", "source_interim", "created_at_utc", "target_col", "target_transform")]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in (
        "categorical_cols", "numeric_cols", "time_feature_cols")]
    + [T.StructField(c, T.IntegerType()) for c in ("n_splits", "strat_bins", "random_seed")]
    + [T.StructField(c, T.StringType()) for c in (
        "categorical_imputer", "categorical_encoder", "numeric_imputer", "numeric_scaler")]
)


def spec_frame(spark: SparkSession, spec: FeatureSpec) -> DataFrame:
    return spark.createDataFrame([asdict(spec)], SPEC_SCHEMA)


def write_spec(spark: SparkSession, spec: FeatureSpec, path: str) -> None:
    spec_frame(spark, spec).coalesce(1).write.mode("overwrite").json(path)


def read_spec(spark: SparkSession, path: str) -> FeatureSpec:
    return FeatureSpec(**spark.read.schema(SPEC_SCHEMA).json(path).first().asDict())


def feature_report(spec: FeatureSpec, sizes: DataFrame) -> DataFrame:
    """Report of a feature build as ``(position, section, item, value)``.

    ``sizes`` are the fold sizes ``(fold, n_train, n_test)``.
    """
    def columns(names: list[str]) -> str:
        return f"{len(names)}: {', '.join(names) if names else '(none)'}"

    facts = [
        ("target", "column", spec.target_col),
        ("target", "transform", spec.target_transform),
        ("features", "categorical", columns(spec.categorical_cols)),
        ("features", "numeric", columns(spec.numeric_cols)),
        ("features", "time", columns(spec.time_feature_cols)),
        ("encoding", "categorical", f"{spec.categorical_imputer} + {spec.categorical_encoder}"),
        ("encoding", "numeric", f"{spec.numeric_imputer} + {spec.numeric_scaler}"),
        ("folds", "splits", str(spec.n_splits)),
        ("folds", "seed", str(spec.random_seed)),
        ("folds", "requested bins", str(spec.strat_bins)),
    ]
    fixed = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(s).alias("section"), F.lit(k).alias("item"),
                F.lit(v).alias("value"),
            )
            for i, (s, k, v) in enumerate(facts)
        ]
    )
    per_fold = sizes.select(
        (F.col("fold") + len(facts)).alias("position"),
        F.lit("fold sizes").alias("section"),
        F.format_string("fold %d", "fold").alias("item"),
        F.format_string("train %d, test %d", "n_train", "n_test").alias("value"),
    )
    rows = sizes.agg(F.sum("n_test").alias("n")).select(
        F.lit(len(facts) + spec.n_splits).alias("position"), F.lit("table").alias("section"),
        F.lit("rows").alias("item"), F.col("n").cast("string").alias("value"),
    )
    facts_frame = sizes.sparkSession.range(1).select(F.inline(fixed))
    return facts_frame.unionByName(per_fold).unionByName(rows)


def write_report(report: DataFrame, path: str) -> None:
    """The report as text lines, in order."""
    lines = report.select(
        "position", F.concat_ws(" | ", "section", "item", "value").alias("value")
    )
    lines.coalesce(1).sortWithinPartitions("position").select("value").write.mode(
        "overwrite"
    ).text(path)


def write_results(results: DataFrame, path: str) -> None:
    results.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_predictions(preds: DataFrame, path: str) -> None:
    preds.write.mode("overwrite").parquet(path)


def head_export(preds: DataFrame, n: int = HEAD_ROWS) -> DataFrame:
    """First prediction rows by fold and key, for a quick look."""
    return preds.orderBy("fold", KEY).limit(n)
