"""Encoded design tables of one split, from the fitted tables of ``operators.encode``.

An encoded row is sparse: the numbers of its columns and their values. While the levels of a split
fit a broadcast (see ``operators.lookup``), a row finds its own where it lies. A larger vocabulary is
joined to one long table of ones and numbers, which an aggregation on the key puts together again. Either
way the vocabulary stays a table: its size is the matrix's width, not a list on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators import encode, folds, lookup, sampling
from caseflow.schema import KEY, NUMERIC, SEED
from caseflow.session import materialise, new_path

SPARSE = 0  # how a stored vector says that it is sparse


@dataclass(frozen=True)
class Fitted:
    """The fitted tables of all splits (written tables with a ``split`` column)."""

    modes: DataFrame
    levels: DataFrame
    medians: DataFrame
    scaling: DataFrame


def with_vectors(
    df: DataFrame, size: int | Column, name: str, partition_by: Sequence[str] = (), vector: str = "features"
) -> DataFrame:
    """Write ``df``, with ``indices`` and ``values`` as a sparse vector beside them, and read it back.

    A vector is stored as a plain struct; written as one and read as the other, no row goes
    through Python.
    """
    width = F.lit(size) if isinstance(size, int) else size
    stored = F.struct(
        F.lit(SPARSE).cast("tinyint").alias("type"), width.cast("int").alias("size"),
        F.col("indices").cast("array<int>").alias("indices"), F.col("values").alias("values"),
    )
    made = df.withColumn(vector, F.when(F.lit(True), stored))
    path = new_path(df.sparkSession, name)
    made.write.partitionBy(*partition_by).parquet(path)
    kinds = [T.StructField(f.name, VectorUDT() if f.name == vector else f.dataType) for f in made.schema.fields]
    return df.sparkSession.read.schema(T.StructType(kinds)).parquet(path)


def _ones() -> Column:
    """A one for each slot of a row."""
    return F.transform("slots", lambda _: F.lit(1.0))


def sparse_rows(entries: DataFrame, ids: Sequence[str]) -> DataFrame:
    """``(ids..., indices, values)`` from rows ``(ids..., slot, value)``, at most one for each column."""
    ordered = F.array_sort(F.collect_list(F.struct("slot", "value")))
    return entries.groupBy(*ids).agg(ordered.alias("e")).select(
        *ids, F.col("e.slot").alias("indices"), F.col("e.value").alias("values")
    )


def encoded(
    fitted: Fitted,
    split: int,
    bundle: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    name: str,
) -> DataFrame:
    """``(key, fold, y, indices, values, features)`` of all rows, encoded as split ``split`` has it:
    categories, then numbers. An unseen category has no entry. Written once, partitioned by fold.
    """
    def of_split(stats: DataFrame) -> DataFrame:
        return stats.where(F.col("split") == split)

    modes = encode.fitted_values(of_split(fitted.modes), "mode")
    medians, means, scales = (
        encode.fitted_values(of_split(stats), value)
        for stats, value in ((fitted.medians, "median"), (fitted.scaling, "mean"), (fitted.scaling, "scale"))
    )
    levels = of_split(fitted.levels)
    n_levels = levels.count()
    numbers = {
        c: (F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) - means[c]) / scales[c] for c in numeric
    }
    ids = [KEY, "fold", "y"]
    filled = bundle.na.fill(modes, list(categorical)).withColumns(numbers)
    if lookup.fits_broadcast(levels):
        found = encode.with_slots(filled, levels, categorical)
        own = F.array(*[F.lit(n_levels + i) for i in range(len(numeric))])
        values = F.array(*[F.col(c).cast("double") for c in numeric])
        rows = found.select(
            *ids, F.concat("slots", own.cast("array<int>")).alias("indices"), F.concat(_ones(), values).alias("values")
        )
        return with_vectors(rows, n_levels + len(numeric), name, ["fold"])
    cats = filled.select(F.struct(*ids).alias("row"), F.lit(split).alias("fold"), *categorical)
    ones = encode.one_hot(cats, levels, categorical, key="row").select("row", "slot", F.lit(1.0).alias("value"))
    places = F.array(*[
        F.struct(F.lit(n_levels + i).alias("slot"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(numeric)
    ])
    rest = filled.select(F.struct(*ids).alias("row"), F.explode(places).alias("e")).select("row", "e.*")
    rows = sparse_rows(ones.unionByName(rest), ["row"]).select("row.*", "indices", "values")
    return with_vectors(rows, n_levels + len(numeric), name, ["fold"])


def boosting_table(bundle: DataFrame, split: int, holdout: float = 0.2) -> DataFrame:
    """``(key, fold, y, part, numbers, indices, values, features)`` for the boosted trees, written once.

    Part is ``train``, ``validate`` (a hold-out of the train folds) or ``test``. High-count
    categories are target-encoded and the rest become dummies, both fitted on ``train`` only;
    hour and weekday become cyclic. ``numbers`` are the columns before the dummies.
    """
    marked = sampling.mark_holdout(
        folds.train_rows(bundle, split), holdout, KEY, SEED, "validate"
    ).withColumn("part", F.when(F.col("validate"), "validate").otherwise("train"))
    test = folds.test_rows(bundle, split).withColumn("part", F.lit("test"))
    table = materialise(marked.drop("validate").unionByName(test), f"boost_parts_{split}")
    train = table.where(F.col("part") == "train")
    means = materialise(
        encode.fit_target_means(train, encode.TARGET_ENCODED, n_splits=None),
        f"boost_means_{split}",
    )
    levels = materialise(
        encode.fit_levels(train, encode.DUMMIES, n_splits=None), f"boost_levels_{split}"
    )
    inputs = [
        *encode.TARGET_ENCODED, *NUMERIC, "created_is_weekend", "hour_sin", "hour_cos", "day_sin", "day_cos",
    ]
    coded = encode.cyclic_encode(encode.target_encode(table, means, encode.TARGET_ENCODED, split=0))
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs])
    width = levels.count() + len(inputs)
    if lookup.fits_broadcast(levels):
        found = encode.with_slots(coded.withColumn("numbers", numbers), levels, encode.DUMMIES)
        own = F.array(*[F.lit(i) for i in range(len(inputs))])
        later = F.transform("slots", lambda slot: slot + len(inputs))
        rows = found.select(
            KEY, "fold", "y", "part", "numbers", F.concat(own, later).alias("indices"),
            F.concat("numbers", _ones()).alias("values"),
        )
        return with_vectors(rows, width, f"boost_{split}")
    ids = F.struct(KEY, "fold", "y", "part", numbers.alias("numbers"))
    dummies = coded.select(ids.alias("row"), F.lit(0).alias("fold"), *encode.DUMMIES)
    ones = encode.one_hot(dummies, levels, encode.DUMMIES, key="row").select(
        "row", (F.col("slot") + len(inputs)).alias("slot"), F.lit(1.0).alias("value")
    )
    own = coded.select(ids.alias("row")).select(
        "row", F.posexplode("row.numbers").alias("slot", "value")
    )
    rows = sparse_rows(ones.unionByName(own), ["row"]).select("row.*", "indices", "values")
    return with_vectors(rows, width, f"boost_{split}")
