"""Where a boosted tree may split: at most twenty places for each number, and rows coded by them.

A column of few distinct values can be split at each of them; any other one at twenty percentiles of
its train values, from the lowest to the highest. Percentiles come from a mergeable sketch of each
column, built in one pass by partial aggregation. Rows are coded once, as how many places lie below
their value; every round then reads codes, and a split between codes is a place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: places for a column of more distinct values.
SPLIT_CANDIDATES = 20
#: Values a sketch keeps at a level: ranks are right up to that many, and within 0.1 percent beyond.
SKETCH_VALUES = 4096


def split_candidates(
    train: DataFrame, numbers: str, most: int = SPLIT_CANDIDATES, keep: int = SKETCH_VALUES
) -> list[list[float]]:
    """Places of each position of the array column ``numbers``, rising and without repeats.

    Missing values are not looked at. A percentile is the least value that at least so many of the
    rows do not exceed.
    """
    long = train.select(F.posexplode(numbers).alias("feature", "value")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    distinct = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    few = (
        distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values")).where(F.col("n_values") <= most)
    )
    listed = distinct.join(F.broadcast(few.select("feature")), "feature")  # one row per column
    whole = listed.groupBy("feature").agg(F.sort_array(F.collect_list("value")).alias("places"))
    rest = long.join(F.broadcast(few.select("feature")), "feature", "left_anti")
    sketches = rest.groupBy("feature").agg(
        F.kll_sketch_agg_double("value", F.lit(keep)).alias("sketch")
    )
    ranks = F.array(*[F.lit(i / (most - 1)) for i in range(most)])
    places = F.kll_sketch_get_quantile_double("sketch", ranks)
    many = sketches.select("feature", F.array_sort(F.array_distinct(places)).alias("places"))
    found = {r["feature"]: list(r["places"]) for r in whole.unionByName(many).collect()}
    return [found.get(i, []) for i in range(max(found, default=-1) + 1)]  # at most 20 each


def codes(numbers: Column, places: Sequence[Sequence[float]]) -> Column:
    """For each position of an array: how many of its places lie below the value.

    ``value <= places[i]`` exactly if ``code <= i``. A missing value is coded as the lowest.
    """
    known = F.array(*[
        F.array(*[F.lit(float(p)) for p in own]).cast("array<double>") for own in places
    ]).cast("array<array<double>>")
    return F.zip_with(
        numbers, known, lambda x, own: F.size(F.filter(own, lambda p: p < x)).cast("double")
    )
