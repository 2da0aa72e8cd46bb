"""Joining a large table to a table of fitted values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
HOT_KEYS = 10_000  # a key with at least one in so many rows is hot: there are no more of them


def _size_in_bytes(small: DataFrame) -> int:
    width = F.lit(0)
    for field in small.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        else:
            width = width + 16
    return small.agg(F.sum(width.cast("long"))).first()[0] or 0


def fits_broadcast(small: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a (written) table of fitted values before deciding how to join it."""
    return _size_in_bytes(small) <= limit


def attach(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread: str, broadcast: bool
) -> DataFrame:
    """Left join of ``big`` to ``small``, which has one row per ``on``.

    With ``broadcast`` (see ``fits_broadcast``) ``big`` does not move. Without it the join is
    salted: every ``small`` row is repeated per salt and ``big`` rows take a salt from the
    hash of the ``spread`` column, so a key that holds a third of the rows is spread over
    ``SALTS`` tasks.
    """
    on = list(on)
    if broadcast:
        return big.join(F.broadcast(small), on, "left")
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    salted = small.withColumn("_salt", F.explode(salts))
    spread_out = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return spread_out.join(salted.hint("merge"), [*on, "_salt"], "left").drop("_salt")


def attach_counted(big: DataFrame, small: DataFrame, on: Sequence[str], count: str) -> DataFrame:
    """Left join of ``big`` to ``small``, which has one row per ``on`` and tells how often it occurs.

    The few frequent keys (at most ``HOT_KEYS``) are broadcast; only rows with other keys are
    shuffled, so no task gets the rows of a frequent key and nothing is repeated. ``big`` is
    read twice: pass a written table.
    """
    on = list(on)
    least = (small.agg(F.sum(count)).first()[0] or 0) / HOT_KEYS
    hot = small.where(F.col(count) >= least).drop(count)
    rest = small.where(F.col(count) < least).drop(count)
    met = big.join(F.broadcast(hot), on)
    left = big.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return met.unionByName(left.join(rest.hint("merge"), on, "left"))
