"""Cleaning steps; each is a plain ``DataFrame -> DataFrame`` function for ``df.transform``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions import text, times
from caseflow.operators import quantiles
from caseflow.schema import CLOSED, CREATED, KEY, TARGET

OUTLIER_MODES = ("none", "percentile", "cap_hours")
DEFAULT_PERCENTILE = 0.999
DEFAULT_CAP_HOURS = 24.0 * 365.0


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Trim every text column; blank and ``nan`` become null. No shuffle.

    Two projections, so that each value is trimmed once although it is used twice.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    stripped = df.withColumns({c: text.strip(F.col(c)) for c in texts})
    return stripped.withColumns({c: text.blank_to_null(F.col(c)) for c in texts})


def parse_dates(
    df: DataFrame, columns: Sequence[str] = (CREATED, CLOSED), formats: Sequence[str] = ()
) -> DataFrame:
    found = {c: times.parse_utc(F.col(c), formats) for c in columns if c in df.columns}
    return df.withColumns(found) if found else df


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns missing from the snapshot: {', '.join(missing)}")
    return df


def has_both_dates() -> Column:
    return F.col(CREATED).isNotNull() & F.col(CLOSED).isNotNull()


def in_order() -> Column:
    return F.col(CLOSED) >= F.col(CREATED)


def keep_dated(df: DataFrame) -> DataFrame:
    return require_columns(df, [CREATED, CLOSED]).where(has_both_dates())


def keep_ordered(df: DataFrame) -> DataFrame:
    return df.where(in_order())


def arrival_columns(df: DataFrame) -> list[str]:
    """What deliveries are ordered by: close date, create date, the arrival mark if there is one,
    then all other columns by name, so that the order is total up to rows that are equal."""
    marks = [c for c in (CLOSED, CREATED, "arrival") if c in df.columns]
    return marks + sorted(c for c in df.columns if c not in marks)


def arrival_order(df: DataFrame) -> list[Column]:
    """Latest delivery first."""
    return [F.col(c).desc_nulls_last() for c in arrival_columns(df)]


def keep_last(
    df: DataFrame, key: str = KEY, order: Sequence[Column] | None = None, wanted: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the latest. A frame without the key column passes unchanged.

    With ``wanted``, only these columns of it and the key. The arrival order is then followed down to the
    last of them, and nothing behind it is moved: it only decides between rows that are equal so far.

    The arrival order is that of a struct of its columns, whose maximum is taken before the
    exchange as well as after it; rows are sorted by key only. In an order of the caller's,
    ``row_number() = 1`` is planned as a group limit on both sides. Either way a key that holds a
    third of all rows sends one row per map task, not all of them.
    """
    if key not in df.columns:
        return df
    shown = [c for c in df.columns if wanted is None or c == key or c in wanted]
    if not order:
        rest = [c for c in arrival_columns(df) if c != key]
        rest = rest[: max((i + 1 for i, c in enumerate(rest) if c in shown), default=0)]
        last = df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_last")) if rest else df.select(key).distinct()
        return last.select(*[F.col(c if c == key else f"_last.{c}") for c in shown])
    latest = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("_nth", F.row_number().over(latest))
    return ranked.where(F.col("_nth") == 1).select(*shown)


def with_hours(df: DataFrame) -> DataFrame:
    return df.withColumn(TARGET, times.hours_between(F.col(CREATED), F.col(CLOSED)))


def valid_hours() -> Column:
    hours = F.col(TARGET)
    return hours.isNotNull() & ~F.isnan(hours) & (hours >= 0)


def keep_valid_target(df: DataFrame) -> DataFrame:
    return df.where(valid_hours())


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Chosen columns that exist; key, dates and target are always kept. Empty keeps all."""
    names = [c.strip() for c in wanted if c.strip()]
    if not names:
        return df
    names += [c for c in (KEY, CREATED, CLOSED, TARGET) if c not in names]
    return df.select(*[c for c in names if c in df.columns])


def outlier_limit(df: DataFrame, mode: str, value: float | None = None) -> float | None:
    """The largest hours to keep; ``None`` when nothing is to be cut."""
    if mode not in OUTLIER_MODES:
        raise ValueError(f"unknown outlier mode: {mode!r} (use one of {OUTLIER_MODES})")
    if mode == "none":
        return None
    if mode == "cap_hours":
        return float(DEFAULT_CAP_HOURS if value is None else value)
    share = DEFAULT_PERCENTILE if value is None else value
    if not 0.0 < share < 1.0:
        raise ValueError("the outlier percentile must lie between 0 and 1")
    return quantiles.quantile_values(df, TARGET, [share])[0]


def cut_outliers(
    df: DataFrame, mode: str = "percentile", value: float | None = None
) -> DataFrame:
    """Drop hours above an exact quantile or above a fixed cap.

    ``percentile`` reads ``df`` twice (limit, then filter): pass a written stage table, where
    the limit is a literal that is pushed into the scan.
    """
    limit = outlier_limit(df, mode, value)
    return df if limit is None else df.where(F.col(TARGET) <= F.lit(limit))


def parsed(raw: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    require_columns(raw, [CREATED, CLOSED])
    return raw.transform(blanks_to_null).transform(parse_dates, (CREATED, CLOSED), formats)


def ordered(raw: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Parsed rows with both dates in order.

    A filter on cleaned columns goes below their cleaning and repeats it for each use. So rows are
    dropped by dates that are trimmed and parsed only, before anything else is cleaned; blanks are
    no dates, unless a format of the caller's reads them.
    """
    require_columns(raw, [CREATED, CLOSED])
    created, closed = (
        times.parse_utc(F.btrim(F.col(c).cast("string"), F.lit(text.WHITE_SPACE)), formats) for c in (CREATED, CLOSED)
    )
    kept = parsed(raw.where(closed >= created), formats)
    return kept.transform(keep_dated).transform(keep_ordered) if formats else kept


def last_ordered(raw: DataFrame, formats: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The latest row of each key among those with both dates in order, with hours; of its columns those to
    ``keep`` (see ``keep_columns``)."""
    wanted = [c.strip() for c in keep if c.strip()]
    last = keep_last(ordered(raw, formats), wanted=[*wanted, CREATED, CLOSED] if wanted else None)
    return keep_columns(with_hours(last), keep)


def dated_and_unique(raw: DataFrame, formats: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """All steps before the outlier cut. The date filters come before the dedup: an older
    valid delivery survives when a newer one is invalid."""
    return last_ordered(raw, formats, keep).transform(keep_valid_target)


FUNNEL_STAGES = [
    "raw", "empty_to_null", "datetime_parse", "required_dates", "time_sanity",
    "dedup_unique_key", "target_compute", "outlier_filter",
]


def funnel(
    raw: DataFrame,
    unique: DataFrame | None = None,
    mode: str = "percentile",
    value: float | None = None,
    formats: Sequence[str] = (),
) -> DataFrame:
    """Rows left after each stage, as ``(step, stage, n_rows)``.

    The stages before the dedup are conditional counts over one scan; the later ones count
    the deduplicated rows (``unique``, if already written by ``last_ordered``, saves deriving
    them again). ``formats`` are those the rows were cleaned with.
    """
    before = parsed(raw, formats).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(has_both_dates()).alias("required_dates"),
        F.count_if(has_both_dates() & in_order()).alias("time_sanity"),
    )
    deduped = unique if unique is not None else last_ordered(raw, formats)
    limit = outlier_limit(keep_valid_target(deduped), mode, value)
    kept = valid_hours() if limit is None else valid_hours() & (F.col(TARGET) <= F.lit(limit))
    after = deduped.agg(
        F.count(F.lit(1)).alias("dedup_unique_key"),
        F.count_if(valid_hours()).alias("target_compute"),
        F.count_if(kept).alias("outlier_filter"),
    )

    def long(counts: DataFrame, sources: dict[str, str]) -> DataFrame:
        rows = F.array(
            *[
                F.struct(
                    F.lit(FUNNEL_STAGES.index(stage)).alias("step"),
                    F.lit(stage).alias("stage"),
                    F.col(source).alias("n_rows"),
                )
                for stage, source in sources.items()
            ]
        )
        return counts.select(F.inline(rows))

    first = {s: "raw" for s in FUNNEL_STAGES[:3]} | {s: s for s in FUNNEL_STAGES[3:5]}
    return long(before, first).unionByName(long(after, {s: s for s in FUNNEL_STAGES[5:]}))


class LiveFunnel:
    """The funnel's counts, filled while the cleaned rows are written: no row is read a second time.

    The metrics run inside the writing jobs. A stage that the engine runs again after losing an
    executor may count its rows twice; ``funnel`` counts from the tables.
    """

    def __init__(self) -> None:
        self._raw, self._unique, self._kept = Observation(), Observation(), Observation()

    def unique(self, raw: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
        """As ``last_ordered``; to be written once."""
        seen = parsed(raw, formats).observe(
            self._raw,
            F.count(F.lit(1)).alias("raw"),
            F.count_if(has_both_dates()).alias("required_dates"),
            F.count_if(has_both_dates() & in_order()).alias("time_sanity"),
        )
        last = seen.transform(keep_dated).transform(keep_ordered).transform(keep_last)
        return with_hours(last).observe(
            self._unique,
            F.count(F.lit(1)).alias("dedup_unique_key"),
            F.count_if(valid_hours()).alias("target_compute"),
        )

    def kept(self, df: DataFrame) -> DataFrame:
        """The rows that are left; to be written once."""
        return df.observe(self._kept, F.count(F.lit(1)).alias("outlier_filter"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """``(step, stage, n_rows)`` once both tables are written; waits for them."""
        seen = self._raw.get | self._unique.get | self._kept.get
        seen |= {s: seen["raw"] for s in FUNNEL_STAGES[1:3]}
        rows = [(i, s, seen[s]) for i, s in enumerate(FUNNEL_STAGES)]
        return spark.createDataFrame(rows, "step int, stage string, n_rows long")


def cleaning_report(
    counts: DataFrame,
    columns: Sequence[str],
    mode: str,
    value: float | None = None,
    source: str = "",
    target: str = "",
) -> DataFrame:
    """One row that records a cleaning run: names, outlier rule, kept columns, and the rows left
    after each stage of ``counts`` (see ``funnel``). It is written as JSON beside the table."""
    if mode not in OUTLIER_MODES:
        raise ValueError(f"unknown outlier mode: {mode!r} (use one of {OUTLIER_MODES})")
    default = {"percentile": DEFAULT_PERCENTILE, "cap_hours": DEFAULT_CAP_HOURS}.get(mode)
    stages = [
        F.max(F.when(F.col("stage") == s, F.col("n_rows"))).alias(f"rows_{s}") for s in FUNNEL_STAGES
    ]
    return counts.agg(*stages).select(
        F.lit(source).alias("source"), F.lit(target).alias("target"),
        F.lit(mode).alias("outlier_mode"),
        F.lit(default if value is None else value).cast("double").alias("outlier_value"),
        F.lit(",".join(columns)).alias("kept_columns"), *[f"rows_{s}" for s in FUNNEL_STAGES],
    )
