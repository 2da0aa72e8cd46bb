"""Reference statements for DuckDB, one per query that SQL can express.

``CHAIN`` holds the stage tables as common table expressions in build order; a statement
gets the chain up to the stages it reads. All of them compute directly from the test tables.
"""

from __future__ import annotations

# Fixed values, written out here so that the statements do not depend on the code they check.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
RAW_COLUMNS = [
    "unique_key", "created_date", "closed_date", "agency", "complaint_type", "descriptor",
    "borough", "location_type", "incident_zip", "latitude", "longitude", "community_board",
    "council_district", "police_precinct",
]
CATS = [
    "agency", "complaint_type", "descriptor", "borough", "location_type", "incident_zip",
    "community_board", "council_district", "police_precinct",
]
NUMERIC = ["latitude", "longitude"]
TIME_FEATURES = ["created_hour", "created_dayofweek", "created_month", "created_is_weekend"]
TARGET_ENCODED = [
    "complaint_type", "descriptor", "location_type", "community_board", "police_precinct",
    "incident_zip", "council_district",
]
DUMMIES = ["agency", "borough", "created_month"]
SMOOTHINGS = [1, 5, 15, 50, 150, 500]
N_SPLITS, SMOOTHING, BINS, TOP_TYPES, HEAD_NAMES = 5, 15.0, 60, 12, 40
SAMPLE_ROWS, SOURCE_ROWS = 500, 1000
TAG, BASELINE_COLUMN = "processed_cv5", "complaint_type"
NUMS = NUMERIC + TIME_FEATURES
TEXT = [*RAW_COLUMNS, "arrival"]


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g')"


def _show(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S') AS {ts}"


def _trim(c: str) -> str:
    t = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    return f"CASE WHEN {t} NOT IN ('', 'nan') THEN {t} END"


def _each(columns: list[str], form: str) -> str:
    return ", ".join(form.format(c=c) for c in columns)


def _stack(columns: list[str], source: str, ids: str, cast: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{c}' AS feature, {i} AS pos, CAST({c} AS {cast}) AS value FROM {source}"
        for i, c in enumerate(columns)
    )


SPLITS = f"(SELECT unnest(range({N_SPLITS}))::INT AS split)"

CHAIN = {
    "raw": f"""
SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS unique_key,
  CASE WHEN l_suppkey % 29 = 0 THEN 'not a date'
       ELSE {_iso("o_orderdate + to_hours((l_partkey % 24)::INT)")} END AS created_date,
  CASE WHEN l_partkey % 23 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN ''
       ELSE {_iso("l_shipdate + to_hours((l_suppkey % 24)::INT)")} END AS closed_date,
  CASE WHEN l_suppkey % 17 = 0 THEN '   ' WHEN l_suppkey % 19 = 0 THEN ' nan '
       ELSE ' ' || c_mktsegment || ' ' END AS agency,
  p_type AS complaint_type, p_brand AS descriptor,
  CASE WHEN l_linenumber <> 7 THEN r_name END AS borough, o_orderpriority AS location_type,
  CAST(n_nationkey AS VARCHAR) AS incident_zip, l_returnflag || l_linestatus AS community_board,
  CAST(l_suppkey AS VARCHAR) AS council_district, CAST(p_size AS VARCHAR) AS police_precinct,
  CASE WHEN l_partkey % 13 = 0 THEN 'x' ELSE CAST(c_acctbal AS VARCHAR) END AS latitude,
  CAST(s_acctbal AS VARCHAR) AS longitude,
  lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '|' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0')
    || '|' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS arrival
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "trimmed": f"SELECT {', '.join(f'{_trim(c)} AS {c}' for c in TEXT)} FROM raw",
    "typed": """
SELECT * REPLACE (try_cast(created_date AS TIMESTAMP) AS created_date,
                  try_cast(closed_date AS TIMESTAMP) AS closed_date) FROM trimmed""",
    "dated": "SELECT * FROM typed WHERE created_date IS NOT NULL AND closed_date IS NOT NULL",
    "ordered": """
SELECT *, (epoch_us(closed_date) - epoch_us(created_date)) / 3.6e9::DOUBLE
  AS resolution_time_hours
FROM dated WHERE closed_date >= created_date""",
    "uniq": """
SELECT * FROM ordered QUALIFY row_number() OVER (PARTITION BY unique_key
  ORDER BY closed_date DESC, created_date DESC, arrival DESC) = 1""",
    "interim": """
SELECT * FROM uniq WHERE resolution_time_hours <=
  (SELECT quantile_cont(resolution_time_hours, 0.999) FROM uniq)""",
    "featured": f"""
SELECT unique_key, {_each(CATS, "{c}")},
  {_each(NUMERIC, "CASE WHEN NOT isnan(try_cast({c} AS DOUBLE)) THEN try_cast({c} AS DOUBLE) END AS {c}")},
  hour(created_date)::INT AS created_hour, (isodow(created_date) - 1)::INT AS created_dayofweek,
  month(created_date)::INT AS created_month,
  (isodow(created_date) >= 6)::INT AS created_is_weekend,
  ln(1 + greatest(resolution_time_hours, 0.0)) AS y
FROM interim""",
    "edges": """
SELECT list_transform(quantile_cont(round(y, 9),
  [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), lambda e: round(e, 9)) AS e
FROM featured""",
    "inner_edges": """
SELECT list_filter(list_distinct(e), lambda v: v > list_min(e) AND v < list_max(e)) AS e
FROM edges""",
    "binned": """
SELECT f.*, len(list_filter(i.e, lambda v: v < round(f.y, 9)))::INT AS y_bin
FROM featured f, inner_edges i""",
    "bundle": f"""
SELECT * EXCLUDE (place), ((place - 1) % {N_SPLITS})::INT AS fold FROM (
  SELECT *, row_number() OVER (ORDER BY y_bin, md5('42:' || unique_key), unique_key) AS place
  FROM binned)""",
    "cat_long": _stack(CATS, "bundle", "unique_key, fold", "VARCHAR"),
    "num_long": _stack(NUMS, "bundle", "unique_key, fold", "DOUBLE"),
    "modes": f"""
SELECT split, feature, value AS mode FROM (
  SELECT split, feature, value, count(*) AS n FROM cat_long JOIN {SPLITS} ON fold <> split
  WHERE value IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY split, feature ORDER BY n DESC, value) = 1""",
    "cat_filled": """
SELECT c.unique_key, c.fold, c.feature, c.pos, coalesce(c.value, m.mode) AS value
FROM cat_long c JOIN modes m ON c.fold = m.split AND c.feature = m.feature""",
    "levels": f"""
SELECT split, feature, value,
  (row_number() OVER (PARTITION BY split ORDER BY pos, value) - 1)::INT AS slot
FROM (SELECT DISTINCT split, feature, pos, value FROM cat_long JOIN {SPLITS} ON fold <> split
      WHERE value IS NOT NULL)""",
    "medians": f"""
SELECT split, feature, quantile_cont(value, 0.5) AS median
FROM num_long JOIN {SPLITS} ON fold <> split WHERE value IS NOT NULL GROUP BY ALL""",
    "num_filled": """
SELECT n.unique_key, n.fold, n.feature, coalesce(n.value, m.median) AS value
FROM num_long n JOIN medians m ON n.fold = m.split AND n.feature = m.feature""",
    "scaling": f"""
SELECT n.split, n.feature, avg(coalesce(value, median)) AS mean,
  CASE WHEN stddev_pop(coalesce(value, median)) > 0 THEN stddev_pop(coalesce(value, median))
       ELSE 1.0 END AS scale
FROM (SELECT * FROM num_long JOIN {SPLITS} ON fold <> split) n
JOIN medians m ON n.split = m.split AND n.feature = m.feature GROUP BY ALL""",
    "overall": f"""
SELECT split, avg(y) AS overall FROM bundle JOIN {SPLITS} ON fold <> split GROUP BY ALL""",
    "preds": f"""
SELECT 'category_mean' AS model, '{TAG}' AS tag,
  'mean_{BASELINE_COLUMN}_m' || CAST(m AS VARCHAR) AS config_id, m::DOUBLE AS smoothing,
  unique_key, fold, y AS y_true,
  (coalesce(t.total, 0) + o.overall * m) / (coalesce(t.n, 0) + m) AS y_pred
FROM (SELECT unique_key, fold, y, coalesce({BASELINE_COLUMN}, 'nan') AS level FROM bundle) b
JOIN overall o ON o.split = b.fold
LEFT JOIN (SELECT split, coalesce({BASELINE_COLUMN}, 'nan') AS level, count(*) AS n,
             sum(y) AS total FROM bundle JOIN {SPLITS} ON fold <> split GROUP BY ALL) t
  ON t.split = b.fold AND t.level = b.level
CROSS JOIN (SELECT unnest({SMOOTHINGS}) AS m)""",
    "fold_rows": """
SELECT model, tag, config_id, fold,
  (sum(count(*)) OVER (PARTITION BY config_id) - count(*))::BIGINT AS n_train,
  count(*) AS n_test, smoothing, avg(abs(y_true - y_pred)) AS mae,
  sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse
FROM preds GROUP BY model, tag, config_id, smoothing, fold""",
    "summary": """
SELECT model, tag, config_id, smoothing, avg(mae) AS mae_mean, stddev_samp(mae) AS mae_std,
  avg(rmse) AS rmse_mean, stddev_samp(rmse) AS rmse_std
FROM fold_rows GROUP BY ALL""",
    "best": "SELECT * FROM summary ORDER BY rmse_mean, mae_mean, config_id LIMIT 1",
    "best_preds": "SELECT p.* FROM preds p SEMI JOIN best b ON p.config_id = b.config_id",
}


def _with(stage: str, select: str) -> str:
    names = list(CHAIN)
    used = names[: names.index(stage) + 1]
    steps = ",\n".join(f"{n} AS MATERIALIZED ({CHAIN[n].strip()})" for n in used)
    return f"WITH {steps}\n{select.strip()}"


def _rounded(columns: list[str]) -> str:
    return _each(columns, "round({c}, 6) AS {c}")


def _wide(columns: list[str], source: str) -> str:
    picks = ", ".join(f"max(value) FILTER (WHERE feature = '{c}') AS {c}" for c in columns)
    return f"SELECT unique_key, fold, {picks} FROM {source} GROUP BY unique_key, fold"


def _histogram(values: str, bins: int = BINS) -> str:
    """60 bins over [min, max] of ``SELECT v``; all bins are listed."""
    return f"""
, vals AS (SELECT v FROM ({values}) WHERE v IS NOT NULL),
span AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
           CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM vals),
counts AS (SELECT least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})::INT AS bin,
             count(*) AS n FROM vals, span GROUP BY ALL)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS lower,
  round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) AS upper, coalesce(n, 0)::BIGINT AS n
FROM (SELECT unnest(range({bins}))::INT AS bin) b CROSS JOIN span LEFT JOIN counts USING (bin)"""


def _with_more(stage: str, rest: str) -> str:
    """As ``_with`` for a continuation that starts with further expressions."""
    return _with(stage, "").rstrip() + rest


CONFIGS = [
    ("random_forest_regressor", f"rf_n{n}_d{d}_leaf{leaf}")
    for n in (200, 300) for d in (20, 30) for leaf in (1, 5, 10)
] + [
    ("mlp_regressor", f"mlp_h{h}_lr{lr}_do0.2") for h in (128, 256) for lr in ("1e-03", "3e-04")
] + [
    ("resnet_regressor", f"resnet_h256_b{b}_lr{lr}_do{do}")
    for b in (2, 4) for lr in ("1e-03", "3e-04") for do in ("0.1", "0.3")
]


def _grid_rows() -> str:
    return ", ".join(f"('{model}', '{config}')" for model, config in CONFIGS)


def _facts(models: list[str], within: str = "") -> str:
    """What a prediction table must hold by fold, and the errors of the train mean over its rows."""
    return f"""
SELECT m AS model, fold, count(*) AS n, count(DISTINCT unique_key) AS n_keys,
  count(*) - count(y) AS n_missing, {within}
  round(avg(abs(y - overall)), 6) AS base_mae, round(sqrt(avg((y - overall) * (y - overall))), 6) AS base_rmse
FROM bundle JOIN overall o ON o.split = fold CROSS JOIN (SELECT unnest({models}) AS m) GROUP BY ALL"""


def _na(c: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)
    return f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END AS {c}"


def _canonical() -> str:
    tokens = ", ".join(f"'{t}'" for t in NA_TOKENS)
    shown = (f"CASE WHEN {c} NOT IN ({tokens}) THEN '=' || {c} ELSE '' END" for c in TEXT)
    return " || '|' || ".join(shown)


def _report() -> str:
    def listed(columns: list[str]) -> str:
        return f"{len(columns)}: {', '.join(columns)}"

    facts = [
        ("target", "column", "resolution_time_hours"), ("target", "transform", "log1p"),
        ("features", "categorical", listed(CATS)), ("features", "numeric", listed(NUMERIC)),
        ("features", "time", listed(TIME_FEATURES)),
        ("encoding", "categorical", "most_frequent + one_hot(unseen=zeros)"),
        ("encoding", "numeric", "median + standard(population)"),
        ("folds", "splits", str(N_SPLITS)), ("folds", "seed", "42"),
        ("folds", "requested bins", "10"),
    ]
    values = ", ".join(f"({i}, '{s}', '{k}', '{v}')" for i, (s, k, v) in enumerate(facts))
    n = len(facts)
    return f"""
SELECT * FROM (VALUES {values}) t(position, section, item, value)
UNION ALL SELECT fold + {n}, 'fold sizes', 'fold ' || fold, 'train '
  || (sum(count(*)) OVER () - count(*))::BIGINT || ', test ' || count(*) FROM bundle GROUP BY fold
UNION ALL SELECT {n + N_SPLITS}, 'table', 'rows', count(*)::VARCHAR FROM bundle"""


HOURS = "resolution_time_hours"
RESULT_SUMMARY = ["mae_mean", "mae_std", "rmse_mean", "rmse_std"]
SUMMARY_SHOWN = f"model, tag, config_id, smoothing, {_rounded(RESULT_SUMMARY)}"
FOLDS_SHOWN = "model, tag, config_id, fold, n_train, n_test, smoothing, " + _rounded(
    ["mae", "rmse"]
)
STACKED = f"""
SELECT {FOLDS_SHOWN}, config_id = (SELECT config_id FROM best) AS is_best, 'fold' AS row_type
FROM fold_rows UNION ALL BY NAME
SELECT {SUMMARY_SHOWN}, config_id = (SELECT config_id FROM best) AS is_best,
  'summary' AS row_type FROM summary"""


def _holdout(share: str) -> str:
    return (
        f"row_number() OVER (PARTITION BY split ORDER BY md5('holdout:42:' || unique_key)) <= "
        f"ceil({share} * count(*) OVER (PARTITION BY split))"
    )


def _target_encoded() -> str:
    joins, picks = [], []
    for i, c in enumerate(TARGET_ENCODED):
        m = SMOOTHING
        joins.append(
            f"LEFT JOIN (SELECT split, coalesce({c}, 'nan') AS level, "
            f"count(*) AS n, avg(y) AS mean FROM bundle JOIN {SPLITS} ON fold <> split "
            f"GROUP BY ALL) t{i} ON t{i}.split = b.fold AND t{i}.level = coalesce(b.{c}, 'nan')"
        )
        picks.append(
            f"round(coalesce((t{i}.mean * t{i}.n + o.overall * {m}) / (t{i}.n + {m}), "
            f"o.overall), 6) AS {c}"
        )
    return (
        f"SELECT b.unique_key, b.fold, {', '.join(picks)} FROM bundle b "
        f"JOIN overall o ON o.split = b.fold {' '.join(joins)}"
    )


def _dummy_stack() -> str:
    return " UNION ALL ".join(
        f"SELECT unique_key, fold, '{c}' AS feature, {i} AS pos, CAST({c} AS VARCHAR) AS value, "
        + (f"{c}::DOUBLE" if c == "created_month" else "NULL::DOUBLE")
        + " AS num FROM bundle"
        for i, c in enumerate(DUMMIES)
    )


ORACLE: dict[str, str] = {
    # sources
    "scan_pages": _with("raw", f"SELECT {', '.join(_na(c) for c in TEXT)} FROM raw"),
    "source_select": _with("raw", f"SELECT {', '.join(RAW_COLUMNS)} FROM raw"),
    "source_where": _with("raw", """
SELECT * FROM raw WHERE created_date >= '2000-01-01T00:00:00.000' AND borough = 'ASIA'"""),
    "source_limit": _with("raw", f"""
SELECT * FROM raw ORDER BY unique_key, arrival LIMIT {SOURCE_ROWS}"""),
    "latest_snapshot": _with("raw", """
SELECT left(created_date, 4) || '-12-31' AS snapshot_date, unique_key, arrival FROM raw
WHERE created_date <> 'not a date' AND left(created_date, 4) =
  (SELECT max(left(created_date, 4)) FROM raw WHERE created_date <> 'not a date')"""),
    "row_digest": _with("raw", f"""
SELECT count(*) AS n_rows, sum(('0x' || substr(md5({_canonical()}), 1, 8))::BIGINT)::BIGINT AS digest
FROM raw"""),
    "deliveries": _with("raw", """
SELECT CASE WHEN created_date = 'not a date' THEN '1900' ELSE left(created_date, 4) END
  || '-12-31' AS snapshot_date, count(*) AS n FROM raw GROUP BY ALL"""),
    "feature_spec": _with("bundle", f"""
SELECT '{TAG}' AS tag, 'interim' AS source_interim, '' AS created_at_utc,
  'resolution_time_hours' AS target_col, 'log1p' AS target_transform,
  '{','.join(CATS)}' AS categorical_cols, '{','.join(NUMERIC)}' AS numeric_cols,
  '{','.join(TIME_FEATURES)}' AS time_feature_cols, {N_SPLITS}::INT AS n_splits,
  10::INT AS strat_bins, 42::INT AS random_seed, 'most_frequent' AS categorical_imputer,
  'one_hot(unseen=zeros)' AS categorical_encoder, 'median' AS numeric_imputer,
  'standard(population)' AS numeric_scaler, count(*) AS n_rows FROM bundle"""),
    "fold_slice": _with("bundle", """
SELECT unique_key, round(y, 6) AS y, fold FROM bundle WHERE fold = 2"""),
    "feature_report": _with("bundle", _report()),
    "head_export": _with("best_preds", f"""
SELECT model, tag, config_id, smoothing, unique_key, fold, {_rounded(['y_true', 'y_pred'])}
FROM best_preds ORDER BY fold, unique_key LIMIT 50"""),
    # cleaning
    "blank_to_null": _with("trimmed", "SELECT * FROM trimmed"),
    "parse_timestamps": _with("typed", f"""
SELECT unique_key, arrival, {_show('created_date')}, {_show('closed_date')} FROM typed"""),
    "required_dates": _with("dated", "SELECT unique_key, arrival FROM dated"),
    "time_sanity": _with("ordered", "SELECT unique_key, arrival FROM ordered"),
    "dedup_keep_last": _with("uniq", f"""
SELECT unique_key, arrival, agency, {_show('created_date')}, {_show('closed_date')} FROM uniq"""),
    "resolution_hours": _with("ordered", f"""
SELECT unique_key, arrival, round({HOURS}, 6) AS {HOURS} FROM ordered"""),
    "valid_target": _with("dated", f"""
SELECT unique_key, arrival,
  round((epoch_us(closed_date) - epoch_us(created_date)) / 3.6e9, 6) AS {HOURS}
FROM dated WHERE epoch_us(closed_date) - epoch_us(created_date) >= 0"""),
    "keep_columns": _with("uniq", f"""
SELECT borough, agency, unique_key, {_show('created_date')}, {_show('closed_date')},
  round({HOURS}, 6) AS {HOURS} FROM uniq"""),
    "outlier_percentile": _with("interim", f"""
SELECT unique_key, round({HOURS}, 6) AS {HOURS} FROM interim"""),
    "outlier_cap": _with("uniq", f"""
SELECT unique_key, round({HOURS}, 6) AS {HOURS} FROM uniq WHERE {HOURS} <= 8760"""),
    "clean_funnel": _with("interim", f"""
SELECT 0 AS step, 'raw' AS stage, count(*) AS n_rows FROM raw
UNION ALL SELECT 1, 'empty_to_null', count(*) FROM trimmed
UNION ALL SELECT 2, 'datetime_parse', count(*) FROM typed
UNION ALL SELECT 3, 'required_dates', count(*) FROM dated
UNION ALL SELECT 4, 'time_sanity', count(*) FROM ordered
UNION ALL SELECT 5, 'dedup_unique_key', count(*) FROM uniq
UNION ALL SELECT 6, 'target_compute', count(*) FROM uniq WHERE {HOURS} >= 0
UNION ALL SELECT 7, 'outlier_filter', count(*) FROM interim"""),
    "cleaning_report": _with("interim", f"""
SELECT 'raw' AS source, 'interim' AS target, 'percentile' AS outlier_mode,
  0.999::DOUBLE AS outlier_value, '{','.join([*TEXT, HOURS])}' AS kept_columns,
  (SELECT count(*) FROM raw) AS rows_raw, (SELECT count(*) FROM trimmed) AS rows_empty_to_null,
  (SELECT count(*) FROM typed) AS rows_datetime_parse,
  (SELECT count(*) FROM dated) AS rows_required_dates,
  (SELECT count(*) FROM ordered) AS rows_time_sanity,
  (SELECT count(*) FROM uniq) AS rows_dedup_unique_key,
  (SELECT count(*) FROM uniq WHERE {HOURS} >= 0) AS rows_target_compute,
  (SELECT count(*) FROM interim) AS rows_outlier_filter"""),
    "clean_tickets": _with("interim", f"""
SELECT * REPLACE (strftime(created_date, '%Y-%m-%d %H:%M:%S') AS created_date,
  strftime(closed_date, '%Y-%m-%d %H:%M:%S') AS closed_date, round({HOURS}, 6) AS {HOURS})
FROM interim"""),
    # features, target, folds
    "time_features": _with("featured", f"""
SELECT unique_key, {', '.join(TIME_FEATURES)} FROM featured"""),
    "seeded_sample": _with("interim", f"""
SELECT unique_key, round({HOURS}, 6) AS {HOURS} FROM interim
ORDER BY md5('42:' || unique_key), unique_key LIMIT {SAMPLE_ROWS}"""),
    "target_numeric": _with("uniq", """
SELECT unique_key, round(try_cast(latitude AS DOUBLE), 6) AS y FROM uniq
WHERE isfinite(try_cast(latitude AS DOUBLE))"""),
    "target_log1p": _with("featured", "SELECT unique_key, round(y, 6) AS y FROM featured"),
    "align_semi": _with("uniq", """
SELECT unique_key, borough, latitude FROM uniq u WHERE unique_key IN
  (SELECT unique_key FROM uniq WHERE isfinite(try_cast(latitude AS DOUBLE)))"""),
    "numeric_coerce": _with("uniq", """
SELECT unique_key, round(try_cast(latitude AS DOUBLE), 6) AS latitude,
  round(try_cast(longitude AS DOUBLE), 6) AS longitude FROM uniq"""),
    "feature_table": _with("featured", f"""
SELECT unique_key, {', '.join(CATS)}, {_rounded(NUMERIC)}, {', '.join(TIME_FEATURES)}
FROM featured"""),
    "quantile_bins": _with("binned", "SELECT unique_key, y_bin FROM binned"),
    "stratified_folds": _with("bundle", "SELECT unique_key, y_bin, fold FROM bundle"),
    "fold_sizes": _with("bundle", """
SELECT fold, (sum(count(*)) OVER () - count(*))::BIGINT AS n_train, count(*) AS n_test
FROM bundle GROUP BY fold"""),
    "fold_train_test": _with("bundle", f"""
SELECT unique_key, split, CASE WHEN fold = split THEN 'test' ELSE 'train' END AS part
FROM bundle CROSS JOIN {SPLITS}"""),
    # fitted preprocessing
    "impute_mode": _with("cat_filled", _wide(CATS, "cat_filled")),
    "onehot_long": _with("levels", """
SELECT c.unique_key, c.fold, c.feature, c.value AS level, l.slot FROM cat_filled c
JOIN levels l ON c.fold = l.split AND c.feature = l.feature AND c.value = l.value"""),
    "impute_median": _with("num_filled", f"""
SELECT unique_key, fold, {_rounded(NUMS)} FROM ({_wide(NUMS, 'num_filled')})"""),
    "standardize": _with("scaling", f"""
SELECT unique_key, fold, {_rounded(NUMS)} FROM ({_wide(NUMS, '''(
  SELECT f.unique_key, f.fold, f.feature, (f.value - s.mean) / s.scale AS value
  FROM num_filled f JOIN scaling s ON f.fold = s.split AND f.feature = s.feature)''')})"""),
    "holdout_split": _with("bundle", f"""
SELECT unique_key, split, {_holdout('0.1::DOUBLE')} AS holdout_tenth,
  {_holdout('0.2::DOUBLE')} AS holdout_fifth FROM bundle JOIN {SPLITS} ON fold <> split"""),
    "target_encode": _with("overall", _target_encoded()),
    "cyclic_encode": _with("bundle", """
SELECT unique_key, round(sin(2 * pi() * created_hour / 24.0), 6) AS hour_sin,
  round(cos(2 * pi() * created_hour / 24.0), 6) AS hour_cos,
  round(sin(2 * pi() * created_dayofweek / 7.0), 6) AS day_sin,
  round(cos(2 * pi() * created_dayofweek / 7.0), 6) AS day_cos FROM bundle"""),
    "dummies_long": _with_more("bundle", f"""
, long AS MATERIALIZED ({_dummy_stack()}),
known AS MATERIALIZED (SELECT split, feature, value,
  (row_number() OVER (PARTITION BY split ORDER BY pos, num, value) - 1)::INT AS slot
  FROM (SELECT DISTINCT split, feature, pos, value, num FROM long JOIN {SPLITS}
        ON fold <> split WHERE value IS NOT NULL))
SELECT l.unique_key, l.fold, l.feature, l.value AS level, k.slot FROM long l
JOIN known k ON l.fold = k.split AND l.feature = k.feature AND l.value = k.value"""),
    "numeric_fill_zero": _with("bundle", """
SELECT unique_key, round(coalesce(latitude, 0), 6) AS latitude,
  round(coalesce(longitude, 0), 6) AS longitude, created_is_weekend,
  round(sin(2 * pi() * created_hour / 24.0), 6) AS hour_sin,
  round(cos(2 * pi() * created_hour / 24.0), 6) AS hour_cos,
  round(sin(2 * pi() * created_dayofweek / 7.0), 6) AS day_sin,
  round(cos(2 * pi() * created_dayofweek / 7.0), 6) AS day_cos FROM bundle"""),
    # evaluation
    "param_grid": _with("bundle", f"""
SELECT g.model, g.config_id, s.fold, s.n_train, s.n_test
FROM (VALUES {_grid_rows()}) g(model, config_id) CROSS JOIN (
  SELECT fold, (sum(count(*)) OVER () - count(*))::BIGINT AS n_train, count(*) AS n_test
  FROM bundle GROUP BY fold) s"""),
    "fold_metrics": _with("fold_rows", f"SELECT {FOLDS_SHOWN} FROM fold_rows"),
    "config_summary": _with("summary", f"SELECT {SUMMARY_SHOWN} FROM summary"),
    "best_config": _with("best", f"SELECT {SUMMARY_SHOWN} FROM best"),
    "mark_best": _with("best", f"""
SELECT {FOLDS_SHOWN}, config_id = (SELECT config_id FROM best) AS is_best FROM fold_rows"""),
    "results_union": _with("best", STACKED),
    "top_configs": _with("best", f"""
SELECT {SUMMARY_SHOWN}, config_id = (SELECT config_id FROM best) AS is_best FROM summary
ORDER BY summary.rmse_mean, summary.mae_mean, config_id LIMIT 5"""),
    # profiles
    "target_profile": _with("bundle", """
SELECT count(y) AS n, round(min(y), 6) AS min, round(avg(y), 6) AS mean,
  round(quantile_cont(y, 0.5), 6) AS median, round(max(y), 6) AS max,
  round(stddev_pop(y), 6) AS std FROM bundle"""),
    "dataset_summary": _with("bundle", f"""
SELECT 'rows' AS item, count(*) AS count, NULL::VARCHAR AS names FROM bundle
UNION ALL SELECT * FROM (VALUES
  ('raw feature columns', {len(CATS) + len(NUMS)}::BIGINT, '{', '.join(CATS + NUMS)}'),
  ('categorical', {len(CATS)}::BIGINT, '{', '.join(CATS)}'),
  ('numeric and time', {len(NUMS)}::BIGINT, '{', '.join(NUMS)}'))"""),
    "fold_widths": _with("levels", f"""
SELECT s.fold, n_train, n_test, (w.width + {len(NUMS)})::BIGINT AS width FROM (
  SELECT fold, (sum(count(*)) OVER () - count(*))::BIGINT AS n_train, count(*) AS n_test
  FROM bundle GROUP BY fold) s
JOIN (SELECT split, count(*) AS width FROM levels GROUP BY split) w ON w.split = s.fold"""),
    "feature_names": _with("levels", f"""
SELECT slot AS position, 'cat__' || feature || '_' || value AS name FROM levels
WHERE split = 0 AND slot < {HEAD_NAMES}"""),
    "target_hist": _with_more("bundle", _histogram("SELECT round(y, 9) AS v FROM bundle")),
    "hours_hist_clipped": _with_more("bundle", """
, hours AS (SELECT round(exp(y) - 1, 9) AS h FROM bundle)""" + _histogram("""
SELECT round(least(greatest(h, 0.0), (SELECT quantile_cont(h, 0.99) FROM hours)), 9) AS v
FROM hours""")),
    "residual_hist": _with_more(
        "best_preds", _histogram("SELECT round(y_pred - y_true, 9) AS v FROM best_preds")
    ),
    "pred_vs_true_grid": _with_more("best_preds", f"""
, pairs AS (SELECT round(y_true, 9) AS t, round(y_pred, 9) AS p FROM best_preds),
span AS (SELECT least(min(t), min(p)) AS lo, greatest(max(t), max(p)) AS hi FROM pairs)
SELECT least(floor((t - lo) / (hi - lo) * {BINS}), {BINS - 1})::INT AS true_bin,
  least(floor((p - lo) / (hi - lo) * {BINS}), {BINS - 1})::INT AS pred_bin, count(*) AS n,
  round(lo, 6) AS lo, round(hi, 6) AS hi FROM pairs, span GROUP BY ALL"""),
    "abs_error_by_target": _with_more("best_preds", f"""
, pairs AS (SELECT round(y_true, 9) AS t, abs(y_pred - y_true) AS e FROM best_preds),
span AS (SELECT min(t) AS lo, max(t) AS hi FROM pairs)
SELECT least(floor((t - lo) / (hi - lo) * {BINS}), {BINS - 1})::INT AS bin, count(*) AS n,
  round(avg(e), 6) AS mean_abs_error, round(max(e), 6) AS max_abs_error
FROM pairs, span GROUP BY ALL"""),
    "best_fold_series": _with("best", f"""
SELECT model, config_id, fold, {_rounded(['mae', 'rmse'])} FROM fold_rows
WHERE config_id = (SELECT config_id FROM best)"""),
    "best_from_results": _with("best", "SELECT model, config_id FROM best"),
    "config_ranking": _with("best", """
SELECT model, row_number() OVER (ORDER BY rmse_mean, config_id)::INT AS place, config_id,
  round(rmse_mean, 6) AS rmse_mean, config_id = (SELECT config_id FROM best) AS is_best
FROM summary"""),
    "top_types": _with("bundle", f"""
SELECT coalesce(complaint_type, 'nan') AS value, count(*) AS n FROM bundle
GROUP BY ALL ORDER BY n DESC, value LIMIT {TOP_TYPES}"""),
    "borough_counts": _with("bundle", """
SELECT coalesce(borough, 'nan') AS value, count(*) AS n FROM bundle GROUP BY ALL"""),
    "borough_mean_target": _with("bundle", """
SELECT coalesce(borough, 'nan') AS value, count(*) AS n, round(avg(y), 6) AS mean_y
FROM bundle GROUP BY ALL"""),
    # models: what every run must hold
    "rf_oof": _with("overall", _facts(["random_forest_regressor"], "count(y) AS n_within,")),
    "boost_oof": _with("overall", _facts(["boosted_trees_regressor"])),
    "cv_grid": _with("bundle", f"""
SELECT 'random_forest_regressor' AS model, '{TAG}' AS tag,
  format('rf_n{{}}_d{{}}_leaf{{}}', n_estimators, max_depth, min_samples_leaf) AS config_id,
  n_estimators::INT AS n_estimators, max_depth::INT AS max_depth, min_samples_leaf::INT AS min_samples_leaf,
  count(*) AS n_folds, sum(n_train)::BIGINT AS n_train, sum(n_test)::BIGINT AS n_test, count(n_test) AS n_sound
FROM (SELECT unnest([200, 300]) AS n_estimators), (SELECT unnest([20, 30]) AS max_depth),
  (SELECT unnest([1, 5, 10]) AS min_samples_leaf), (
  SELECT fold, sum(count(*)) OVER () - count(*) AS n_train, count(*) AS n_test FROM bundle GROUP BY fold)
GROUP BY ALL"""),
    "model_compare": _with_more("overall", f"""
, facts AS ({_facts(['category_mean', 'random_forest_regressor', 'boosted_trees_regressor']).replace("round(", "(").replace(", 6)", ")")})
SELECT model, count(*) AS n_folds, sum(n_keys)::BIGINT AS n_keys, sum(n_missing)::BIGINT AS n_missing,
  round(avg(base_mae), 6) AS base_mae, round(avg(base_rmse), 6) AS base_rmse FROM facts GROUP BY ALL"""),
}

# The same results by another mechanism.
ORACLE["live_funnel"] = ORACLE["clean_funnel"]
ORACLE["align_bucketed"] = ORACLE["align_semi"]
ORACLE["predictions_bucketed"] = _with("best_preds", """
SELECT borough, count(*) AS n, round(avg(abs(y_true - y_pred)), 6) AS mae,
  round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse
FROM best_preds JOIN bundle USING (unique_key) GROUP BY ALL""")
