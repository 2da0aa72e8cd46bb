"""Run registered queries and their DuckDB statements side by side.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf[sorted(pdf.columns)].copy()
    for c in out.columns:
        if pd.api.types.is_bool_dtype(out[c]):
            out[c] = out[c].astype(object).map(str)
        elif pd.api.types.is_numeric_dtype(out[c]):
            out[c] = out[c].astype(float).map(lambda v: "" if pd.isna(v) else repr(v + 0.0))
        else:
            out[c] = out[c].map(lambda v: "" if pd.isna(v) else str(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    bad = (a != b).any(axis=1)
    if bad.any():
        where = {c: int((a[c] != b[c]).sum()) for c in a.columns if (a[c] != b[c]).any()}
        return f"values differ {where}\n{a[bad].head(3)}\n{b[bad].head(3)}"
    return ""


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    oracle = contract.oracle_sql()
    failures = 0
    for name, run in contract.queries().items():
        if len(args) > 1 and name not in args[1:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            got = df.toPandas()
            took = time.time() - start
            if name not in oracle:
                print(f"rows  {name:22s} {len(got):7d} {took:6.2f}s")
                continue
            rel = con.sql(oracle[name])
            problem = compare(got, rel.df())
            kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            spark_kinds = dict(df.dtypes)
            names = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR",
                     "double": "DOUBLE", "boolean": "BOOLEAN"}
            off = [c for c in kinds if names.get(spark_kinds.get(c)) != kinds[c]]
            if off:
                problem += f" types {[(c, spark_kinds.get(c), kinds[c]) for c in off]}"
        except Exception as e:  # noqa: BLE001
            problem, took, got = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start, []
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '}  {name:22s} {len(got):7d} {took:6.2f}s {problem}")
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
