"""Run a registered query and its SQL counterpart and compare them as multisets of rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(sql).df()


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        kind = str(df[c].dtype)
        if kind.startswith("datetime"):
            df[c] = df[c].dt.strftime("%Y-%m-%d")
        elif kind == "object" or kind.startswith("str"):
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
        elif kind == "bool":
            df[c] = df[c].astype("int64")
    return df


def digest(df: pd.DataFrame) -> tuple[int, list[str], int]:
    """Rows, columns and an order-free hash with exact values."""
    df = normal(df)
    for c in df.columns:
        if df[c].dtype != object and not str(df[c].dtype).startswith("str"):
            df[c] = df[c].astype("float64") + 0.0
    hashed = pd.util.hash_pandas_object(df, index=False)
    return len(df), list(df.columns), int(hashed.sum())


def compare(spark, sf_dir: str, name: str, queries, oracles) -> tuple[bool, str]:
    start = time.time()
    got = queries[name](spark, sf_dir).toPandas()
    took = time.time() - start
    if name not in oracles:
        return len(got) > 0, f"rows only: {len(got)} ({took:.1f}s)"
    start = time.time()
    want = oracle_frame(sf_dir, oracles[name])
    sql_took = time.time() - start
    a, b = digest(got), digest(want)
    if a == b:
        return True, f"{a[0]} rows ({took:.1f}s, sql {sql_took:.1f}s)"
    return False, f"got {a[0]} {a[1]}\nwant {b[0]} {b[1]}\n{normal(got).head(5)}\n{normal(want).head(5)}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from shelfcast.session import build_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g", spark__ui__enabled="false",
        spark__sql__execution__arrow__pyspark__enabled="true", spark__driver__maxResultSize="4g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in names or queries:
        try:
            ok, note = compare(spark, f"/root/testdata/{sf}", name, queries, oracles)
        except Exception as err:
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
