"""Run registered queries and their SQL twins side by side: python tests/check_oracle.py [sf] [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from caseweave.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object).where(df.notna(), None)
    rows = sorted([tuple(r) for r in df.itertuples(index=False)], key=repr)
    return pd.DataFrame(rows, columns=df.columns)


def nullable_integers(mine: pd.Series, theirs: pd.Series) -> bool:
    """pandas has no plain integers beside nulls: they come as floats from Spark and as Int64 from SQL. The values are compared all the same."""
    return str(mine.dtype) == "float64" and str(theirs.dtype) == "Int64" and bool(mine.isna().any()) and bool((mine.dropna() % 1 == 0).all())


def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> str:
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} vs {sorted(theirs.columns)}"
    kinds = {c: (str(mine[c].dtype), str(theirs[c].dtype)) for c in mine.columns
             if mine[c].dtype != theirs[c].dtype and len(mine) and not nullable_integers(mine[c], theirs[c])}
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    a, b = canonical(mine), canonical(theirs)
    for i in range(len(a)):
        if repr(tuple(a.iloc[i])) != repr(tuple(b.iloc[i])) and tuple(a.iloc[i]) != tuple(b.iloc[i]):
            return f"row {i}: {tuple(a.iloc[i])}  !=  {tuple(b.iloc[i])}  kinds {kinds}"
    return f"types {kinds}" if kinds else "ok"


def main(sf: str, names: list[str]) -> int:
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        try:
            t0 = time.time()
            mine = run(spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in sql:
                print(f"{name:28s} rows-only {len(mine):7d} {t1 - t0:6.2f}s", flush=True)
                continue
            theirs = con.execute(sql[name]).df()
            verdict = compare(mine, theirs)
            print(f"{name:28s} {verdict[:600]} ({len(mine)} rows, {t1 - t0:.2f}s, sql {time.time() - t1:.2f}s)", flush=True)
            bad += verdict != "ok"
        except Exception as e:  # report and go on
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:700]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:]) > 0)
