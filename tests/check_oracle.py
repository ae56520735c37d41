"""Compare every registered query with its SQL on one data folder.

Usage: python tests/check_oracle.py [folder] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "~"
        if hasattr(v, "isoformat"):
            return str(pd.Timestamp(v))
        if isinstance(v, float) or type(v).__name__.startswith("float"):
            return repr(float(v))
        if hasattr(v, "item"):
            return str(v.item())
        return str(v)

    ordered = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False))


def compare(spark, con, name, query, sql, folder) -> str | None:
    """None when equal, else a description of the first difference."""
    left = query(spark, folder)
    rel = con.sql(sql)
    if sorted(left.columns) != sorted(rel.columns):
        return f"columns {sorted(left.columns)} != {sorted(rel.columns)}"
    rows = left.collect()
    a = canonical(pd.DataFrame([tuple(r) for r in rows], columns=left.columns, dtype=object))
    b = canonical(pd.DataFrame(rel.fetchall(), columns=rel.columns, dtype=object))
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    odd = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(odd)} of {len(a)} rows differ, e.g. {odd[0]}" if odd else None


def main() -> int:
    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in e.queries().items():
        if not name.startswith(prefixes):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, name, query, e.oracle_sql()[name], folder)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:30s} {time.time() - began:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
