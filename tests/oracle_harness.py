"""Run a contract query on Spark and its SQL on DuckDB, and compare results.

Comparison is order-insensitive: columns sorted by name, rows sorted, doubles
rounded to 9 significant digits, timestamps compared as naive UTC text.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        ts = pd.Timestamp(v)
        if ts.tzinfo is not None:
            ts = ts.tz_convert("UTC").tz_localize(None)
        return ts.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def normalise(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm_value(None if (not isinstance(x, (list, tuple)) and pd.isna(x)) else x)
                          for x in rec))
    rows.sort()
    return rows


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duckdb_connection(sf_dir)
    s_pdf = query(spark, sf_dir).toPandas()
    d_pdf = con.execute(sql).df()
    result = {"name": name, "spark_rows": len(s_pdf), "oracle_rows": len(d_pdf),
              "columns_match": sorted(s_pdf.columns) == sorted(d_pdf.columns)}
    if not result["columns_match"]:
        result["spark_cols"] = sorted(s_pdf.columns)
        result["oracle_cols"] = sorted(d_pdf.columns)
        result["match"] = False
        return result
    a, b = normalise(s_pdf), normalise(d_pdf)
    result["match"] = a == b
    if not result["match"]:
        sa, sb = set(a), set(b)
        result["only_spark"] = sorted(sa - sb)[:3]
        result["only_oracle"] = sorted(sb - sa)[:3]
    return result


if __name__ == "__main__":
    import json
    import sys
    import time

    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from flightlens.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duckdb_connection(sf_dir)
    for name in (names or list(qs)):
        t = time.time()
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(json.dumps({"name": name, "rows_only": n, "sec": round(time.time() - t, 2)}))
            continue
        try:
            r = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # report and go on with the next query
            r = {"name": name, "error": repr(e)[:600]}
        r["sec"] = round(time.time() - t, 2)
        print(json.dumps(r, default=str))
