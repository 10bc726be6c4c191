"""Run named queries next to their SQL: ``python tests/compare.py [sf] [name ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted((tuple("~" if pd.isna(v) else repr(float(v)) if isinstance(v, float)
                         else str(v) for v in row)
                   for row in df.astype(object).itertuples(index=False)))


def differences(spark, con, name, sf_dir) -> list[str]:
    got = queries()[name](spark, sf_dir).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        return []
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} against {sorted(want.columns)}"]
    for c in got.columns:
        if isinstance(want[c].dtype, pd.Int64Dtype) and got[c].dtype == float:
            got[c] = got[c].astype("Int64")  # whole numbers with nulls
    kinds = {c: (got[c].dtype, want[c].dtype) for c in got.columns
             if got[c].dtype != want[c].dtype}
    a, b = canonical(got), canonical(want)
    if a != b:
        extra, lacking = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return [f"{len(a)} rows against {len(b)}; types {kinds}", f"only Spark {extra}",
                f"only SQL {lacking}"]
    return [f"types {kinds}"] if kinds and len(got) else []


if __name__ == "__main__":
    from tapeworks import build_session
    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    session = build_session(master="local[8]", spark_ui_enabled="false",
                            spark_sql_shuffle_partitions="8", spark_driver_memory="8g",
                            spark_ui_showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    bad = 0
    for query in sys.argv[2:] or list(queries()):
        start = time.time()
        try:
            found = differences(session, connection, query, sf_dir)
        except Exception as failure:
            found = [f"{type(failure).__name__}: {str(failure)[:1500]}"]
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {query} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line[:1500], flush=True)
    print("differences:", bad)
