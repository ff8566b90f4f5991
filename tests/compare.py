"""Run queries next to their SQL twins: ``python tests/compare.py SF_DIR [names]``."""

import glob
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)) if v is None else "", v if v is not None else 0) for v in row)


def compare(spark, con, sf_dir, name):
    """(problem or None, rows, Spark seconds, SQL seconds): names, row count and every value alike."""
    start = time.time()
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    mid = time.time()
    result = con.execute(oracle_sql()[name])
    found = [c[0] for c in result.description]
    order = sorted(range(len(found)), key=lambda i: found[i])
    want = [tuple(row[i] for i in order) for row in result.fetchall()]
    end = time.time()
    times = (len(got), mid - start, end - mid)
    if columns != sorted(found):
        return (f"columns {columns} against {sorted(found)}",) + times
    if len(got) != len(want):
        return (f"{len(got)} rows against {len(want)}",) + times
    wrong = [(g, w) for g, w in zip(sorted(got, key=_key), sorted(want, key=_key)) if g != w]
    if wrong:
        g, w = wrong[0]
        diff = [(c, a, b) for c, a, b in zip(columns, g, w) if a != b]
        return (f"{len(wrong)} rows differ, first {g[:2]}: {diff[:4]}",) + times
    return (None,) + times


if __name__ == "__main__":
    from navspan.session import build_session

    spark = build_session({"master": "local[8]", "shuffle_partitions": 8, "spark.ui.enabled": "false",
                           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    sf = sys.argv[1]
    con = connect(sf)
    for name in sys.argv[2:] or list(oracle_sql()):
        try:
            problem, rows, ours, theirs = compare(spark, con, sf, name)
            print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} spark={ours:.1f}s sql={theirs:.1f}s {problem or ''}", flush=True)
        except Exception as e:
            print(f"FAIL {name} {type(e).__name__} {str(e)[:300]}", flush=True)
