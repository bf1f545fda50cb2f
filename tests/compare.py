"""Run queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return "\0null"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(0.0 + round(v, 9)) if v != int(v) else str(int(v))
    return str(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, q, folder):
    """(ok, message) for one registered query."""
    started = time.time()
    df = q.run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    if q.sql is None:
        return len(rows) > 0, f"{len(rows)} rows, {took:.1f}s, no SQL"
    started = time.time()
    cursor = con.execute(q.sql)
    want_columns = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    sql_took = time.time() - started
    got, want = normalise(df.columns, rows), normalise(want_columns, want_rows)
    note = f"{len(rows)} rows, {took:.1f}s, sql {sql_took:.1f}s"
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return len(rows) > 0, note if rows else "no rows on either side"
    differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]
    return False, f"{note}; {len(got[1])} vs {len(want[1])} rows; first differences {str(differing)[:1200]}"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from newslens.plans import load_all
    from newslens.session import build_session

    folder, picks = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "10g",
    })
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = []
    for name, q in load_all().items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        try:
            ok, message = compare(spark, con, q, folder)
        except Exception as e:  # report and go on with the next query
            ok, message = False, f"{type(e).__name__}: {str(e)[:900]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
