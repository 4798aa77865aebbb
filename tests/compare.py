"""Run registered queries against DuckDB on the same tables and compare all rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{round(float(v), 6) + 0.0:.6f}"
    return str(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir, query, sql):
    """None when equal, else a short account of what differs."""
    df = query(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = normalised(df.columns, got_rows), normalised(names, want_rows)
    if got != want:
        only_got = sorted(set(got) - set(want))[:3]
        only_want = sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows vs {len(want)}; only here {only_got}; only SQL {only_want}"
    return None if got else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from fundscape.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        "compare", f"local[{os.environ.get('COMPARE_CPUS', 8)}]", 8, **{"spark.driver.memory": "10g", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    for name, q in entry.queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in sqls:
                problem = differences(spark, con, sf_dir, q, sqls[name])
                state = "ok" if problem is None else problem
            else:
                state = f"rows only: {q(spark, sf_dir).count()}"
        except Exception as e:
            state = "FAILED " + str(e)[:300]
        print(f"{name}: {state} ({time.time() - t:.1f}s)", flush=True)
        spark.catalog.clearCache()
