"""Run queries and their SQL twins side by side: python -m tests.compare [sf_dir] [name ...]"""

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_value(row[i]) for i in order] for row in rows), key=repr)


def compare(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None when equal, else what differs."""
    start = time.time()
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    mid = time.time()
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = _rows(names, rel.fetchall())
    compare.seconds = (mid - start, time.time() - mid)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
    odd = {n: (t, types[n]) for n, t in df.dtypes if same.get(t) != types[n]}
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        cols = sorted(names)
        cells = [(c, a, b) for g, w in bad[:3] for c, a, b in zip(cols, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, e.g. {str(cells)[:900]}"
    if odd:
        return f"types {odd}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from galewire.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), duck(sf)
    oracles = oracle_sql()
    failed = []
    for name, run in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        try:
            if name not in oracles:
                problem = f"(rows only) {run(spark, sf).count()}"
            else:
                problem = compare(spark, con, sf, run, oracles[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        took = "%.1fs/%.1fs" % getattr(compare, "seconds", (0, 0))
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {took} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
