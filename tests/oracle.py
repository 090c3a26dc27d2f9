"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return "~null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "~nan"
        return f"f{v:.9g}"
    if isinstance(v, int):
        return f"i{v}"
    return f"{type(v).__name__}:{v}"


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


TIMES: dict[str, float] = {}


def compare(spark, con, folder, name, fn, sql) -> str | None:
    """None when equal, otherwise what differs."""
    start = time.time()
    df = fn(spark, folder)
    got_cols, got = table_of(df.columns, [tuple(r) for r in df.collect()])
    TIMES[name] = time.time() - start
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    want_cols, want = table_of([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if not want:
        return "the SQL gives no rows"
    if got == want:
        return None
    extra, missing = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} vs {len(want)} rows; {len(extra)} only Spark {sorted(extra)[:3]}; {len(missing)} only SQL {sorted(missing)[:3]}"


def main() -> None:
    from strandtide.plans.registry import all_queries, all_sql
    from strandtide.runtime import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = all_sql()
    bad = 0
    for name, fn in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, fn, sql.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {TIMES.get(name, 0):6.1f}s of {time.time() - start:6.1f}s {name}{'' if sql.get(name) else ' (rows only)'} {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
