"""Run queries in Spark and their SQL in DuckDB, compare all rows."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float,)) or type(value).__name__ == "Decimal":
        if math.isnan(value):
            return "nan"
        return float(f"{float(value):.9g}") + 0.0
    return value


def key(row):
    return tuple((v is None, str(type(v).__name__ if not isinstance(v, (int, float)) else "n"), str(v)) for v in row)


def compare(df, con, sql: str) -> str:
    """'' when equal, otherwise what differs."""
    cols = sorted(df.columns)
    got = [tuple(canon(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    idx = [names.index(c) for c in cols]
    want = [tuple(canon(r[i]) for i in idx) for r in cur.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got.sort(key=key)
    want.sort(key=key)
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        return f"{cols}: {len(bad)} of {len(got)} rows differ, first: {bad[0]}"
    huge = [c for c, t in types.items() if "HUGEINT" in t or "INT128" in t]
    return f"huge: {huge}" if huge else ""


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from cohortwise.session import local_session

    spark = local_session("oracle")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                message = compare(df, con, oracles[name])
            else:
                message = "" if df.count() >= 1 else "no rows"
        except Exception as error:  # report and go on with the next query
            message = "ERROR " + "".join(traceback.format_exception_only(error)).strip()[:1500]
        failed += bool(message)
        mark = "FAIL" if message else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name} {time.time() - start:.1f}s {message}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
