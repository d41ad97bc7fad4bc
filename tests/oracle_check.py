"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows.

    python tests/oracle_check.py [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _cell(v: object) -> object:
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(rows: list, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def oracle(sf_dir: str):
    """A DuckDB connection with the source tables as views."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name: str, query, sf_dir: str) -> tuple[bool, str]:
    """Whether both engines agree on one query, and a line about it."""
    t0 = time.time()
    df = query.run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if query.sql is None:
        return True, f"{name}: rows only, {len(got)} rows, {t1 - t0:.1f}s"
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    line = f"{name}: {len(got)} rows, {t1 - t0:.1f}s (sql {t2 - t1:.1f}s)"
    if sorted(names) != sorted(df.columns):
        return False, f"{line} COLUMNS {sorted(df.columns)} vs {sorted(names)}"
    a, b = _rows(got, df.columns), _rows(want, names)
    if a == b:
        return True, line
    only_a = [x for x in a if x not in set(b)][:3] if len(a) < 300000 else a[:3]
    only_b = [x for x in b if x not in set(a)][:3] if len(b) < 300000 else b[:3]
    return False, f"{line} DIFFER {len(a)} vs {len(b)} {sorted(names)}\n   spark {only_a}\n   sql   {only_b}"


def main() -> int:
    from adjudica.plans.registry import load_all
    from adjudica.session import local_session

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    queries = load_all()
    names = sys.argv[1:] or list(queries)
    spark, con, bad = local_session(8), oracle(sf_dir), []
    for name in names:
        try:
            ok, line = compare(spark, con, name, queries[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, line = False, f"{name}: FAILED {type(error).__name__} {str(error)[:600]}"
        print(("ok   " if ok else "BAD  ") + line, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree; not: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
