"""Compare registered Spark queries with their DuckDB oracle.

Mirrors the driver's gate: row count, column names, and an order-insensitive
hash of the values (doubles rounded to 6 places, columns sorted by name).

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if EXACT else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return names, len(rows), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols, d_rows = rel.columns, rel.fetchall()
    t2 = time.time()
    sn, sc, sh = digest(sdf.columns, s_rows)
    dn, dc, dh = digest(d_cols, d_rows)
    return {"name": name, "names": sn == dn, "rows": (sc, dc), "hash": sh == dh,
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
            "spark_cols": sn, "duck_cols": dn}


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from polarity.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_session(shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in oracle:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows {time.time() - t0:.1f}s", flush=True)
            continue
        res = compare(spark, con, name, fn, oracle[name], sf_dir)
        ok = res["names"] and res["hash"] and res["rows"][0] == res["rows"][1]
        bad += not ok
        print(("OK   " if ok else "FAIL ") + str(res if not ok else
              {k: res[k] for k in ("name", "rows", "spark_s", "duck_s")}), flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
