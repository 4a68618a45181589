"""Run registered queries in Spark and their SQL oracle in DuckDB and
compare row count, column names/types and the multiset of rows.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

VIEWS = ("region nation customer supplier part orders lineitem events documents "
         "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["oracle"] = "none"
        return out
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
    out["types"] = {c: (s_types.get(c), d_types.get(c)) for c in sorted(set(s_cols) | set(d_cols))}
    if out["columns_match"]:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).elements())[:5]
            out["only_oracle"] = list((b - a).elements())[:5]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from furlong.plans.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        r = compare(spark, con, n, qs[n], oracle.get(n), sf_dir)
        ok = r.get("values_match", r.get("oracle") == "none") and (
            r.get("spark_rows") == r.get("oracle_rows", r.get("spark_rows")))
        bad += not ok
        types = r.pop("types", {})
        print(("OK  " if ok else "BAD ") + str(r))
        if not ok:
            print("    types:", types)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
