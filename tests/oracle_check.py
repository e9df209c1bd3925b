"""Compare every registered query with its DuckDB oracle (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 6)))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        v = int(v)
    return (1, repr(v) if not isinstance(v, str) else v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as E

    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in oracles:
            report[name] = {"status": "rows-only", "rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
            continue
        rel = con.sql(oracles[name])
        o_cols = rel.columns
        o_types = dict(zip(o_cols, [str(t) for t in rel.types]))
        o_rows = rel.fetchall()
        same_type = {("bigint", "BIGINT"), ("string", "VARCHAR"), ("int", "INTEGER"), ("double", "DOUBLE"),
                     ("boolean", "BOOLEAN")}
        type_diffs = {f.name: (f.dataType.simpleString(), o_types.get(f.name)) for f in df.schema.fields
                      if (f.dataType.simpleString(), o_types.get(f.name)) not in same_type}
        ok_cols = sorted(s_cols) == sorted(o_cols)
        ok_n = len(s_rows) == len(o_rows)
        ok_v = ok_cols and rows_of(s_cols, s_rows) == rows_of(o_cols, o_rows)
        entry = {
            "status": "ok" if (ok_cols and ok_n and ok_v) else "MISMATCH",
            "rows": len(s_rows),
            "oracle_rows": len(o_rows),
            "spark_s": round(t1 - t0, 2),
        }
        if type_diffs:
            entry["type_diffs"] = type_diffs
        if not ok_cols:
            entry["cols"] = (sorted(s_cols), sorted(o_cols))
        elif not ok_v:
            a, b = set(rows_of(s_cols, s_rows)), set(rows_of(o_cols, o_rows))
            entry["spark_only"] = [str(x)[:300] for x in list(a - b)[:2]]
            entry["oracle_only"] = [str(x)[:300] for x in list(b - a)[:2]]
        report[name] = entry
    return report


if __name__ == "__main__":
    from sourcelens.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    rep = compare(spark, sf, names)
    for k, v in rep.items():
        print(k, v)
    bad = [k for k, v in rep.items() if v["status"] == "MISMATCH"]
    print("MISMATCHES:", bad)
    sys.exit(1 if bad else 0)
