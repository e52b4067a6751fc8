"""Run catalog queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]

Comparison mirrors the correctness gate: same column names (as a set),
same row count and the same multiset of rows, values compared exactly
after normalising types (dates/timestamps to ISO text, ints to int,
floats to float).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {
    "LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE", "StringType()": "VARCHAR",
    "DateType()": "DATE", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP",
}


def type_mismatches(sdf, con, sql):
    """Columns whose Spark type does not map to the oracle's DuckDB type."""
    duck_types = {c[0]: c[1] for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = {}
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType))
        if duck_types.get(f.name) != want:
            out[f.name] = (repr(f.dataType), duck_types.get(f.name))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2),
           "rows": (len(s_rows), len(d_rows))}
    if sorted(s_cols) != sorted(d_cols):
        res["ok"] = False
        res["why"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    bad_types = type_mismatches(sdf, con, sql)
    if bad_types:
        res["ok"] = False
        res["why"] = f"types differ: {bad_types}"
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        res["ok"] = False
        res["why"] = "row count"
        return res
    diffs = [(x, y) for x, y in zip(a, b) if x != y]
    res["ok"] = not diffs
    if diffs:
        res["why"] = f"{len(diffs)} rows differ, first: {diffs[0]}"
    return res


def main(argv):
    from domainpulse.session import local_session
    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"NO-ORACLE {name}: rows={df.count()}")
            continue
        try:
            res = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            res = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not res["ok"]
        print(("OK   " if res["ok"] else "FAIL ") + str(res), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
