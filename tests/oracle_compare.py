"""Compare registered Spark queries with their DuckDB oracles.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Prints one line per query: rows, column names, and an order-insensitive
value comparison (exact for text/integers, exact repr for doubles).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from livemart.session import build_session  # noqa: E402
from livemart.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        return repr(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


# Spark type -> DuckDB type name, for the schema part of the comparison
DUCK_TYPES = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
              "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "ShortType": "SMALLINT",
              "ByteType": "TINYINT"}


def type_diff(sdf, rel_cols, rel_types):
    s = {f.name: DUCK_TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__)
         for f in sdf.schema.fields}
    d = dict(zip(rel_cols, (str(t) for t in rel_types)))
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    if sql is None:
        return f"{name:28s} spark_rows={len(s_rows):7d} (no oracle) {ts:.1f}s"
    rel = con.sql(sql)
    d_cols, d_types = list(rel.columns), list(rel.types)
    d_rows = con.execute(sql).fetchall()
    types = type_diff(sdf, d_cols, d_types)
    ok_cols = sorted(s_cols) == sorted(d_cols) and not types
    ok_n = len(s_rows) == len(d_rows)
    ok_v = sorted(s_cols) == sorted(d_cols) and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    msg = f"{status} {name:28s} rows {len(s_rows)}/{len(d_rows)} cols={'ok' if ok_cols else (s_cols, d_cols, types)} values={'ok' if ok_v else 'DIFF'} {ts:.1f}s"
    if not ok_v and sorted(s_cols) == sorted(d_cols):
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        sa, sb = set(a), set(b)
        only_s = [r for r in a if r not in sb][:3]
        only_d = [r for r in b if r not in sa][:3]
        msg += f"\n    cols={sorted(s_cols)}\n    spark-only={only_s}\n    duck-only={only_d}"
    return msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            line = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            line = f"ERR {name}: {str(e)[:600]}"
        bad += not line.startswith("OK")
        print(line, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv)
