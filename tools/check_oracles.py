"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracles.py [sf_dir] [name ...]

Prints one line per query: status, row counts, and the first difference.
Comparison: same column names, same row count, same multiset of rows after
rounding floats to 6 places (order-insensitive).
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm_value(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm_value(x) for x in v)
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return round(float(v), 6) + 0.0
    except Exception:
        pass
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm_value(r[i]) for i in order) for r in rows)


def duck_connect(sf_dir):
    import duckdb

    from msgtriage.plans.fixtures import TABLES

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT", "date": "DATE",
}


def type_mismatches(sdf, res) -> list[str]:
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
    out = []
    for d in res.description:
        duck = str(d[1]).upper()
        if spark_types.get(d[0]) != duck:
            out.append(f"{d[0]}: spark {spark_types.get(d[0])} duck {duck}")
    return out


def compare(spark, con, name, query, sf_dir):
    t0 = time.time()
    sdf = query.fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    if query.sql is None:
        return ("ROWS", len(s_rows), None, t_spark, "")
    res = con.execute(query.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return ("COLS", len(s_rows), len(d_rows), t_spark, f"{sorted(s_cols)} vs {sorted(d_cols)}")
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        types = type_mismatches(sdf, res)
        return ("OK", len(s_rows), len(d_rows), t_spark, ("TYPES " + "; ".join(types)) if types else "")
    only_s = list((a - b).elements())[:2]
    only_d = list((b - a).elements())[:2]
    return ("DIFF", len(s_rows), len(d_rows), t_spark, f"spark-only {only_s!r:.400} duck-only {only_d!r:.400}")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from msgtriage.plans.catalog import REGISTRY
    from msgtriage.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        try:
            status, ns, nd, t, msg = compare(spark, con, name, q, sf_dir)
        except Exception as ex:  # report and continue
            status, ns, nd, t, msg = "ERROR", None, None, 0.0, repr(ex)[:600]
        bad += status not in ("OK", "ROWS")
        print(f"{status:5s} {name:28s} spark={ns} duck={nd} {t:6.1f}s {msg}", flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
