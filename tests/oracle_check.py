"""Side-by-side check of ``queries()`` against ``oracle_sql()`` (DuckDB).

Compares row count, column names, column types and an order-insensitive
multiset of rows.
Floats must be equal to the bit (the bindings are built so they are); text,
integers and NULLs compare exactly. Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        from decimal import Decimal
        if isinstance(v, Decimal):
            return float(v)
    except Exception:  # pragma: no cover
        pass
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, out


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


# Spark type -> DuckDB type of the same values
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "date": "DATE"}


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    s_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    if s_types != d_types:
        problems.append(f"types spark={s_types} duck={d_types}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    cs, cd = Counter(map(repr, s_rows)), Counter(map(repr, d_rows))
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    return len(s_rows), problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    names = argv[2:]
    from ledgerloom.session import get_spark
    import __spark_entry__ as e

    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            n, problems = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as ex:  # report and go on
            n, problems = -1, [f"error {type(ex).__name__}: {str(ex)[:400]}"]
        status = "ok" if not problems else "FAIL " + " | ".join(problems)
        bad += bool(problems)
        print(f"{name:28s} rows={n:<7d} {status}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
