"""Run registered queries against their SQL twins in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = [
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
][0].split()
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def duck(sf_dir: str = DATA) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if glob.glob(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return Counter(tuple(value(r[k]) for k in order) for r in rows)


def kinds(types: dict[str, str]) -> dict[str, str]:
    names = {
        "bigint": "int", "int": "int", "long": "int", "hugeint": "huge", "integer": "int",
        "double": "float", "float": "float", "string": "text", "varchar": "text",
        "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date",
        "boolean": "bool",
    }
    return {k: names.get(v.lower(), v.lower()) for k, v in types.items()}


def compare(spark, name, query, con, sf_dir: str = DATA) -> str | None:
    """None when equal, else what differs."""
    df = query.run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if query.sql is None:
        return None
    rel = con.sql(query.sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    left = kinds({f.name: f.dataType.simpleString() for f in df.schema.fields})
    right = kinds(dict(zip(rel.columns, [str(t) for t in rel.types])))
    if left != right:
        return f"types {[(k, left[k], right[k]) for k in left if left[k] != right[k]]}"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
        )
    return None


def main(names: list[str]) -> int:
    from millrace.catalogue import CATALOGUE
    from millrace.session import local_session

    spark = local_session(8)
    con = duck()
    bad = 0
    for name, query in CATALOGUE.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            problem = compare(spark, name, query, con)
        except Exception as error:  # noqa: BLE001
            problem = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        took = time.time() - start
        mark = "ok  " if problem is None and query.sql else "rows" if problem is None else "FAIL"
        bad += mark == "FAIL"
        print(f"{mark} {name:32s} {took:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(1 if main(sys.argv[1:]) else 0)
