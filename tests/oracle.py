"""Compare registered queries with their SQL twins in DuckDB.

    python tests/oracle.py 0.01 [name or prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


FAMILY = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "integer": "int", "hugeint": "HUGE", "double": "double",
          "float": "float", "varchar": "string", "string": "string", "boolean": "boolean", "date": "date",
          "timestamp": "timestamp", "timestamp_ntz": "timestamp"}


def compare(query, sql: str, spark, sf_dir: str, con) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} / {sorted(relation.columns)}"
    at = [relation.columns.index(c) for c in names]
    kinds = dict(df.dtypes)
    for c, i in zip(names, at):
        left, right = FAMILY.get(kinds[c], kinds[c]), FAMILY.get(str(relation.types[i]).lower(), str(relation.types[i]))
        if left != right:
            return f"type of {c}: {kinds[c]} / {relation.types[i]}"
    want = [tuple(plain(r[i]) for i in at) for r in relation.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    key = repr
    for left, right in zip(sorted(got, key=key), sorted(want, key=key)):
        if left != right:
            return f"{names}\n   spark {left}\n   sql   {right}"
    return None


def main() -> None:
    from fieldglass.checks.registry import ORACLES, QUERIES
    from fieldglass.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(query, ORACLES[name], spark, sf_dir, con)
                shown = "ok" if problem is None else f"DIFF {problem}"
            else:
                df = query(spark, sf_dir)
                rows = df.collect()
                problem = None if rows else "no rows"
                shown = f"rows {len(rows)} {rows[0] if rows else ''}"[:150]
        except Exception as error:
            problem = str(error)
            shown = "ERROR " + type(error).__name__ + " " + str(error)[:700]
        bad += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s {shown}", flush=True)
    print("failing:", bad)


if __name__ == "__main__":
    main()
