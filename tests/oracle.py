"""Run a registered query and its SQL side by side.

    python tests/oracle.py [sf0.01] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "asDict"):
        return tuple(sorted((k, _plain(v)) for k, v in value.asDict().items()))
    return str(value)


_FAMILY = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "array<double>": "DOUBLE[]",
}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    columns = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    described = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != columns:
        return f"columns {columns} != {sorted(described)}"
    for name, kind in df.dtypes:
        if _FAMILY.get(kind, kind) != described[name]:
            return f"type of {name}: {kind} != {described[name]}"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    place = [names.index(c) for c in columns]
    want = sorted(tuple(_plain(r[i]) for i in place) for r in cursor.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{columns}\n spark  {a}\n oracle {b}"
    return None if got else "EMPTY"


def main() -> None:
    from rollcall.plans import ORACLE, QUERIES, load_all
    from rollcall.session import build_session

    load_all()
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in args or QUERIES:
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = compare(df, con, ORACLE[name])
            else:
                n = df.count()
                problem = None if n else "EMPTY"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        mark = "ok " if problem is None else "BAD"
        bad += problem is not None
        kind = "sql " if name in ORACLE else "rows"
        print(f"{mark} {kind} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
