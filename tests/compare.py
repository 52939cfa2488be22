"""Compare a Spark query with its check SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, datetime) and v.time() == datetime.min.time():
        return v.date()
    if isinstance(v, (date, str, int, bool)) or v is None:
        return v
    return str(v)


KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs in schema or in the multiset of rows; empty when equal."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    rows = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name].split(".")[-1]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    order = sorted(names)
    ours = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    at = [names.index(c) for c in order]
    theirs = Counter(tuple(_plain(r[i]) for i in at) for r in rows)
    if ours != theirs:
        problems.append(
            f"rows {sum(ours.values())} against {sum(theirs.values())}; "
            f"only Spark {list((ours - theirs).items())[:3]}; "
            f"only SQL {list((theirs - ours).items())[:3]}"
        )
    return problems
