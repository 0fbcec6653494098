"""Compare a Spark result with its SQL twin as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def kind(type_name: str) -> str:
    """Types as both engines name them."""
    name = type_name.lower().split("(")[0]
    return {"int": "integer", "string": "varchar"}.get(name, name)


def compare(df, connection, sql: str) -> list[str]:
    """Differences, as messages; empty when the results agree."""
    cursor = connection.execute(sql)
    expected_types = {c[0]: kind(str(c[1])) for c in cursor.description}
    expected_names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    types = {name: kind(type_) for name, type_ in df.dtypes}
    if sorted(types) != sorted(expected_names):
        return [f"columns {sorted(types)} != {sorted(expected_names)}"]
    problems = [
        f"type of {name}: {types[name]} != {expected_types[name]}"
        for name in types
        if types[name] != expected_types[name]
    ]
    names = sorted(types)
    ours = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    at = [expected_names.index(n) for n in names]
    theirs = Counter(tuple(plain(row[i]) for i in at) for row in expected)
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
        problems.append(
            f"rows {sum(ours.values())} vs {sum(theirs.values())};"
            f" only Spark {len(only_ours)}: {sorted(only_ours, key=str)[:2]};"
            f" only SQL {len(only_theirs)}: {sorted(only_theirs, key=str)[:2]}"
        )
    return problems
