"""Shaping rows to a declared structure.

Wide projections are written as SQL expressions: Spark parses them in one call,
where a Column object per field costs several driver round trips each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the declared fields at every level. A missing parent becomes a struct
    of nulls; everything undeclared is dropped, also from the scan."""
    return df.selectExpr(*[f"{_shaped(f.dataType, f.name)} AS {f.name}" for f in schema])


def _shaped(data_type: T.DataType, path: str) -> str:
    if isinstance(data_type, T.StructType):
        inner = [f"'{f.name}', {_shaped(f.dataType, f'{path}.{f.name}')}" for f in data_type]
        return f"named_struct({', '.join(inner)})"
    return f"try_cast({path} AS {data_type.simpleString()})"


def flattened(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Select ``name -> (path, type)``; a value that does not fit becomes null."""
    return df.selectExpr(
        *[f"try_cast({path} AS {type_}) AS {name}" for name, (path, type_) in columns.items()]
    )
