"""Helpers that the operators share: written intermediate tables, joins with hot keys,
batches of rows for tasks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import new_workspace

#: A key counts as hot from this many rows on, or from 1/HOT_KEYS of all rows on if
#: that is more; so there are never more than HOT_KEYS hot keys.
HOT_ROWS, HOT_KEYS = 2_000, 100_000


_Scope = list[tuple[SparkSession, str]]
_SCOPES: ContextVar[tuple[_Scope, ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that ``written`` makes inside are deleted at the end, but for those to keep."""
    mine: _Scope = []
    before = _SCOPES.set((*_SCOPES.get(), mine))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        for spark, path in mine:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def written(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the folder that all executors share.

    Cuts lineage: what is computed once is not computed again for each use, nor when an
    executor is lost. The folder belongs to the caller's ``spark.checkpoint.dir``; inside
    ``scratch`` the table goes with the others, or with ``keep`` with those around them.
    """
    path = new_workspace(df.sparkSession, label)
    scopes = _SCOPES.get()[:-1] if keep else _SCOPES.get()
    if scopes:
        scopes[-1].append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def meet(
    left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int, how: str, strategy: str | None = None
) -> DataFrame:
    """Join ``left`` with ``right``, which has one row per key and, in ``rows``, how many
    rows of ``left`` have the key.

    A hot key (see HOT_ROWS) is dealt into slices: ``right``'s row is repeated once per
    slice and each row of ``left`` goes to the slice that a hash of the whole row names.
    The hot keys that ``left`` is told of by broadcast number HOT_KEYS at most. ``strategy``
    is a join hint: with ``shuffle_hash``, for a ``right`` with few rows of few bytes, ``left``
    is not sorted.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    slices = F.when(F.col(rows) > limit, F.ceil(F.col(rows) / limit)).otherwise(1).cast("int")
    sliced = right.withColumn("_slices", slices)
    hot = sliced.where("_slices > 1").select(*keys, "_slices")
    spread = F.pmod(F.xxhash64(*[c for c in left.columns]), F.coalesce("_slices", F.lit(1))).cast("int")
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("_slice", spread).drop("_slices")
    repeated = sliced.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    repeated = repeated.drop("_slices")
    return dealt.join(repeated.hint(strategy) if strategy else repeated, [*keys, "_slice"], how).drop("_slice")


def taken(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


def pieces(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``rows`` rows."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
