"""Partitions are replaced by rows that are computed once."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.sources import sinks, tables

SCHEMA = "id BIGINT, y INT"


def test_replaced_partitions_are_computed_once(spark, tmp_path):
    path, calls = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    old = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None)], SCHEMA)
    sinks.write_parquet(old, path, ["y"])

    def year(i):
        calls.add(1)
        return None if i == 9 else 2

    fresh = spark.createDataFrame([(7,), (8,), (9,)], "id BIGINT").withColumn("y", F.udf(year, "int")("id"))
    values = spark.createDataFrame([(2,), (3,), (None,)], "y INT")
    sinks.replace_partitions(fresh, path, "y", values)
    assert calls.value == 3
    rows = tables.read_table(spark, path, SCHEMA).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 1), (7, 2), (8, 2), (9, None)], key=str)
    sinks.replace_partitions(fresh.limit(0), path, "y", values)
    assert [tuple(r) for r in tables.read_table(spark, path, SCHEMA).collect()] == [(1, 1)]
