"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet table.

    Rows of one partition value are brought together so that few files are
    written, yet adaptive execution splits a value that holds very many rows.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    gathered = df.hint("rebalance", *[F.col(c) for c in partition_by])
    gathered.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    files, place = _files(spark, path)
    files.delete(place, True)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files under ``paths``, by the file system's listing."""
    places = [_files(spark, path) for path in paths]
    return sum(files.getContentSummary(place).getLength() for files, place in places)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file as it stands, on whatever file system the path names."""
    files, place = _files(spark, path)
    out = files.create(place, True)
    out.write(bytearray(content))
    out.close()


def replace_partitions(df: DataFrame, path: str, partition: str, values: DataFrame) -> None:
    """Replace those partitions of a Parquet table that ``values`` (one column, distinct)
    names by the rows of ``df``; a partition that has no rows any more goes. Files of all
    other partitions stay as they are.

    ``df`` must not read the table itself. It is computed once: the partitions that have rows
    are noted while they are written. The driver sees names of partitions.
    """
    name = F.coalesce(F.col(partition).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    seen = Observation()
    gathered = df.hint("rebalance", F.col(partition)).observe(seen, F.collect_set(name).alias("left"))
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)
    left = seen.get["left"]
    emptied = values.where(~name.isin(left)) if left else values
    for value in emptied.agg(F.collect_list(name)).first()[0]:
        delete_path(df.sparkSession, f"{path}/{partition}={value}")


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table in ``buckets`` buckets by ``key``, each one sorted file, and the table read.

    Tables in equally many buckets by one key are joined, and grouped, where they lie,
    without a shuffle. All rows of a key share a bucket: for keys of many rows join
    unbucketed tables with ``fan_out_left_join``.
    """
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


#: Lines of one JSON file: a compressed file is read by one task.
JSON_RECORDS_PER_FILE = 250_000


def write_json_lines(
    df: DataFrame, path: str, records_per_file: int = JSON_RECORDS_PER_FILE, partition_by: list[str] | None = None
) -> None:
    """One JSON object per line, gzipped; fields that are null are left out. Files hold at
    most ``records_per_file`` lines (0: any number)."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", records_per_file)
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.partitionBy(*partition_by or []).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One JSON array over many lines, in one file: for dimensions only. Fields that are
    null are left out."""
    rows = F.collect_list(F.struct(*df.columns))
    text = df.agg(F.to_json(rows, {"pretty": "true"}).alias("value"))
    text.write.mode("overwrite").text(path)


def write_text_lines(df: DataFrame, path: str, line: str, *order) -> None:
    """Lines in the given order; part files follow each other in that order."""
    df.orderBy(*order).select(F.col(line).alias("value")).write.mode("overwrite").text(path)
