"""Reading Silver and Gold tables, and typing what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Scan a Parquet folder; partition columns are discovered from its paths.

    A declared schema saves reading footers, and lets a table without a single
    row, hence without files, be read. ``skip_corrupt`` leaves out files that
    cannot be read.
    """
    reader = spark.read.option("ignoreCorruptFiles", skip_corrupt)
    return (reader.schema(schema) if schema else reader).parquet(path)


#: Parquet files without rows are smaller than this.
_ROWLESS_BYTES = 1 << 20


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, error) of the Parquet files under ``path`` that cannot be read.

    The files are listed, and those of which a tolerant scan reads no row are looked at:
    a file that ends as Parquet files do has no rows and is fine, and so is one without a
    byte, which scans pass over. The scan takes row counts from footers and reads no column.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    listed = files.load(path)
    name = lambda c: F.regexp_extract(c, "[^/]+$", 0)
    # without a declared schema some file would be asked for one, perhaps a broken one
    rows = spark.read.schema("_none BOOLEAN").option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
    readable = rows.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct()
    place = lambda c: F.regexp_replace(c, "^[a-z]+:/*", "/")
    silent = listed.select("path", "length", place("path").alias("_place")).join(
        readable.select(place("file").alias("_place")), "_place", "left_anti"
    )
    ends = listed.where(F.col("length") < _ROWLESS_BYTES).select("path", (F.expr("right(hex(content), 8)") == "50415231").alias("ends"))
    return (
        silent.join(ends, "path", "left")
        .where(~F.coalesce("ends", F.lit(False)))
        .select(name("path").alias("file"), "length", F.lit("no Parquet footer").alias("error"))
    )


def number(column: str, kind: str) -> Column:
    """A number from whatever the column holds; null where it is none. Texts like
    ``3.0`` are whole numbers too; one with a real fraction is no integer."""
    value = F.col(column)
    if kind == "double":
        return value.try_cast(kind)
    loose = value.try_cast("double")
    return F.coalesce(value.try_cast(kind), F.when(loose == F.floor(loose), loose.try_cast(kind)))


def typed(df: DataFrame, numbers: dict[str, str], **texts: Column) -> DataFrame:
    """Numbers from whatever the table holds, null where it is none, and cleaned
    texts; rows whose ``launch_year`` is no number are dropped, a fraction of a year
    is cut off."""
    year = F.coalesce(F.col("launch_year").try_cast("int"), F.col("launch_year").try_cast("double").try_cast("int"))
    typed_numbers = {c: number(c, t) for c, t in numbers.items()}
    return df.withColumns({"launch_year": year, **typed_numbers, **texts}).where(F.col("launch_year").isNotNull())


def typed_year(df: DataFrame) -> DataFrame:
    """``launch_year`` as an integer; rows where it is none are dropped."""
    return typed(df, {})


def load_metrics(df: DataFrame) -> DataFrame:
    numbers = {
        "total_launches": "bigint",
        "successful_launches": "bigint",
        "success_rate_pct": "double",
    }
    return typed(df, numbers, provider_name=F.trim("provider_name"))


def load_features(df: DataFrame) -> DataFrame:
    numbers = {
        "is_success": "int",
        "temperature_2m_mean": "double",
        "wind_speed_10m_max": "double",
        "launch_image_count": "bigint",
    }
    return typed(df, numbers, pad_country_code=F.upper(F.trim("pad_country_code")))


def load_costs(df: DataFrame) -> DataFrame:
    numbers = {"estimated_cost_usd": "bigint", "cost_per_kg_leo_usd": "bigint", "is_success": "int"}
    return typed(df, numbers)


def load_images(df: DataFrame) -> DataFrame:
    return typed_year(df)
