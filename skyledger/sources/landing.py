"""Reading RAW landings: ``<base>/<run id>/<dataset file>``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources import schemas

#: The run id is the folder that holds the file; part files of a Spark-written
#: dataset lie one level deeper.
RUN_ID_PATTERN = r"/([^/]+)/[^/]+\.jsonl?(?:/[^/]+)?$"


def read_json(spark: SparkSession, path: str, schema: str, *, strict: bool = False) -> DataFrame:
    """Scan JSON lines with a declared schema; a path that does not exist is empty.

    A line that is no JSON object becomes a row of nulls, or with ``strict`` no row at
    all. A record stays, whatever types its fields have: what does not fit is null.
    """
    try:
        if not strict:
            return spark.read.schema(schema).json(path)
        lines = spark.read.text(path)
    except AnalysisException as error:
        return _nothing(spark, schema, error)
    kind = F.schema_of_variant(F.try_parse_json("value"))
    record = f"STRUCT<{' '.join(schema.split())}>"
    records = lines.where(F.startswith(kind, F.lit("OBJECT"))).select(F.from_json("value", record).alias("record"))
    return records.select("record.*")


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan JSON arrays that extend over any number of lines, one to a file, or JSON lines.

    Which of them a dataset holds is told by its first character. An array is parsed as a
    stream, by one task a file, and gives a row for each element; elements and lines that
    are no objects give none.
    """
    try:
        first = spark.read.text(path).where(F.trim("value") != "").first()
    except AnalysisException as error:
        return _nothing(spark, schema, error)
    if first is None:
        return spark.createDataFrame([], schema)
    if not first["value"].lstrip().startswith("["):
        return read_json(spark, path, schema, strict=True)
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)


def _nothing(spark: SparkSession, schema: str, error: AnalysisException) -> DataFrame:
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error
    return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, base: str, file_name: str, schema: str) -> DataFrame:
    """One dataset of all runs, with the ``run_id`` of each row."""
    try:
        rows = spark.read.schema(schema).json(f"{base}/*/{file_name}")
    except AnalysisException as error:
        return _nothing(spark, schema, error).withColumn("run_id", F.lit(None).cast("string"))
    run = F.regexp_extract("_metadata.file_path", RUN_ID_PATTERN, 1)
    return rows.select("*", run.alias("run_id"))


def run_ids(spark: SparkSession, base: str) -> list[str]:
    """Names of the run folders under ``base``, newest first. Lists that one folder; how
    many runs are kept does not grow with their rows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(path) if files.exists(path) else []
    return sorted((f.getPath().getName() for f in found if f.isDirectory()), reverse=True)


def newest_run_id(spark: SparkSession, base: str) -> str:
    """The largest run folder name."""
    runs = run_ids(spark, base)
    if not runs:
        raise FileNotFoundError(f"no RAW run under {base}")
    return runs[0]


def read_launches(spark: SparkSession, path: str, *, strict: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.LAUNCH_WIDE if strict else schemas.LAUNCH, strict=strict)


def read_rockets(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, schemas.ROCKET)
