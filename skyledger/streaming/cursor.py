"""Landing by runs of a page budget, with a cursor that is saved, wraps and can be reset.

Pages are folders ``page=<name>`` of JSON lines; their names order them. A run takes the
pages after the cursor, at most as many as its budget, and then moves the cursor; after
the last page it starts over. What a run took lies under its own ``run_id=`` folder, and
the log has one entry for each run, written last: a run that was broken off leaves no
entry, and when it is repeated it takes the same pages and replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: An entry of the log: the pages of the run, and the last page before the next run's
#: (missing: the next run starts at the first page).
LOG = "run_id STRING, number BIGINT, first_page STRING, last_page STRING, pages BIGINT, cursor STRING"


def page_names(spark: SparkSession, source: str) -> DataFrame:
    """``page`` of every page that has files. Lists them without reading any."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "page STRING")
    name = F.regexp_extract("path", "/page=([^/]+)/[^/]+$", 1)
    return files.select(name.alias("page")).where("page <> ''").distinct()


def run_log(spark: SparkSession, state: str) -> DataFrame:
    """All runs that have ended."""
    try:
        return spark.read.schema(LOG).json(f"{state}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def _next_pages(spark: SparkSession, source: str, cursor: str | None, budget: int) -> Row:
    """The first and last page of the next run, their number, and the last page of all."""
    pages = page_names(spark, source)
    end = pages.agg(F.max("page")).scalar()
    ahead = pages if cursor is None else pages.where(F.col("page") > cursor)
    chosen = ahead.orderBy("page").limit(budget) if budget > 0 else ahead
    return chosen.agg(
        F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count("*").alias("pages"), end.alias("end")
    ).first()


def take_pages(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    state: str,
    run_id: str,
    *,
    budget: int = 0,
    reset: bool = False,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> Row:
    """Take the pages of one run and return its entry in the log.

    A ``budget`` of 0 is none. ``reset`` starts at the first page, whatever the cursor
    says. A run that is in the log already is not taken again. ``transform`` works on the
    rows of the pages, which have a column ``page``, and has to keep it. The driver sees
    names of pages only.
    """
    log = run_log(spark, state)
    done = log.where(F.col("run_id") == run_id).first()
    if done:
        return done
    last = log.orderBy(F.desc("number")).first()
    found = _next_pages(spark, source, None if reset or last is None else last["cursor"], budget)
    if found["pages"]:
        rows = spark.read.schema(f"{schema}, page STRING").json(source)
        rows = rows.where(F.col("page").between(found["first_page"], found["last_page"]))
        rows = transform(rows) if transform else rows
        rows.write.mode("overwrite").partitionBy("page").parquet(f"{target}/run_id={run_id}")
    at_end = found["last_page"] == found["end"]
    entry = {
        "run_id": run_id,
        "number": last["number"] + 1 if last else 1,
        "first_page": found["first_page"],
        "last_page": found["last_page"],
        "pages": found["pages"],
        "cursor": None if at_end else found["last_page"],
    }
    saved = spark.createDataFrame([tuple(entry.values())], LOG)
    saved.coalesce(1).write.mode("overwrite").json(f"{state}/{run_id}")
    return Row(**entry)


def taken_rows(spark: SparkSession, target: str, state: str, schema: str) -> DataFrame:
    """The rows of all runs in the log, with ``run_id`` and ``page``. ``schema`` is that of
    the rows. Folders of runs that were broken off are not read."""
    rows = spark.read.schema(f"{schema}, run_id STRING, page STRING").parquet(target)
    return rows.join(run_log(spark, state).select("run_id"), "run_id", "left_semi")
