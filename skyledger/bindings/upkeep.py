"""Queries of tables that are kept up run by run: cursor, merge, partial rebuilds, layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.bindings import domain
from skyledger.bindings.catalogue import FILTER, Tables, query
from skyledger.operators.filters import global_filter
from skyledger.operators.topk import keep_top
from skyledger.plans import gallery, gold, history, job, silver, status
from skyledger.session import new_workspace
from skyledger.sources import schemas, sinks, tables
from skyledger.streaming import cursor
from skyledger.streaming.upsert import accumulate_runs, staged

#: Pages of the cursor query's runs, and which run resets the cursor.
PAGES_A_RUN, RUNS, RESET_RUN = 30, 5, 5


@query
def landing_cursor(spark, sf_dir):
    """Launches in pages of a month, taken in five runs of thirty pages: the third comes to
    the end, the fourth starts over, the fifth resets the cursor."""
    base = new_workspace(spark, "paged")
    pages = domain.raw_launches(spark, sf_dir, page="date_format(o_orderdate, \"'p'yyyy-MM\")")
    sinks.write_json_lines(pages.hint("rebalance", F.col("page")), f"{base}/landing", partition_by=["page"])
    for run in range(1, RUNS + 1):
        cursor.take_pages(
            spark,
            f"{base}/landing",
            schemas.LAUNCH,
            f"{base}/runs",
            f"{base}/log",
            f"run{run}",
            budget=PAGES_A_RUN,
            reset=run == RESET_RUN,
            transform=lambda rows: rows.select("id", "page"),
        )
    taken = cursor.taken_rows(spark, f"{base}/runs", f"{base}/log", "id STRING")
    return taken.groupBy("run_id", "page").agg(F.count("id").alias("launches"))


@query
def accumulated_silver(spark, sf_dir):
    """All landing runs merged into one table by the year of the newest run of a launch: a
    launch that lands again in January moves to the next partition."""
    base = new_workspace(spark, "accumulated")
    records = domain.run_records(spark, sf_dir)
    year = F.substring("run_id", 1, 4).cast("int")
    landed = records.withColumn("landed", year)
    sinks.write_json_lines(landed.hint("rebalance", F.col("landed")), f"{base}/landing", partition_by=["landed"])
    accumulate_runs(
        spark,
        f"{base}/landing/*",
        "run_id STRING, launch_id STRING, launch_name STRING, status STRING",
        f"{base}/silver",
        f"{base}/checkpoint",
        "launch_id",
        "run_year",
        bytes_per_batch=4 << 20,
        transform=lambda rows: rows.withColumn("run_year", year),
    )
    return tables.read_table(spark, f"{base}/silver")


def written_silver(spark: SparkSession, sf_dir: str, label: str, *names: str) -> str:
    """A folder with the Silver tables asked for, partitioned as the job has them."""
    base, t = new_workspace(spark, label), Tables(spark, sf_dir)
    for name in names:
        sinks.write_parquet(getattr(t, name), f"{base}/{name}", job.PARTITIONS[name])
    return base


@query
def gold_after_update(spark, sf_dir):
    """Gold metrics after every launch of the newest year has come in again as a success:
    only that year's partitions of Silver and Gold are written anew."""
    silver_base = written_silver(spark, sf_dir, "updated", "launches", "weather", "images")
    gold_base = f"{silver_base}/gold"
    job.run_gold(spark, silver_base, gold_base)
    newest = F.year(domain.table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).scalar())
    again = silver.silver_launches(domain.raw_launches(spark, sf_dir)).where(F.col("launch_year") == newest)
    years = staged(again.select("launch_year").distinct(), "updated-years")
    sinks.replace_partitions(again.withColumn("is_success", F.lit(1)), f"{silver_base}/launches", "launch_year", years)
    job.update_gold(spark, silver_base, gold_base, years)
    return tables.load_metrics(tables.read_table(spark, f"{gold_base}/company_year_metrics"))


@query
def pruned_filter(spark, sf_dir):
    """The filter bar over written Silver: folders of other years are not read."""
    base = written_silver(spark, sf_dir, "filtered", "launches")
    chosen = global_filter(job.read_silver(spark, base, "launches"), **FILTER)
    return chosen.select("launch_id", "launch_year", "provider_name", "mission_orbit")


@query
def pruned_season(spark, sf_dir):
    """Launches a month over written Silver, for the years of another table."""
    base = written_silver(spark, sf_dir, "seasons", "launches")
    metrics = global_filter(Tables(spark, sf_dir).metrics, **FILTER)
    return history.season_heatmap(job.read_silver(spark, base, "launches"), metrics)


def busiest_years(launches: DataFrame, metrics: DataFrame, n: int) -> DataFrame:
    """Launches of the ``n`` years with the most launches in ``metrics``. The years are
    found first; only their folders are read."""
    yearly = metrics.groupBy("launch_year").agg(F.sum("total_launches").alias("total"))
    top = keep_top(yearly, n, "launch_year", F.max("total")).where("total > 0").select("launch_year")
    return launches.join(F.broadcast(top), "launch_year")


@query
def pruned_busiest_years(spark, sf_dir):
    """Launches a provider in the two busiest years of Gold, over written Silver."""
    base = written_silver(spark, sf_dir, "busiest", "launches")
    chosen = busiest_years(job.read_silver(spark, base, "launches"), Tables(spark, sf_dir).metrics, 2)
    return chosen.groupBy("launch_year", "provider_name").agg(F.count("launch_id").alias("launches"))


#: Buckets of the joined tables: one for so many bytes of the tables they are made from, which
#: a task can sort in memory, between a least number and the most that Spark allows.
BUCKET_BYTES, BUCKETS, MOST_BUCKETS = 16 << 20, 16, 100_000


def buckets_of(spark: SparkSession, sf_dir: str) -> int:
    stored = sinks.stored_bytes(spark, *(f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem", "events")))
    return min(max(-(-stored // BUCKET_BYTES), BUCKETS), MOST_BUCKETS)


@query
def bucketed_features(spark, sf_dir):
    """Gold features from tables that lie in buckets by launch and are joined in place."""
    base, t = new_workspace(spark, "bucketed"), Tables(spark, sf_dir)
    name, buckets = base.rsplit("-", 1)[-1], buckets_of(spark, sf_dir)
    placed = {
        kind: sinks.write_bucketed(getattr(t, kind), f"{kind}_{name}", f"{base}/{kind}", "launch_id", buckets)
        for kind in ("launches", "weather", "images")
    }
    return gold.launch_features(**placed)


@query
def written_status(spark, sf_dir):
    """Partitions, rows and dated rows of written Silver tables, from their footers."""
    base = written_silver(spark, sf_dir, "status", "launches", "weather", "images")
    return status.written_status(
        spark,
        {
            "launches": (f"{base}/launches", ["launch_year"], "launch_date"),
            "weather": (f"{base}/weather", ["weather_year"], "weather_date"),
            "images": (f"{base}/images", ["source", "launch_year"], "launch_date"),
        },
    )


#: A page far down the gallery.
DEEP_PAGE = 1_200


@query
def gallery_deep_page(spark, sf_dir):
    """A page far down the gallery, from images that were written in the order of pages."""
    path = new_workspace(spark, "pages")
    gallery.write_pages(tables.load_images(Tables(spark, sf_dir).images), path)
    return gallery.written_page(spark, path, DEEP_PAGE)


@query
def quarantined_scan(spark, sf_dir):
    """Launch costs by year from a table with a broken part file, and what was left out."""
    path = new_workspace(spark, "broken")
    sinks.write_parquet(Tables(spark, sf_dir).priced, path, ["launch_year"])
    sinks.write_bytes(spark, f"{path}/launch_year=1995/part-broken.parquet", b"PAR1 cut off in the middle")
    rows = tables.read_table(spark, path, Tables(spark, sf_dir).priced.schema, skip_corrupt=True)
    read = tables.typed_year(rows).groupBy(F.lit("read").alias("outcome"), F.col("launch_year").cast("string").alias("part")).agg(
        F.count("*").alias("rows")
    )
    left_out = tables.quarantine(spark, path).select(
        F.lit("left out").alias("outcome"), F.col("file").alias("part"), F.lit(0).cast("bigint").alias("rows")
    )
    return read.unionByName(left_out)
