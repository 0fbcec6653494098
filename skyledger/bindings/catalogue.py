"""The query catalogue: each entry is ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import constants as K
from skyledger.bindings import domain
from skyledger.functions.hashing import stable_int
from skyledger.functions.missions import mission_profile
from skyledger.operators.filters import global_filter
from skyledger.operators.latest import latest_run, newest_per_key
from skyledger.operators.shaping import conform
from skyledger.plans import (
    context,
    costs,
    explorer,
    gallery,
    geography,
    gold,
    history,
    job,
    launch_frame,
    missions,
    overview,
    providers,
    rockets,
    silver,
    status,
    synthetic,
    weather,
)
from skyledger.session import new_workspace
from skyledger.sources import landing, schemas, sinks, tables
from skyledger.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}

# parameters of the filtering queries, also used by the SQL twins
FILTER = {
    "first_year": 1996,
    "last_year": 1999,
    "providers": ["NATION_1", "NATION_2", "NATION_3", "NATION_12", "NATION_20"],
    "orbits": ["MACHINERY", "BUILDING"],
}
SEARCH = {"source": K.CATALOGUE_SOURCE, "year": 1997, "pattern": r"falcon [1-4] \(\d*7\)"}
PAGE = 2
#: Where reading on starts, in the order of the pages.
AFTER_CARD = (1997, K.CATALOGUE_SOURCE, "2", "", "")


def named(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        CATALOGUE[name] = build
        return build

    return register


def query(build: Query) -> Query:
    return named(build.__name__)(build)


def steady(df: DataFrame, *columns: str) -> DataFrame:
    """Round double means to six decimals: their last bits depend on sum order."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


class Tables:
    """The domain's tables over one data folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return getattr(domain, name)(self.spark, self.sf_dir)

    @property
    def launches(self) -> DataFrame:
        return silver.silver_launches(self.raw("raw_launches"))

    @property
    def weather(self) -> DataFrame:
        return silver.silver_weather(self.raw("raw_weather"))

    @property
    def rockets(self) -> DataFrame:
        return silver.silver_rockets(self.raw("raw_rockets"))

    @property
    def images(self) -> DataFrame:
        return silver.silver_images(self.raw("raw_catalogue_images"), self.raw("raw_vendor_images"))

    @property
    def priced(self) -> DataFrame:
        return silver.silver_launch_costs(self.launches, domain.BRAND_COSTS)

    @property
    def costs(self) -> DataFrame:
        return tables.load_costs(self.priced)

    @property
    def gold_metrics(self) -> DataFrame:
        return gold.company_year_metrics(self.launches)

    @property
    def metrics(self) -> DataFrame:
        return tables.load_metrics(self.gold_metrics)

    @property
    def gold_features(self) -> DataFrame:
        return gold.launch_features(self.launches, self.weather, self.images)

    @property
    def features(self) -> DataFrame:
        return tables.load_features(self.gold_features)

    @property
    def frame(self) -> DataFrame:
        """The launch frame with a year: what launch-only marts read. It needs no
        join to weather or images."""
        wide = conform_wide(self.raw("landed_launches"))
        return tables.typed_year(launch_frame.launch_frame(wide))


def conform_wide(landed: DataFrame) -> DataFrame:
    return conform(landed, T.StructType.fromDDL(schemas.LAUNCH_WIDE))


def over(name: str, build: Callable[[Tables], DataFrame]) -> None:
    CATALOGUE[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))


# --- Silver -----------------------------------------------------------------------
over("silver_launches", lambda t: t.launches)
over("silver_weather", lambda t: t.weather)
over("silver_rockets", lambda t: t.rockets)
over("silver_images", lambda t: t.images)
over("silver_launch_costs", lambda t: t.priced)

# --- Gold -------------------------------------------------------------------------
over("gold_company_year_metrics", lambda t: t.gold_metrics)
over("image_counts", lambda t: gold.image_counts(t.images))
over("gold_launch_features", lambda t: t.gold_features)


# --- Loaders and RAW shaping --------------------------------------------------------
@query
def load_metrics(spark, sf_dir):
    """Metrics as loosely typed text: padded names, one year that is no number."""
    year = F.col("launch_year").cast("string")
    dirty = Tables(spark, sf_dir).gold_metrics.select(
        F.when(F.col("launch_year") == 1998, F.concat(year, F.lit("x")))
        .when(F.col("launch_year") % 2 == 0, F.concat(year, F.lit(".0")))
        .otherwise(year).alias("launch_year"),
        F.concat(F.lit("  "), "provider_name", F.lit(" ")).alias("provider_name"),
        F.col("total_launches").cast("double").cast("string").alias("total_launches"),
        F.when(F.col("successful_launches") % 2 == 0, "many")
        .otherwise(F.col("successful_launches").cast("string")).alias("successful_launches"),
        "success_rate_pct",
    )
    return tables.load_metrics(dirty)


@query
def load_features(spark, sf_dir):
    """Features with padded lower-case countries and numbers held as text."""
    dirty = Tables(spark, sf_dir).gold_features.withColumns(
        {
            "pad_country_code": F.concat(F.lit(" "), F.lower("pad_country_code"), F.lit(" ")),
            "launch_year": F.col("launch_year").cast("double").cast("string"),
            "is_success": F.concat(F.col("is_success").cast("string"), F.lit(".0")),
            "launch_image_count": F.col("launch_image_count").cast("double").cast("string"),
        }
    )
    return tables.load_features(dirty).select(
        "launch_id",
        "launch_year",
        "pad_country_code",
        "is_success",
        "temperature_2m_mean",
        "wind_speed_10m_max",
        "launch_image_count",
    )


@query
def load_costs(spark, sf_dir):
    cost = F.col("estimated_cost_usd")
    dirty = Tables(spark, sf_dir).priced.withColumn(
        "estimated_cost_usd",
        F.when(cost == K.DEFAULT_COST_USD, "n/a").otherwise(F.concat(cost.cast("string"), F.lit(".0"))),
    )
    return tables.load_costs(dirty)


over("raw_flatten", lambda t: launch_frame.launch_frame(conform_wide(t.raw("landed_launches"))))
over(
    "images_from_raw",
    lambda t: launch_frame.images_from_raw(t.raw("raw_catalogue_images"), t.raw("raw_vendor_images")),
)


@query
def enrich_raw_features(spark, sf_dir):
    """The launch frame with Gold measures, which are written before they are joined."""
    t = Tables(spark, sf_dir)
    measures = t.gold_features.select(
        "launch_id", "temperature_2m_mean", "wind_speed_10m_max", "launch_image_count"
    )
    path = new_workspace(spark, "measures")
    sinks.write_parquet(measures, path)
    joined = launch_frame.with_gold_measures(t.frame, tables.read_table(spark, path, measures.schema))
    return joined.select(
        "launch_id", "mission_orbit", "is_success", "temperature_2m_mean",
        "wind_speed_10m_max", "launch_image_count",
    )


@query
def compact_launches(spark, sf_dir):
    """Compaction of the landed records, shown as leaf columns."""
    compact = launch_frame.compact_launches(domain.landed_launches(spark, sf_dir))
    leaves = {name: path for name, (path, _) in schemas.SILVER_LAUNCH_COLUMNS.items()}
    empty_mission = F.col("mission").isNull()
    return compact.select(
        *[F.col(path).alias(name) for name, path in leaves.items()],
        "image",
        "infographic",
        empty_mission.cast("int").alias("missing_mission"),
    )


over("compact_images", lambda t: launch_frame.compact_images(t.raw("raw_launches")))


@query
def extract_launch_images(spark, sf_dir):
    found = launch_frame.extract_launch_images(domain.vendor_launches(spark, sf_dir))
    return found.select(
        F.col("spacex_launch_id").alias("launch_id"), F.posexplode("image_urls").alias("pos", "url")
    )


@query
def weather_targets(spark, sf_dir):
    sites = launch_frame.launch_sites(
        domain.vendor_launches(spark, sf_dir), domain.launchpads(spark, sf_dir)
    )
    return launch_frame.weather_targets(sites).withColumnsRenamed(
        {"latitude": "lat", "longitude": "lon"}
    )


@query
def weather_targets_budget(spark, sf_dir):
    """The first fifty places and dates to sample, where some launches state a month or
    a time only."""
    order = F.col("id").cast("bigint")
    sites = launch_frame.launch_sites(
        domain.vendor_launches(spark, sf_dir), domain.launchpads(spark, sf_dir)
    ).withColumn(
        "net",
        F.when(order % 3 == 0, F.substring("net", 1, 7)).when(order % 3 == 1, F.lit("10:00")).otherwise(F.col("net")),
    )
    return launch_frame.weather_targets(sites, max_samples=50).withColumnsRenamed(
        {"latitude": "lat", "longitude": "lon"}
    )


@query
def tolerant_scan(spark, sf_dir):
    """Launches landed as JSON lines of which some are cut off, blank, no object, or have
    fields of other types."""
    path = new_workspace(spark, "tolerant")
    order = F.col("id").cast("bigint")
    whole = F.to_json(F.struct("id", "name", "net", "status"))
    retyped = F.to_json(
        F.struct("id", "name", "net", F.lit("soon").alias("status"), F.array("id").alias("image"))
    )
    line = (
        F.when(order % 6 == 0, F.substring(whole, 1, 20))
        .when(order % 6 == 1, F.concat(whole, F.lit("\n\n   ")))
        .when(order % 6 == 2, retyped)
        .when(order % 6 == 3, F.lit("[1, 2]"))
        .otherwise(whole)
    )
    domain.raw_launches(spark, sf_dir).select(line.alias("value")).write.text(path)
    return landing.read_launches(spark, path, strict=True).select(
        "id", "name", "net", F.col("status.name").alias("status_name"), "image"
    )


@query
def gallery_images(spark, sf_dir):
    """Images of the gallery before Silver has any: they come from the landed records."""
    t = Tables(spark, sf_dir)
    raw = launch_frame.images_from_raw(t.raw("raw_catalogue_images"), t.raw("raw_vendor_images"))
    nothing_yet = spark.createDataFrame([], t.images.schema)
    chosen = launch_frame.choose_images(tables.load_images(nothing_yet), raw)
    return chosen.select("source", "launch_name", "launch_year", "image_url")


@query
def gallery_silver_images(spark, sf_dir):
    """Images of the gallery once Silver has them: repeats within a record are gone."""
    t = Tables(spark, sf_dir)
    raw = launch_frame.images_from_raw(t.raw("raw_catalogue_images"), t.raw("raw_vendor_images"))
    chosen = launch_frame.choose_images(tables.load_images(t.images), raw)
    return chosen.select("source", "launch_name", "launch_year", "image_url")


over("latest_run_snapshot", lambda t: latest_run(t.raw("run_records")))
over("runs_dedup_latest", lambda t: newest_per_key(t.raw("run_records"), "launch_id"))


@query
def run_manifest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return status.run_manifest(
        {
            K.LAUNCHES_FILE: t.raw("raw_launches"),
            K.CATALOGUE_IMAGES_FILE: launch_frame.compact_images(t.raw("raw_launches")),
            K.ROCKETS_FILE: t.raw("raw_rockets"),
            K.PAYLOADS_FILE: domain.table(spark, sf_dir, "part"),
            K.CORES_FILE: domain.table(spark, sf_dir, "customer"),
            K.SHIPS_FILE: domain.table(spark, sf_dir, "supplier"),
            K.VENDOR_IMAGES_FILE: launch_frame.extract_launch_images(t.raw("vendor_launches")),
            K.WEATHER_FILE: t.raw("raw_weather"),
        }
    )


over(
    "data_status",
    lambda t: status.data_status(t.raw("landed_records"), ["launches", "images", "catalogue_images", "weather"]),
)


@query
def table_partitions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return status.table_partitions(
        {
            "launches": (t.launches, "launch_year"),
            "images": (t.images, "source"),
            "weather": (t.weather, "weather_year"),
            "company_year_metrics": (t.gold_metrics, "launch_year"),
            "launch_features": (t.gold_features, "launch_year"),
        }
    )


@query
def parquet_roundtrip(spark, sf_dir):
    """Silver costs written as a partitioned table and read back, partitions as ints."""
    path = new_workspace(spark, "costs")
    sinks.write_parquet(Tables(spark, sf_dir).priced, path, ["launch_year"])
    return tables.typed_year(tables.read_table(spark, path))


@query
def json_roundtrip(spark, sf_dir):
    """RAW launches written as JSON lines, read back and normalised."""
    path = new_workspace(spark, "launches")
    sinks.write_json_lines(domain.raw_launches(spark, sf_dir), path)
    return silver.silver_launches(landing.read_launches(spark, path))


@query
def rockets_roundtrip(spark, sf_dir):
    """RAW rockets written as one array over many lines, read back and normalised."""
    path = new_workspace(spark, "rockets")
    sinks.write_json_array(domain.raw_rockets(spark, sf_dir), path)
    return silver.silver_rockets(landing.read_rockets(spark, path))


def landed_run(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Write one RAW run: the five datasets the batch job reads, and the three it keeps."""
    datasets = {
        K.LAUNCHES_FILE: domain.raw_launches,
        K.WEATHER_FILE: domain.raw_weather,
        K.ROCKETS_FILE: domain.raw_rockets,
        K.CATALOGUE_IMAGES_FILE: domain.raw_catalogue_images,
        K.VENDOR_IMAGES_FILE: domain.raw_vendor_images,
    }
    built = {name: build(spark, sf_dir) for name, build in datasets.items()}
    for name, source in ((K.PAYLOADS_FILE, "part"), (K.CORES_FILE, "customer"), (K.SHIPS_FILE, "supplier")):
        built[name] = domain.table(spark, sf_dir, source)
    return status.land_run(spark, base, built, {"launch_library_synthetic_mode": False})


@query
def medallion_job(spark, sf_dir):
    """The whole batch job from landed JSON to the Gold feature table."""
    base = new_workspace(spark, "job")
    landed_run(spark, sf_dir, f"{base}/raw")
    job.run_job(spark, f"{base}/raw", f"{base}/silver", f"{base}/gold")
    return tables.load_features(tables.read_table(spark, f"{base}/gold/launch_features")).select(
        "launch_id", "launch_date", "launch_year", "provider_name", "is_success",
        "temperature_2m_mean", "wind_speed_10m_max", "launch_image_count",
    )


@query
def landed_manifest(spark, sf_dir):
    """Row counts as the manifest of a landed run states them."""
    base = new_workspace(spark, "landed")
    run = landed_run(spark, sf_dir, base)
    manifest = spark.read.schema("files MAP<STRING, BIGINT>").json(f"{base}/{run}/{K.MANIFEST_FILE}")
    return manifest.select(F.explode("files").alias("dataset", "rows"))


@query
def landed_status(spark, sf_dir):
    """Lines of each dataset in the newest five run folders; each run lands the launches of
    one year of orders, every second one the rockets too."""
    base = new_workspace(spark, "runs")
    orders = domain.table(spark, sf_dir, "orders")
    bounds = orders.agg(F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")).first()
    launches = domain.raw_launches(spark, sf_dir, year="year(o_orderdate)")
    for year in range(bounds["first"], bounds["last"] + 1):
        run = {K.LAUNCHES_FILE: launches.where(F.col("year") == str(year)).drop("year")}
        if year % 2:
            run[K.ROCKETS_FILE] = domain.raw_rockets(spark, sf_dir)
        status.land_run(spark, base, run, {"year": year}, run_id=str(year))
    return status.landed_status(spark, base, [K.LAUNCHES_FILE, K.ROCKETS_FILE])


@query
def incremental_landing(spark, sf_dir):
    """Landed JSON files taken in by a stream, a bounded number of bytes at a time, as
    Silver rows."""
    base = new_workspace(spark, "stream")
    sinks.write_json_lines(domain.raw_launches(spark, sf_dir), f"{base}/landing")
    land_new_files(
        spark,
        f"{base}/landing",
        schemas.LAUNCH,
        f"{base}/silver",
        f"{base}/cursor",
        bytes_per_batch=32 << 20,
        transform=silver.silver_launches,
    )
    return tables.read_table(spark, f"{base}/silver").select(
        "launch_id", "launch_year", "provider_name", "rocket_name", "is_success"
    )


# --- Derived values -----------------------------------------------------------------
@named("mission_profile")
def _(spark, sf_dir):
    names = domain.run_records(spark, sf_dir).where(F.col("launch_name").isNotNull())
    variant = (F.length("launch_name") % 7).cast("int")
    profile = mission_profile(F.col("launch_name"), variant)
    return names.select(
        F.col("launch_name").alias("name"),
        variant.alias("variant"),
        profile["type"].alias("type"),
        profile["orbit"].alias("orbit"),
    )


@named("stable_int")
def _(spark, sf_dir):
    key = F.concat(F.lit("pad:"), F.col("o_orderkey").cast("string"))
    return domain.table(spark, sf_dir, "orders").select(
        key.alias("key"), stable_int(key, 2_000, 800_000).alias("value")
    )


@query
def synthetic_expand(spark, sf_dir):
    """Real launches and synthetic ones: every seed varied twice, one seed three times."""
    orders = domain.table(spark, sf_dir, "orders").count()
    expanded = synthetic.synthetic_expand(
        domain.raw_launches(spark, sf_dir),
        domain.vendor_launches(spark, sf_dir),
        domain.launchpads(spark, sf_dir),
        domain.raw_rockets(spark, sf_dir),
        target=3 * orders + 1,
    )
    return silver.silver_launches(expanded)


over(
    "launch_probability",
    lambda t: rockets.launch_probability(t.gold_features, t.rockets),
)

# --- Filters and headline numbers -----------------------------------------------------
over(
    "global_filter",
    lambda t: global_filter(t.frame, **FILTER).select(
        "launch_id", "launch_year", "provider_name", "mission_orbit"
    ),
)
over("filter_options", lambda t: overview.filter_options(t.metrics, t.frame, t.images))
over(
    "kpi_summary",
    lambda t: steady(
        overview.kpi_summary(t.metrics, t.features), "mean_temperature", "mean_wind"
    ),
)
over("hero_summary", lambda t: overview.hero_summary(t.metrics))
over(
    "filtered_kpi",
    lambda t: steady(
        overview.kpi_summary(global_filter(t.metrics, **FILTER), global_filter(t.features, **FILTER)),
        "mean_temperature",
        "mean_wind",
    ),
)
over(
    "filtered_hero",
    lambda t: overview.hero_summary(global_filter(t.metrics, **FILTER), FILTER["first_year"], FILTER["last_year"]),
)

# --- History ---------------------------------------------------------------------------
over("yearly_activity", lambda t: steady(history.yearly_activity(t.metrics), "rolling"))
over("top_provider_trend", lambda t: history.top_provider_trend(t.metrics))
over("season_heatmap", lambda t: history.season_heatmap(t.launches, t.metrics))
over(
    "season_heatmap_filtered",
    lambda t: history.season_heatmap(t.launches, global_filter(t.metrics, **FILTER)),
)

# --- Providers ---------------------------------------------------------------------------
over("provider_stats", lambda t: providers.provider_stats(t.metrics))
over("provider_top12", lambda t: providers.provider_top12(t.metrics))
over("provider_rate_top10", lambda t: providers.provider_rate_top10(t.metrics))
over("provider_rate_trend", lambda t: providers.provider_rate_trend(t.metrics))
over("market_share", lambda t: steady(providers.market_share(t.metrics), "share"))
over("provider_table_top15", lambda t: providers.provider_table(t.metrics))
over("race_cumulative", lambda t: providers.race_cumulative(t.metrics))

# --- Missions ----------------------------------------------------------------------------
over("mission_type_counts", lambda t: steady(missions.mission_type_counts(t.frame), "share"))
over("orbit_counts", lambda t: steady(missions.orbit_counts(t.frame), "share"))
over("orbit_by_year", lambda t: missions.orbit_by_year(t.frame))
over("mission_success", lambda t: missions.mission_success(t.frame))

# --- Geography ---------------------------------------------------------------------------
over("pad_stats", lambda t: steady(geography.pad_stats(t.frame), "dot_size"))
over("country_top12", lambda t: geography.country_top12(t.frame))
over("country_success", lambda t: geography.country_success(t.frame))
over("country_by_year", lambda t: geography.country_by_year(t.frame))

# --- Rockets -----------------------------------------------------------------------------
over("rocket_chart_values", lambda t: steady(rockets.rocket_chart_values(t.rockets), "mass_t", "cost_m"))
over("rocket_radar", lambda t: steady(rockets.rocket_radar(t.rockets), "h", "m", "sr", "eco", "stage"))
over("rocket_specs", lambda t: rockets.rocket_specs(t.rockets))
over("rocket_cards", lambda t: rockets.rocket_cards(t.rockets))
over("rocket_first_image", lambda t: rockets.rocket_first_image(t.raw("raw_rockets")))

# --- Weather -----------------------------------------------------------------------------
over(
    "weather_box_stats",
    lambda t: steady(weather.weather_box_stats(t.gold_features), "q1", "median", "q3"),
)
over("weather_outliers", lambda t: weather.weather_outliers(t.gold_features))
over("weather_sample", lambda t: weather.weather_sample(t.gold_features))
over("temp_histogram", lambda t: steady(weather.temp_histogram(t.gold_features), "bin_start"))
over("weather_by_year", lambda t: steady(weather.weather_by_year(t.gold_features), "temp", "wind"))

# --- Gallery -----------------------------------------------------------------------------
over(
    "gallery_search",
    lambda t: gallery.gallery_search(tables.load_images(t.images), **SEARCH).select(
        "launch_id", "launch_name", "launch_year", "image_url"
    ),
)
over("gallery_page", lambda t: gallery.gallery_page(tables.load_images(t.images), PAGE))
over(
    "gallery_after",
    lambda t: gallery.gallery_after(tables.load_images(t.images), AFTER_CARD, shown_alike=0),
)
over(
    "gallery_pages",
    lambda t: gallery.gallery_pages(gallery.gallery_search(tables.load_images(t.images), **SEARCH)),
)

# --- Costs -------------------------------------------------------------------------------
over("cost_kpis", lambda t: costs.cost_kpis(t.costs))
over("cost_by_provider", lambda t: costs.cost_by_provider(t.costs))
over("cost_trend_top5", lambda t: costs.cost_trend_top5(t.costs))
over("cost_by_year", lambda t: costs.cost_by_year(t.costs))
over("cost_vs_success", lambda t: costs.cost_vs_success(t.costs))
over("cost_category", lambda t: steady(costs.cost_category(t.costs), "share"))
over("cost_by_mission", lambda t: costs.cost_by_mission(t.costs))

# --- Report ------------------------------------------------------------------------------
over("context_overview", lambda t: steady(context.context_overview(t.metrics), "success_pct"))
over("context_providers", lambda t: steady(context.context_providers(t.metrics), "mean_rate"))
over("context_costs", lambda t: context.context_costs(t.costs))
over("context_top_values", lambda t: context.context_top_values(t.frame))
over("context_rockets", lambda t: context.context_rockets(t.rockets))
over(
    "context_document",
    lambda t: context.context_document(t.metrics, t.costs, t.frame, t.rockets),
)

# --- Table -------------------------------------------------------------------------------
over("launch_explorer", lambda t: explorer.launch_explorer(t.features))

from skyledger.bindings import upkeep  # noqa: E402, F401  (registers its queries)
