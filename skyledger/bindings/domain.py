"""RAW-shaped launch records made from the driver's tables.

``orders`` are launches (with their customer's nation as provider and pad),
``events`` are weather samples, ``lineitem`` rows are image records, brands of
``part`` are rockets. Every row of these tables takes part. The tables hold no
nulls, so some fields are emptied by rule to exercise the null handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.constants import ROCKET_COSTS
from skyledger.operators.shaping import conform
from skyledger.sources import schemas

#: The built-in price list under the brand names of the driver's tables.
BRAND_COSTS = [(f"Brand#{i}", *row[1:]) for i, row in enumerate(ROCKET_COSTS, start=1)]

KEYWORDS = (
    "array('Starlink', 'Crew Dragon', 'CRS', 'Transporter', 'Starship', "
    "'GPS', 'Planet', 'Intelsat', 'Alpha', 'Beta')"
)
ORDER_NAME = f"concat(get({KEYWORDS}, cast(o_orderkey % 10 AS int)), ' ', o_orderkey)"
IMAGE_NAME = (
    "CASE WHEN l_linenumber <> 5 THEN concat('Falcon ', l_partkey % 9, ' (', l_suppkey, ')') END"
)


def iso(column: str) -> str:
    return f"date_format({column}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Sessions of ``build_session`` read and write times in UTC."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with segment, nation and region. Join sides are left to measured
    sizes: the customer table grows, nations and regions do not."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return orders.join(customer, F.expr("o_custkey = c_custkey")).join(
        places, F.expr("c_nationkey = n_nationkey")
    )


def landed_launches(spark: SparkSession, sf_dir: str, **also: str) -> DataFrame:
    """Launch records as a catalogue serves them, with fields nobody needs. ``also`` adds
    columns, given as SQL over ``placed_orders``."""
    picture = "concat('img/', o_orderkey)"
    return placed_orders(spark, sf_dir).selectExpr(
        "cast(o_orderkey AS string) AS id",
        f"{ORDER_NAME} AS name",
        f"CASE WHEN o_orderkey % 97 = 0 THEN 'TBD' ELSE {iso('o_orderdate')} END AS net",
        "'launch' AS type",
        "'slug' AS slug",
        f"CASE WHEN o_orderkey % 3 <> 0 THEN {picture} END AS image",
        f"""CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN {picture}
            WHEN o_orderkey % 4 = 1 THEN concat('info/', o_orderkey) END AS infographic""",
        """CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 2 = 0 THEN named_struct(
            'id', CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 4 ELSE 7 END,
            'name', concat('Status ', o_orderstatus),
            'abbrev', CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Failure'
                      ELSE 'Partial Success' END) END AS status""",
        """named_struct('id', n_nationkey, 'name', nullif(n_name, 'NATION_7'),
            'type', CASE WHEN n_nationkey % 2 = 0 THEN 'Commercial' END)
            AS launch_service_provider""",
        """named_struct('id', cast(o_custkey % 27 + 101 AS int), 'configuration', named_struct(
            'id', cast(o_custkey % 27 + 1 AS int), 'name', concat('Brand#', o_custkey % 27 + 1),
            'family', concat('Family ', (o_custkey % 27 + 1) % 5), 'variant', 'v1')) AS rocket""",
        f"""CASE WHEN o_orderpriority <> '5-LOW' OR c_mktsegment <> 'FURNITURE' THEN named_struct(
            'id', cast(o_orderkey AS int), 'name', concat({ORDER_NAME}, ' mission'),
            'type', nullif(o_orderpriority, '5-LOW'), 'orbit', named_struct(
                'name', CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE c_mktsegment END,
                'abbrev', CASE WHEN c_mktsegment = 'FURNITURE' THEN 'FURN' END)) END AS mission""",
        """named_struct('id', n_nationkey, 'name', concat('Pad ', n_nationkey),
            'country_code', r_name,
            'latitude', cast(n_nationkey * 3.5D - 40 AS string),
            'longitude', cast(n_nationkey * 7.0D - 90 AS string),
            'map_url', 'map',
            'location', CASE WHEN n_nationkey <> 3 THEN named_struct(
                'name', concat('Site ', n_name), 'country_code', r_name) END) AS pad""",
        *[f"{sql} AS {name}" for name, sql in also.items()],
    )


def raw_launches(spark: SparkSession, sf_dir: str, **also: str) -> DataFrame:
    """Launch records with the declared fields, and the text columns ``also``: what tells
    runs or pages apart travels with the record, so that nothing is joined to find it."""
    declared = T.StructType.fromDDL(schemas.LAUNCH)
    for name in also:
        declared.add(name, "string")
    return conform(landed_launches(spark, sf_dir, **also), declared)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per event; error events carry an empty series."""
    wind = "array(cast(get_json_object(props, '$.k') AS double))"
    empty = "CASE WHEN event_type = 'error' THEN cast(array() AS array<double>) ELSE"
    return table(spark, sf_dir, "events").selectExpr(
        "cast(event_id AS string) AS launch_id",
        "date_format(ts, 'yyyy-MM-dd') AS date",
        "cast(cast(user_id % 180 - 90 AS double) AS string) AS latitude",
        "cast(cast(user_id % 360 - 180 AS double) AS string) AS longitude",
        f"""named_struct('timezone', 'UTC', 'elevation', cast(user_id AS double),
            'daily', named_struct(
                'temperature_2m_mean', {empty} array(value / 10, value) END,
                'wind_speed_10m_max', {empty} {wind} END)) AS weather""",
    )


def raw_catalogue_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose flag is not N, one catalogue record each."""
    return table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").selectExpr(
        "cast(l_orderkey AS string) AS launch_library_id",
        f"{IMAGE_NAME} AS name",
        f"{iso('l_shipdate')} AS net",
        "CASE WHEN l_linenumber NOT IN (3, 7) THEN concat('img/', l_partkey) END AS image",
        """CASE WHEN l_linenumber % 2 = 0 THEN concat('img/', l_partkey)
            WHEN l_linenumber <> 7 THEN concat('info/', l_suppkey) END AS infographic""",
    )


def raw_vendor_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose flag is N, one vendor record each; lists may be null, empty
    or repeat."""
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'N'").selectExpr(
        "cast(l_orderkey AS string) AS spacex_launch_id",
        f"{IMAGE_NAME} AS name",
        f"{iso('l_shipdate')} AS date_utc",
        """CASE WHEN l_linenumber = 6 THEN cast(array() AS array<string>)
            WHEN l_linenumber = 1 THEN array(concat('pic/', l_partkey), concat('pic/', l_partkey))
            WHEN l_linenumber < 6 THEN array(concat('pic/', l_partkey), concat('pic/s', l_suppkey))
            END AS image_urls""",
    )


def raw_rockets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rocket per part brand, with sizes and prices of its parts."""
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.expr("cast(count(*) AS int) AS n"),
        F.expr("max(p_retailprice) AS price"),
        F.expr("max(p_size) AS largest"),
        F.expr("min(p_size) AS smallest"),
    )
    number = "substring(p_brand, 7)"
    return brands.selectExpr(
        f"concat('rk-', {number}) AS id",
        "p_brand AS name",
        "'rocket' AS type",
        "n % 2 = 0 AS active",
        "smallest % 3 AS stages",
        "n % 4 AS boosters",
        """CASE WHEN p_brand <> 'Brand#5' THEN cast(round(price * 70000.0D) AS bigint) END
            AS cost_per_launch""",
        """CASE WHEN p_brand <> 'Brand#9' THEN cast(n % 41 + 60 AS double) END
            AS success_rate_pct""",
        f"""CASE WHEN p_brand <> 'Brand#11' THEN concat('2010-01-', lpad({number}, 2, '0')) END
            AS first_flight""",
        "'Country' AS country",
        "'Company' AS company",
        """named_struct('meters', CASE WHEN p_brand <> 'Brand#7' THEN largest * 2.5D END)
            AS height""",
        "named_struct('meters', smallest * 0.5D) AS diameter",
        "named_struct('kg', CASE WHEN p_brand <> 'Brand#8' THEN price * 600.0D END) AS mass",
        """CASE WHEN p_brand <> 'Brand#4' THEN repeat(concat(p_brand, ' lifts. '), n % 41) END
            AS description""",
        "'wiki' AS wikipedia",
        f"""CASE n % 3 WHEN 0 THEN cast(array() AS array<string>)
            WHEN 1 THEN array(concat('rocket/', {number}), 'x') END AS flickr_images""",
    )


def vendor_launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor's launch catalogue: seeds for synthetic rows, pads, pictures."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    )
    return orders.selectExpr(
        "cast(o_orderkey AS string) AS id",
        f"{ORDER_NAME} AS name",
        f"{iso('o_orderdate')} AS date_utc",
        "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS success",
        """CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat('rk-', o_custkey % 27 + 1) END
            AS rocket""",
        "CASE WHEN o_orderkey % 13 <> 0 THEN cast(c_nationkey AS string) END AS launchpad",
        """named_struct(
            'patch', named_struct(
                'small', CASE WHEN o_orderkey % 7 = 0 THEN ''
                         WHEN o_orderkey % 3 <> 0 THEN concat('small/', o_orderkey) END,
                'large', CASE WHEN o_orderkey % 5 <> 0 THEN concat('large/', o_orderkey) END),
            'flickr', named_struct('original', CASE WHEN o_orderkey % 4 <> 0
                THEN array(concat('a/', o_orderkey), concat('b/', o_custkey)) END),
            'reddit', named_struct('campaign', 'r'),
            'webcast', 'w', 'wikipedia', 'k', 'article', 'a') AS links""",
    )


def launchpads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as launchpads; one lacks a latitude, another its id, a third its name."""
    return table(spark, sf_dir, "nation").selectExpr(
        "CASE WHEN n_nationkey = 4 THEN '' ELSE cast(n_nationkey AS string) END AS id",
        "CASE WHEN n_nationkey <> 6 THEN concat('Pad ', n_nationkey) END AS name",
        "concat('C', n_nationkey % 9) AS country_code",
        "CASE WHEN n_nationkey <> 3 THEN n_nationkey * 3.5D - 40 END AS latitude",
        "n_nationkey * 7.0D - 90 AS longitude",
        "'locality' AS locality",
        "'region' AS region",
    )


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Launch records by landing run (the order month). Every tenth launch lands
    once more in the run of the next month, under a changed name."""
    landings = "CASE WHEN o_orderkey % 10 = 0 THEN array(0, 1) ELSE array(0) END"
    return table(spark, sf_dir, "orders").selectExpr("*", f"explode({landings}) AS later").selectExpr(
        "date_format(add_months(o_orderdate, later), 'yyyyMM') AS run_id",
        "cast(o_orderkey AS string) AS launch_id",
        f"concat({ORDER_NAME}, CASE later WHEN 1 THEN ' v2' ELSE '' END) AS launch_name",
        "o_orderstatus AS status",
    )


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(run_id, dataset)`` of every record: launches, vendor and catalogue images, weather."""
    launches = run_records(spark, sf_dir).selectExpr("run_id", "'launches' AS dataset")
    images = table(spark, sf_dir, "lineitem").selectExpr(
        "date_format(l_shipdate, 'yyyyMM') AS run_id",
        "CASE WHEN l_returnflag = 'N' THEN 'images' ELSE 'catalogue_images' END AS dataset",
    )
    weather = table(spark, sf_dir, "events").selectExpr(
        "date_format(ts, 'yyyyMM') AS run_id", "'weather' AS dataset"
    )
    return launches.unionByName(images).unionByName(weather)
