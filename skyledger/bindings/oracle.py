"""SQL twins of the query catalogue, for a second engine over the same tables."""

from __future__ import annotations

import re

from skyledger import constants as K
from skyledger.bindings.catalogue import AFTER_CARD, FILTER, PAGE, SEARCH
from skyledger.bindings.domain import BRAND_COSTS
from skyledger.bindings.upkeep import DEEP_PAGE, PAGES_A_RUN, RESET_RUN

SUCCESS, FAILURE, UNKNOWN = K.SUCCESS_LABEL, K.FAILURE_LABEL, K.UNKNOWN_LABEL

NAME = (
    "(['Starlink', 'Crew Dragon', 'CRS', 'Transporter', 'Starship', 'GPS', 'Planet', 'Intelsat',"
    " 'Alpha', 'Beta'])[o_orderkey % 10 + 1] || ' ' || o_orderkey"
)
IMAGE_NAME = "CASE WHEN l_linenumber <> 5 THEN 'Falcon ' || (l_partkey % 9) || ' (' || l_suppkey || ')' END"


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%SZ')"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


PRICES = ", ".join(f"('{b}', {cost}, {per_kg}, '{cat}')" for b, cost, per_kg, cat in BRAND_COSTS)
FEATURES = (
    "launch_id, launch_name, launch_date, launch_year, provider_name, rocket_name, mission_type,"
    " mission_orbit, pad_country_code, pad_latitude, pad_longitude, is_success"
)

CTES = {
    "placed": """
        SELECT o.*, c_mktsegment, n_nationkey, n_name, r_name
        FROM orders o JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "landed": f"""
        SELECT cast(o_orderkey AS varchar) id, {NAME} AS name,
          CASE WHEN o_orderkey % 97 = 0 THEN 'TBD' ELSE {iso('o_orderdate')} END net,
          CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END ts,
          CASE WHEN o_orderkey % 3 <> 0 THEN 'img/' || o_orderkey END image,
          CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN 'img/' || o_orderkey
            WHEN o_orderkey % 4 = 1 THEN 'info/' || o_orderkey END infographic,
          (o_orderstatus <> 'P' OR o_orderkey % 2 = 0) has_status,
          (o_orderpriority <> '5-LOW' OR c_mktsegment <> 'FURNITURE') has_mission, *
        FROM placed""",
    "launches": """
        SELECT id launch_id, name launch_name, net launch_net_utc,
          CASE WHEN has_status THEN CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 4 ELSE 7 END END status_id,
          CASE WHEN has_status THEN 'Status ' || o_orderstatus END status_name,
          CASE WHEN has_status THEN CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Failure'
            ELSE 'Partial Success' END END status_abbrev,
          n_nationkey provider_id, nullif(n_name, 'NATION_7') provider_name,
          cast(o_custkey % 27 + 101 AS int) rocket_internal_id, cast(o_custkey % 27 + 1 AS int) rocket_config_id,
          'Brand#' || (o_custkey % 27 + 1) rocket_name, 'Family ' || ((o_custkey % 27 + 1) % 5) rocket_family,
          CASE WHEN has_mission THEN cast(o_orderkey AS int) END mission_id,
          CASE WHEN has_mission THEN name || ' mission' END mission_name,
          CASE WHEN has_mission THEN nullif(o_orderpriority, '5-LOW') END mission_type,
          CASE WHEN has_mission THEN CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE c_mktsegment END END mission_orbit,
          n_nationkey pad_id, 'Pad ' || n_nationkey pad_name, r_name pad_country_code,
          cast(n_nationkey * 3.5 - 40 AS double) pad_latitude, cast(n_nationkey * 7 - 90 AS double) pad_longitude,
          CASE WHEN n_nationkey <> 3 THEN 'Site ' || n_name END location_name,
          CASE WHEN n_nationkey <> 3 THEN r_name END location_country_code,
          'launch' launch_type, ts launch_ts, cast(ts AS date) launch_date, cast(year(ts) AS int) launch_year,
          CASE WHEN has_status AND o_orderstatus <> 'O' THEN 1 ELSE 0 END is_success
        FROM landed""",
    "raw_frame": """
        SELECT id launch_id, name launch_name, net,
          CASE WHEN has_status THEN CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Failure'
            ELSE 'Partial Success' END END status_abbrev,
          nullif(n_name, 'NATION_7') provider_name,
          CASE WHEN n_nationkey % 2 = 0 THEN 'Commercial' ELSE 'Unknown' END provider_type,
          'Brand#' || (o_custkey % 27 + 1) rocket_name, 'Family ' || ((o_custkey % 27 + 1) % 5) rocket_family,
          CASE WHEN has_mission THEN nullif(o_orderpriority, '5-LOW') END mission_type,
          CASE WHEN has_mission THEN CASE WHEN c_mktsegment = 'FURNITURE' THEN 'FURN' ELSE c_mktsegment END END mission_orbit,
          r_name pad_country_code, CASE WHEN n_nationkey <> 3 THEN 'Site ' || n_name END location_name,
          cast(n_nationkey * 3.5 - 40 AS double) pad_latitude, cast(n_nationkey * 7 - 90 AS double) pad_longitude,
          cast(year(ts) AS int) launch_year,
          CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END is_success
        FROM landed""",
    "frame": "SELECT * FROM raw_frame WHERE launch_year IS NOT NULL",
    "weather": """
        SELECT cast(event_id AS varchar) launch_id, strftime(ts, '%Y-%m-%d') weather_date_raw,
          cast(user_id % 180 - 90 AS double) weather_latitude, cast(user_id % 360 - 180 AS double) weather_longitude,
          'UTC' weather_timezone, cast(user_id AS double) weather_elevation,
          CASE WHEN event_type <> 'error' THEN value / 10 END temperature_2m_mean,
          CASE WHEN event_type <> 'error' THEN cast(json_extract_string(props, '$.k') AS double) END wind_speed_10m_max,
          cast(ts AS date) weather_date, cast(year(ts) AS int) weather_year
        FROM events""",
    "catalogue_images": f"""
        SELECT cast(l_orderkey AS varchar) launch_id, {IMAGE_NAME} launch_name, {iso('l_shipdate')} net, l_shipdate,
          CASE WHEN l_linenumber NOT IN (3, 7) THEN 'img/' || l_partkey END image,
          CASE WHEN l_linenumber % 2 = 0 THEN 'img/' || l_partkey
            WHEN l_linenumber <> 7 THEN 'info/' || l_suppkey END infographic
        FROM lineitem WHERE l_returnflag <> 'N'""",
    "vendor_images": f"""
        SELECT cast(l_orderkey AS varchar) launch_id, {IMAGE_NAME} launch_name, {iso('l_shipdate')} net, l_shipdate,
          unnest(CASE WHEN l_linenumber = 1 THEN ['pic/' || l_partkey, 'pic/' || l_partkey]
            WHEN l_linenumber < 6 THEN ['pic/' || l_partkey, 'pic/s' || l_suppkey] END) image_url
        FROM lineitem WHERE l_returnflag = 'N'""",
    "images": f"""
        SELECT source, launch_id, launch_name, net launch_datetime_utc, image_url,
          cast(l_shipdate AS date) launch_date, cast(year(l_shipdate) AS int) launch_year FROM (
            SELECT '{K.CATALOGUE_SOURCE}' source, launch_id, launch_name, net, l_shipdate, image image_url
            FROM catalogue_images WHERE image IS NOT NULL
            UNION ALL SELECT '{K.CATALOGUE_SOURCE}', launch_id, launch_name, net, l_shipdate, infographic
            FROM catalogue_images WHERE infographic IS NOT NULL AND infographic IS DISTINCT FROM image
            UNION ALL SELECT '{K.VENDOR_SOURCE}', launch_id, launch_name, net, l_shipdate, image_url
            FROM vendor_images)""",
    "raw_rockets": """
        SELECT 'rk-' || substr(p_brand, 7) id, p_brand AS name, cast(count(*) AS int) n, max(p_retailprice) price,
          max(p_size) largest, min(p_size) smallest, substr(p_brand, 7) number
        FROM part GROUP BY p_brand""",
    "rockets": """
        SELECT id spacex_rocket_id, name rocket_name, 'rocket' rocket_type, n % 2 = 0 is_active,
          smallest % 3 stages, n % 4 boosters,
          CASE WHEN name <> 'Brand#5' THEN cast(round(price * 70000.0) AS bigint) END cost_per_launch_usd,
          CASE WHEN name <> 'Brand#9' THEN cast(n % 41 + 60 AS double) END success_rate_pct,
          CASE WHEN name <> 'Brand#11' THEN '2010-01-' || lpad(number, 2, '0') END first_flight_date,
          'Country' country, 'Company' company,
          CASE WHEN name <> 'Brand#7' THEN cast(largest * 2.5 AS double) END height_meters,
          cast(smallest * 0.5 AS double) diameter_meters,
          CASE WHEN name <> 'Brand#8' THEN price * 600 END mass_kg,
          CASE WHEN name <> 'Brand#4' THEN repeat(name || ' lifts. ', n % 41) END description,
          'wiki' wikipedia_url
        FROM raw_rockets""",
    "prices": f"""
        SELECT * FROM (VALUES {PRICES}) t(rocket_name, listed_cost, listed_per_kg, listed_category)""",
    "costs_all": f"""
        SELECT launch_id, rocket_name, provider_name, launch_year, mission_type, is_success,
          cast(coalesce(listed_cost, {K.DEFAULT_COST_USD}) AS bigint) estimated_cost_usd,
          cast(coalesce(listed_per_kg, {K.DEFAULT_COST_PER_KG_USD}) AS bigint) cost_per_kg_leo_usd,
          coalesce(listed_category, '{K.DEFAULT_COST_CATEGORY}') cost_category
        FROM launches LEFT JOIN prices USING (rocket_name)""",
    "costs": "SELECT * FROM costs_all WHERE launch_year IS NOT NULL",
    "gold_metrics": """
        SELECT launch_year, provider_name, count(launch_id) total_launches,
          cast(sum(is_success) AS bigint) successful_launches,
          round(cast(sum(is_success) AS bigint) / count(launch_id) * 100, 2) success_rate_pct
        FROM launches GROUP BY ALL""",
    "metrics": "SELECT * FROM gold_metrics WHERE launch_year IS NOT NULL",
    "gold_features": f"""
        SELECT {FEATURES}, temperature_2m_mean, wind_speed_10m_max,
          coalesce(launch_image_count, 0) launch_image_count
        FROM launches LEFT JOIN weather USING (launch_id)
        LEFT JOIN (SELECT launch_id, count(image_url) launch_image_count FROM images
          WHERE source = '{K.CATALOGUE_SOURCE}' GROUP BY launch_id) USING (launch_id)""",
    "features": "SELECT * FROM gold_features WHERE launch_year IS NOT NULL",
    "vendor": f"""
        SELECT cast(o_orderkey AS varchar) id, {NAME} AS name, o_orderdate, {iso('o_orderdate')} date_utc,
          CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END success,
          CASE WHEN o_orderkey % 11 <> 0 THEN 'rk-' || (o_custkey % 27 + 1) END rocket,
          CASE WHEN o_orderkey % 13 <> 0 THEN cast(c_nationkey AS varchar) END launchpad,
          CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 <> 0 THEN 'small/' || o_orderkey END small,
          CASE WHEN o_orderkey % 5 <> 0 THEN 'large/' || o_orderkey END large,
          CASE WHEN o_orderkey % 4 <> 0 THEN 'a/' || o_orderkey END photo_a,
          CASE WHEN o_orderkey % 4 <> 0 THEN 'b/' || o_custkey END photo_b
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "pads": """
        SELECT cast(n_nationkey AS varchar) launchpad, CASE WHEN n_nationkey <> 6 THEN 'Pad ' || n_nationkey END pad_name,
          'C' || (n_nationkey % 9) pad_country,
          CASE WHEN n_nationkey <> 3 THEN cast(n_nationkey * 3.5 - 40 AS double) END lat,
          cast(n_nationkey * 7 - 90 AS double) lon
        FROM nation WHERE n_nationkey <> 4""",
    "run_records": f"""
        SELECT strftime(o_orderdate + to_months(cast(later AS int)), '%Y%m') run_id, cast(o_orderkey AS varchar) launch_id,
          {NAME} || CASE later WHEN 1 THEN ' v2' ELSE '' END launch_name, o_orderstatus status
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 10 = 0 THEN [0, 1] ELSE [0] END) later FROM orders)""",
    "observed": f"""
        SELECT *, CASE is_success WHEN 1 THEN '{SUCCESS}' WHEN 0 THEN '{FAILURE}' ELSE '{UNKNOWN}' END outcome
        FROM gold_features WHERE temperature_2m_mean IS NOT NULL AND wind_speed_10m_max IS NOT NULL""",
    "readings": """
        SELECT launch_id, outcome, 'temperature_2m_mean' measure, temperature_2m_mean reading FROM observed
        UNION ALL SELECT launch_id, outcome, 'wind_speed_10m_max', wind_speed_10m_max FROM observed""",
    "boxes": """
        SELECT measure, outcome, count(*) total, quantile_cont(reading, 0.25) q1, quantile_cont(reading, 0.5) median,
          quantile_cont(reading, 0.75) q3 FROM readings GROUP BY ALL""",
    "placed_readings": """
        SELECT r.*, total, q1, median, q3,
          reading BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) inside
        FROM readings r JOIN boxes USING (measure, outcome)""",
    "stats": """
        SELECT provider_name, cast(sum(total_launches) AS bigint) total, cast(sum(successful_launches) AS bigint) success,
          round_even(cast(sum(successful_launches) AS bigint) / cast(sum(total_launches) AS bigint) * 100, 1) rate
        FROM metrics WHERE provider_name IS NOT NULL GROUP BY 1""",
    "yearly": """
        SELECT launch_year AS year, cast(sum(total_launches) AS bigint) total,
          cast(sum(successful_launches) AS bigint) success FROM metrics GROUP BY 1""",
}


def with_ctes(sql: str) -> str:
    """Prefix the common tables a query mentions, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(body)

    visit(sql)
    if not needed:
        return sql
    listed = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items() if name in needed)
    return f"WITH {listed}\n{sql}"


def rate(column: str) -> str:
    return f"round_even(cast(sum(is_success) AS bigint) / nullif(count(is_success), 0) * 100, 1) {column}"


def top_yearly(column: str, n: int) -> str:
    return f"""SELECT launch_year, {column}, count(*) launches FROM frame WHERE {column} IN (
        SELECT {column} FROM frame WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {n})
        GROUP BY 1, 2"""


def shares(column: str) -> str:
    return f"""SELECT {column}, count(*) launches, round(count(*) / sum(count(*)) OVER (), 6) share
        FROM frame WHERE {column} IS NOT NULL GROUP BY 1"""


def success_top(column: str, n: int) -> str:
    return f"""SELECT {column}, count(is_success) total, cast(coalesce(sum(is_success), 0) AS bigint) success, {rate('rate')}
        FROM frame WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY total DESC, 1 LIMIT {n}"""


def profile(part: int, name: str, variant: str) -> str:
    branches = "".join(
        f" WHEN {' OR '.join(f'contains(lower({name}), {chr(39)}{k}{chr(39)})' for k in rule[0])}"
        f" THEN '{rule[part]}'"
        for rule in K.MISSION_RULES
    )
    return (
        f"CASE{branches} WHEN {variant} % 5 = 0 THEN '{K.EVERY_FIFTH_PROFILE[part - 1]}'"
        f" ELSE '{K.DEFAULT_PROFILE[part - 1]}' END"
    )


def stable(text: str, minimum: int, span: int) -> str:
    return f"{minimum} + cast('0x' || substr(sha1({text}), 1, 8) AS bigint) % {span}"


def synthetic_id(text: str) -> str:
    return f"cast({stable(text, K.SYNTHETIC_ID_MINIMUM, K.SYNTHETIC_ID_SPAN)} AS int)"


def line(section: str, measure: str, label: str, step: str, text: str, source: str = "") -> str:
    return (
        f"SELECT cast({section} AS int) section, cast({measure} AS double) measure, {label} AS label,"
        f" cast({step} AS int) step, {text} AS line {source}"
    )


def fixed_line(section: int, text: str, step: int = 0) -> str:
    return line(str(section), "NULL", "''", str(step), f"'{text}'")


LAUNCH_COLUMNS = (
    "launch_id, launch_name, launch_net_utc, status_id, status_name, status_abbrev, provider_id, provider_name,"
    " rocket_internal_id, rocket_config_id, rocket_name, rocket_family, mission_id, mission_name, mission_type,"
    " mission_orbit, pad_id, pad_name, pad_country_code, pad_latitude, pad_longitude, location_name,"
    " location_country_code, launch_type"
)
DEFAULT_LAT, DEFAULT_LON = K.SYNTHETIC_PAD_LATITUDE, K.SYNTHETIC_PAD_LONGITUDE

SYNTHETIC = f"""
SELECT * FROM launches UNION ALL
SELECT launch_id, launch_name, strftime(moment, '%Y-%m-%dT%H:%M:%SZ'), CASE WHEN ok THEN 3 ELSE 4 END,
  CASE WHEN ok THEN 'Launch Successful' ELSE 'Launch Failure' END, CASE WHEN ok THEN 'Success' ELSE 'Failure' END,
  {K.SYNTHETIC_PROVIDER_ID}, '{K.SYNTHETIC_PROVIDER_NAME}',
  {synthetic_id('vehicle')}, {synthetic_id("vehicle || ':configuration'")},
  coalesce(brand, seed_name), CASE WHEN brand IS NULL THEN '{K.SYNTHETIC_ROCKET_FAMILY}' ELSE 'rocket' END,
  {synthetic_id("seed || ':' || variant || ':mission'")}, launch_name,
  {profile(1, 'launch_name', 'variant')}, {profile(2, 'launch_name', 'variant')},
  {synthetic_id('coalesce(launchpad, seed)')}, site, country,
  CASE WHEN lat IS NULL OR lon IS NULL THEN {DEFAULT_LAT} ELSE lat END,
  CASE WHEN lat IS NULL OR lon IS NULL THEN {DEFAULT_LON} ELSE lon END,
  site, country, 'launch', moment, cast(moment AS date), cast(year(moment) AS int), CASE WHEN ok THEN 1 ELSE 0 END
FROM (
  SELECT *, 'synthetic-' || seed || '-' || lpad(cast(variant AS varchar), 4, '0') launch_id,
    seed_name || ' Synthetic Batch ' || lpad(cast(variant AS varchar), 3, '0') launch_name,
    o_orderdate + to_days(cast(14 * variant + i % 11 AS int)) + to_hours(i % 24) moment,
    coalesce(success, variant % 4 <> 0) ok, coalesce(rocket, seed) vehicle,
    coalesce(pad_name, '{K.SYNTHETIC_PAD_NAME}') site, coalesce(pad_country, '{K.SYNTHETIC_PAD_COUNTRY}') country
  FROM (SELECT range i, range % n pos, range // n + 1 variant
        FROM (SELECT count(*) n FROM orders), range((SELECT 2 * count(*) + 1 FROM orders))) e
  JOIN (SELECT id seed, name seed_name, o_orderdate, success, rocket, launchpad,
          row_number() OVER (ORDER BY date_utc, id) - 1 pos FROM vendor) s USING (pos)
  LEFT JOIN pads USING (launchpad)
  LEFT JOIN (SELECT id rocket, name brand FROM raw_rockets) USING (rocket))"""

SCORED = f"""
SELECT launch_id, coalesce(rate / 100, {K.DEFAULT_BASE_RATE}) base,
  CASE WHEN t BETWEEN 10 AND 28 THEN 1.0 WHEN t < 10 THEN greatest(0.55, 1.0 - abs(t - 10) * 0.025)
    WHEN t > 28 THEN greatest(0.65, 1.0 - (t - 28) * 0.018) END temp_factor,
  CASE WHEN w <= 30 THEN 1.0 WHEN w <= 60 THEN 1.0 - (w - 30) / 30 * 0.40
    WHEN w > 60 THEN greatest(0.05, 0.60 - (w - 60) / 60 * 0.55) END wind_factor
FROM (SELECT launch_id, rocket_name, temperature_2m_mean t, wind_speed_10m_max w FROM gold_features)
LEFT JOIN (SELECT rocket_name, success_rate_pct rate FROM rockets) USING (rocket_name)"""

BANDS = "".join(f" WHEN probability_pct >= {f} THEN '{label}'" for f, label in K.PROBABILITY_BANDS)

ROCKET_LINE = f"""'- Estado: ' || CASE WHEN is_active THEN 'Activo' ELSE 'Inactivo' END
  || ' | Coste: ' || coalesce('$' || printf('%.0f', cost_per_launch_usd / 1e6) || 'M', '{K.NOT_AVAILABLE}')
  || ' | Éxito: ' || coalesce(printf('%.0f', success_rate_pct) || '%', '{K.NOT_AVAILABLE}')
  || ' | Altura: ' || coalesce(printf('%.0f', height_meters) || 'm', '{K.NOT_AVAILABLE}')
  || ' | Masa: ' || coalesce(printf('%.0f', mass_kg / 1000) || 't', '{K.NOT_AVAILABLE}')
  || ' | Primer vuelo: ' || coalesce(first_flight_date, '{K.NOT_AVAILABLE}')"""
ROCKET_LINES = f"""
SELECT rocket_name, 0 step, '### ' || rocket_name AS line FROM rockets
UNION ALL SELECT rocket_name, 1, {ROCKET_LINE} FROM rockets
UNION ALL SELECT rocket_name, 2, '- ' || substr(description, 1, 300)
  || CASE WHEN length(description) > 300 THEN '...' ELSE '' END
  FROM rockets WHERE description <> ''"""


def top_values(column: str, n: int) -> str:
    return f"""SELECT '{column}' dim, {column} AS value, count(*) launches FROM frame WHERE {column} IS NOT NULL
        GROUP BY 2 ORDER BY launches DESC, value LIMIT {n}"""


def mean_cost(part: str, column: str, tail: str = "") -> str:
    return f"""SELECT '{part}' part, {column} AS label, avg(estimated_cost_usd) measure FROM costs
        WHERE {column} IS NOT NULL GROUP BY 2 {tail}"""


TOP_VALUES = [("mission_type", 10), ("mission_orbit", 8), ("pad_country_code", 8), ("rocket_name", 10)]
DEAREST = "ORDER BY measure DESC, label LIMIT 8"
MEAN_RATES = """SELECT provider_name, cast(sum(total_launches) AS bigint) total, round(avg(success_rate_pct), 6) mean_rate
    FROM metrics WHERE provider_name IS NOT NULL GROUP BY 1 ORDER BY total DESC, 1 LIMIT 10"""
OVERVIEW = """SELECT min(launch_year) first_year, max(launch_year) last_year, cast(sum(total_launches) AS bigint) total,
    cast(sum(successful_launches) AS bigint) success,
    round(cast(sum(successful_launches) AS bigint) / cast(sum(total_launches) AS bigint) * 100, 6) success_pct FROM metrics"""
COST_ITEM = "'  - ' || label || ': $' || printf('%.1f', measure / 1e6) || 'M'"


def top_value_lines(section: int, title: str, column: str, n: int, unit: str) -> list[str]:
    items = f"FROM ({top_values(column, n)})"
    return [
        fixed_line(section, title),
        line(str(section + 1), "launches", "value", "0", f"'- ' || value || ': ' || launches || '{unit}'", items),
        fixed_line(section + 2, ""),
    ]


DOCUMENT = " UNION ALL ".join(
    f"({part})"
    for part in [
        fixed_line(0, "# Datos del Dashboard"),
        fixed_line(0, "", 1),
        fixed_line(1, "## Resumen general"),
        line("1", "NULL", "''", "1", "'- Periodo: ' || first_year || '–' || last_year", f"FROM ({OVERVIEW})"),
        line("1", "NULL", "''", "2", "'- Total lanzamientos: ' || format('{:,}', total)", f"FROM ({OVERVIEW})"),
        line(
            "1", "NULL", "''", "3",
            "'- Exitosos: ' || format('{:,}', success) || ' (' || printf('%.1f', success_pct) || '%)'",
            f"FROM ({OVERVIEW})",
        ),
        fixed_line(1, "", 4),
        fixed_line(2, "## Top 10 proveedores"),
        line(
            "3", "total", "provider_name", "0",
            "'- ' || provider_name || ': ' || total || ' lanzamientos, tasa éxito ' || printf('%.1f', mean_rate) || '%'",
            f"FROM ({MEAN_RATES})",
        ),
        fixed_line(4, ""),
        fixed_line(10, "## Costes de lanzamiento (estimados)"),
        line(
            "10", "NULL", "''", "1",
            "'- Inversión total: $' || printf('%.1f', cast(sum(estimated_cost_usd) AS double) / 1e9) || 'B USD'",
            "FROM costs",
        ),
        line(
            "10", "NULL", "''", "2",
            "'- Coste promedio: $' || printf('%.1f', avg(estimated_cost_usd) / 1e6) || 'M USD/lanzamiento'",
            "FROM costs",
        ),
        line(
            "11", "NULL", "''", "0",
            "'- Categorías: ' || string_agg(cost_category || '=' || n, ', ' ORDER BY n DESC, cost_category)",
            "FROM (SELECT cost_category, count(*) n FROM costs GROUP BY 1)",
        ),
        fixed_line(12, "- Coste medio por proveedor:"),
        line("13", "measure", "label", "0", COST_ITEM, f"FROM ({mean_cost('provider', 'provider_name')})"),
        fixed_line(14, "- Cohetes más caros:"),
        line("15", "measure", "label", "0", COST_ITEM, f"FROM ({mean_cost('rocket', 'rocket_name', DEAREST)})"),
        fixed_line(16, ""),
        *top_value_lines(20, "## Tipos de misión", "mission_type", 10, ""),
        *top_value_lines(23, "## Órbitas", "mission_orbit", 8, ""),
        *top_value_lines(26, "## Países con más lanzamientos", "pad_country_code", 8, ""),
        *top_value_lines(29, "## Cohetes más usados", "rocket_name", 10, " lanzamientos"),
        fixed_line(40, "## Cohetes SpaceX (API oficial)"),
        line("41", "NULL", "rocket_name", "step", "line", f"FROM ({ROCKET_LINES})"),
        fixed_line(42, ""),
    ]
)

CHOSEN = f"""launch_year BETWEEN {FILTER['first_year']} AND {FILTER['last_year']}
    AND provider_name IN ({quoted(FILTER['providers'])})"""
FOUND = f"""source = '{SEARCH['source']}' AND launch_year = {SEARCH['year']}
    AND regexp_matches(launch_name, '{SEARCH['pattern']}', 'i')"""
EXPLORER = K.EXPLORER_HEADINGS
SPECS = K.ROCKET_SPEC_HEADINGS
TABLE = K.PROVIDER_TABLE_HEADINGS

QUERIES = {
    "silver_launches": "SELECT * FROM launches",
    "silver_weather": "SELECT * FROM weather",
    "silver_rockets": "SELECT * FROM rockets",
    "silver_images": "SELECT * FROM images",
    "silver_launch_costs": "SELECT * FROM costs_all",
    "gold_company_year_metrics": "SELECT * FROM gold_metrics",
    "image_counts": "SELECT source, launch_id, count(image_url) image_count FROM images GROUP BY 1, 2",
    "gold_launch_features": "SELECT * FROM gold_features",
    "load_metrics": """SELECT launch_year, provider_name, total_launches,
        CASE WHEN successful_launches % 2 <> 0 THEN successful_launches END successful_launches, success_rate_pct
        FROM metrics WHERE launch_year <> 1998""",
    "load_features": """SELECT launch_id, launch_year, pad_country_code, is_success, temperature_2m_mean,
        wind_speed_10m_max, launch_image_count FROM features""",
    "load_costs": f"""SELECT * EXCLUDE (estimated_cost_usd), nullif(estimated_cost_usd, {K.DEFAULT_COST_USD})
        estimated_cost_usd FROM costs""",
    "raw_flatten": "SELECT * FROM raw_frame",
    "images_from_raw": f"""SELECT source, coalesce(launch_name, '') launch_name, net, image_url,
        cast(year(l_shipdate) AS int) launch_year FROM (
          SELECT '{K.CATALOGUE_SOURCE}' source, launch_name, net, l_shipdate, unnest([image, infographic]) image_url
          FROM catalogue_images
          UNION ALL SELECT '{K.VENDOR_SOURCE}', launch_name, net, l_shipdate, image_url FROM vendor_images)
        WHERE image_url <> ''""",
    "enrich_raw_features": """SELECT f.launch_id, f.mission_orbit, f.is_success, temperature_2m_mean,
        wind_speed_10m_max, launch_image_count FROM frame f LEFT JOIN gold_features g USING (launch_id)""",
    "compact_launches": f"""SELECT {LAUNCH_COLUMNS.replace('pad_latitude, pad_longitude', "cast(pad_latitude AS varchar) pad_latitude, cast(pad_longitude AS varchar) pad_longitude")},
        image, infographic, 0 missing_mission FROM launches JOIN (SELECT id launch_id, image, infographic FROM landed)
        USING (launch_id)""",
    "compact_images": """SELECT id launch_library_id, name, net, image, infographic FROM landed
        WHERE image <> '' OR infographic <> ''""",
    "extract_launch_images": """SELECT launch_id, cast(generate_subscripts(urls, 1) - 1 AS int) pos, unnest(urls) url FROM (
        SELECT id launch_id, CASE WHEN small IS NULL THEN [] ELSE [small] END || CASE WHEN large IS NULL THEN [] ELSE [large] END
          || CASE WHEN photo_a IS NULL THEN [] ELSE [photo_a, photo_b] END urls FROM vendor)""",
    "weather_targets": """SELECT id launch_id, strftime(o_orderdate, '%Y-%m-%d') date, lat, lon
        FROM vendor JOIN pads USING (launchpad) WHERE lat IS NOT NULL""",
    "weather_targets_budget": """SELECT id launch_id, strftime(o_orderdate, '%Y-%m-%d') date, lat, lon
        FROM vendor JOIN pads USING (launchpad) WHERE lat IS NOT NULL AND cast(id AS bigint) % 3 = 2
        ORDER BY date, launch_id LIMIT 50""",
    "tolerant_scan": """SELECT id, name, net, CASE WHEN cast(id AS bigint) % 6 <> 2 AND has_status THEN 'Status ' || o_orderstatus END status_name,
          CASE WHEN cast(id AS bigint) % 6 = 2 THEN '["' || id || '"]' END image
        FROM landed WHERE cast(id AS bigint) % 6 NOT IN (0, 3)""",
    "landed_status": f"""SELECT cast(year AS varchar) run_id, dataset, CASE WHEN dataset = '{K.ROCKETS_FILE}'
          THEN CASE WHEN year % 2 = 1 THEN (SELECT count(DISTINCT p_brand) FROM part) ELSE 0 END ELSE launches END AS rows
        FROM (SELECT year(o_orderdate) AS year, count(*) launches FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 5)
        CROSS JOIN (SELECT unnest(['{K.LAUNCHES_FILE}', '{K.ROCKETS_FILE}']) AS dataset)""",
    "latest_run_snapshot": "SELECT * FROM run_records WHERE run_id = (SELECT max(run_id) FROM run_records)",
    "runs_dedup_latest": """SELECT * FROM run_records
        QUALIFY row_number() OVER (PARTITION BY launch_id ORDER BY run_id DESC) = 1""",
    "run_manifest": f"""SELECT '{K.LAUNCHES_FILE}' dataset, count(*) AS rows FROM orders
        UNION ALL SELECT '{K.CATALOGUE_IMAGES_FILE}', count(*) FROM landed WHERE image <> '' OR infographic <> ''
        UNION ALL SELECT '{K.ROCKETS_FILE}', count(DISTINCT p_brand) FROM part
        UNION ALL SELECT '{K.PAYLOADS_FILE}', count(*) FROM part
        UNION ALL SELECT '{K.CORES_FILE}', count(*) FROM customer
        UNION ALL SELECT '{K.SHIPS_FILE}', count(*) FROM supplier
        UNION ALL SELECT '{K.VENDOR_IMAGES_FILE}', count(*) FROM vendor WHERE coalesce(small, large, photo_a) IS NOT NULL
        UNION ALL SELECT '{K.WEATHER_FILE}', count(*) FROM events""",
    "landed_manifest": f"""SELECT '{K.LAUNCHES_FILE}' dataset, count(*) AS rows FROM orders
        UNION ALL SELECT '{K.WEATHER_FILE}', count(*) FROM events
        UNION ALL SELECT '{K.ROCKETS_FILE}', count(DISTINCT p_brand) FROM part
        UNION ALL SELECT '{K.CATALOGUE_IMAGES_FILE}', count(*) FROM lineitem WHERE l_returnflag <> 'N'
        UNION ALL SELECT '{K.VENDOR_IMAGES_FILE}', count(*) FROM lineitem WHERE l_returnflag = 'N'
        UNION ALL SELECT '{K.PAYLOADS_FILE}', count(*) FROM part
        UNION ALL SELECT '{K.CORES_FILE}', count(*) FROM customer
        UNION ALL SELECT '{K.SHIPS_FILE}', count(*) FROM supplier""",
    "data_status": """SELECT run_id, dataset, count(record) AS rows FROM (
          SELECT run_id FROM (SELECT run_id FROM run_records UNION SELECT strftime(l_shipdate, '%Y%m') FROM lineitem
            UNION SELECT strftime(ts, '%Y%m') FROM events) ORDER BY run_id DESC LIMIT 5)
        CROSS JOIN (VALUES ('launches'), ('images'), ('catalogue_images'), ('weather')) d(dataset)
        LEFT JOIN (SELECT run_id, 'launches' dataset, 1 record FROM run_records
          UNION ALL SELECT strftime(l_shipdate, '%Y%m'), CASE WHEN l_returnflag = 'N' THEN 'images' ELSE 'catalogue_images' END, 1
            FROM lineitem
          UNION ALL SELECT strftime(ts, '%Y%m'), 'weather', 1 FROM events) USING (run_id, dataset) GROUP BY 1, 2""",
    "table_partitions": """SELECT 'launches' table_name, count(DISTINCT coalesce(launch_year, -1)) partitions FROM launches
        UNION ALL SELECT 'images', count(DISTINCT source) FROM images
        UNION ALL SELECT 'weather', count(DISTINCT weather_year) FROM weather
        UNION ALL SELECT 'company_year_metrics', count(DISTINCT coalesce(launch_year, -1)) FROM gold_metrics
        UNION ALL SELECT 'launch_features', count(DISTINCT coalesce(launch_year, -1)) FROM gold_features""",
    "parquet_roundtrip": "SELECT * FROM costs",
    "json_roundtrip": "SELECT * FROM launches",
    "rockets_roundtrip": "SELECT * FROM rockets",
    "medallion_job": """SELECT launch_id, launch_date, launch_year, provider_name, is_success, temperature_2m_mean,
        wind_speed_10m_max, launch_image_count FROM features""",
    "incremental_landing": "SELECT launch_id, launch_year, provider_name, rocket_name, is_success FROM launches",
    "mission_profile": f"""SELECT name, variant, {profile(1, 'name', 'variant')} AS type, {profile(2, 'name', 'variant')} orbit
        FROM (SELECT launch_name AS name, cast(length(launch_name) % 7 AS int) variant FROM run_records)""",
    "stable_int": f"""SELECT key, {stable('key', 2000, 800000)} AS value FROM (SELECT 'pad:' || o_orderkey AS key FROM orders)""",
    "synthetic_expand": SYNTHETIC,
    "launch_probability": f"""SELECT launch_id, base, temp_factor, wind_factor, probability,
        probability_pct, CASE{BANDS} WHEN probability_pct IS NOT NULL THEN '{K.LOWEST_PROBABILITY_BAND}' END band,
        CASE WHEN temp_factor >= 0.95 THEN 'good' WHEN temp_factor >= 0.75 THEN 'fair' WHEN temp_factor IS NOT NULL THEN 'poor' END temp_band,
        CASE WHEN wind_factor >= 0.95 THEN 'good' WHEN wind_factor >= 0.65 THEN 'fair' WHEN wind_factor IS NOT NULL THEN 'poor' END wind_band
        FROM (SELECT *, round_even(probability * 100, 1) probability_pct FROM (
          SELECT *, CASE WHEN base * temp_factor * wind_factor IS NOT NULL
            THEN least(0.99, greatest(0.01, base * temp_factor * wind_factor)) END probability FROM ({SCORED})))""",
    "global_filter": f"""SELECT launch_id, launch_year, provider_name, mission_orbit FROM frame
        WHERE {CHOSEN} AND mission_orbit IN ({quoted(FILTER['orbits'])})""",
    "filter_options": """SELECT DISTINCT 'year' dim, cast(launch_year AS varchar) AS value FROM metrics
        UNION ALL SELECT DISTINCT 'provider', provider_name FROM metrics WHERE provider_name IS NOT NULL
        UNION ALL SELECT DISTINCT 'orbit', mission_orbit FROM frame WHERE mission_orbit IS NOT NULL
        UNION ALL SELECT DISTINCT 'source', source FROM images
        UNION ALL SELECT DISTINCT 'image_year', cast(launch_year AS varchar) FROM images""",
    "kpi_summary": """SELECT * FROM (SELECT cast(sum(total_launches) AS bigint) total, cast(sum(successful_launches) AS bigint) success,
          round_even(cast(sum(successful_launches) AS bigint) / cast(sum(total_launches) AS bigint) * 100, 1) rate,
          count(DISTINCT provider_name) providers FROM metrics)
        CROSS JOIN (SELECT count(DISTINCT pad_country_code) countries, count(DISTINCT mission_orbit) orbits,
          round(avg(temperature_2m_mean), 6) mean_temperature, round(avg(wind_speed_10m_max), 6) mean_wind,
          count(*) feature_rows FROM features)""",
    "hero_summary": """SELECT cast(sum(total_launches) AS bigint) total,
        round_even(cast(sum(successful_launches) AS bigint) / cast(sum(total_launches) AS bigint) * 100, 1) rate,
        cast(max(launch_year) - min(launch_year) + 1 AS int) AS years, count(DISTINCT provider_name) providers FROM metrics""",
    "filtered_kpi": f"""SELECT * FROM (SELECT cast(sum(total_launches) AS bigint) total, cast(sum(successful_launches) AS bigint) success,
          round_even(cast(sum(successful_launches) AS bigint) / cast(sum(total_launches) AS bigint) * 100, 1) rate,
          count(DISTINCT provider_name) providers FROM metrics WHERE {CHOSEN})
        CROSS JOIN (SELECT count(DISTINCT pad_country_code) countries, count(DISTINCT mission_orbit) orbits,
          round(avg(temperature_2m_mean), 6) mean_temperature, round(avg(wind_speed_10m_max), 6) mean_wind,
          count(*) feature_rows FROM features WHERE {CHOSEN} AND mission_orbit IN ({quoted(FILTER['orbits'])}))""",
    "filtered_hero": f"""SELECT cast(sum(total_launches) AS bigint) total,
        round_even(cast(sum(successful_launches) AS bigint) / cast(sum(total_launches) AS bigint) * 100, 1) rate,
        {FILTER['last_year'] - FILTER['first_year'] + 1} AS years, count(DISTINCT provider_name) providers FROM metrics WHERE {CHOSEN}""",
    "yearly_activity": """SELECT year, total, success, greatest(total - success, 0) failed, rate,
        round(avg(rate) OVER (ORDER BY year ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) rolling,
        cast(sum(total) OVER (ORDER BY year ROWS UNBOUNDED PRECEDING) AS bigint) cumulative,
        cast(sum(success) OVER (ORDER BY year ROWS UNBOUNDED PRECEDING) AS bigint) cum_success
        FROM (SELECT *, round_even(success / total * 100, 2) rate FROM yearly)""",
    "top_provider_trend": """SELECT launch_year, provider_name, total_launches FROM metrics
        WHERE provider_name IN (SELECT provider_name FROM stats ORDER BY total DESC, 1 LIMIT 5)""",
    "season_heatmap": "SELECT cast(year(launch_date) AS int) AS year, "
    + ", ".join(f"count(CASE WHEN month(launch_date) = {m} THEN 1 END) m{m}" for m in range(1, 13))
    + " FROM launches WHERE launch_date IS NOT NULL GROUP BY 1",
    "season_heatmap_filtered": "SELECT cast(year(launch_date) AS int) AS year, "
    + ", ".join(f"count(CASE WHEN month(launch_date) = {m} THEN 1 END) m{m}" for m in range(1, 13))
    + " FROM launches WHERE launch_date IS NOT NULL AND year(launch_date) BETWEEN (SELECT min(launch_year) FROM metrics WHERE "
    + CHOSEN
    + ") AND (SELECT max(launch_year) FROM metrics WHERE "
    + CHOSEN
    + ") GROUP BY 1",
    "provider_stats": "SELECT * FROM stats",
    "provider_top12": "SELECT provider_name, total FROM stats ORDER BY total DESC, 1 LIMIT 12",
    "provider_rate_top10": "SELECT provider_name, rate FROM stats ORDER BY total DESC, 1 LIMIT 10",
    "provider_rate_trend": """SELECT launch_year, provider_name, success_rate_pct FROM metrics
        WHERE provider_name IN (SELECT provider_name FROM stats ORDER BY total DESC, 1 LIMIT 6)""",
    "market_share": f"""SELECT name, cast(sum(total) AS bigint) total, round(sum(total) / sum(sum(total)) OVER (), 6) share FROM (
        SELECT CASE WHEN row_number() OVER (ORDER BY total DESC, provider_name) <= 8 THEN provider_name
          ELSE '{K.OTHERS_LABEL}' END AS name, total FROM stats) GROUP BY 1""",
    "provider_table_top15": f"""SELECT provider_name "{TABLE['provider_name']}", total "{TABLE['total']}", success "{TABLE['success']}",
        printf('%.1f', rate) || '%' "{TABLE['rate']}" FROM stats ORDER BY total DESC, provider_name LIMIT 15""",
    "race_cumulative": """SELECT year, provider, running,
        cast(row_number() OVER (PARTITION BY year ORDER BY running, seat) AS int) AS position FROM (
          SELECT year, provider, seat, cast(sum(coalesce(total_launches, 0)) OVER (PARTITION BY provider ORDER BY year) AS bigint) running
          FROM (SELECT DISTINCT launch_year AS year FROM metrics) CROSS JOIN (
            SELECT provider_name provider, row_number() OVER (ORDER BY total DESC, provider_name) seat FROM stats
            ORDER BY seat LIMIT 15)
          LEFT JOIN metrics ON provider_name = provider AND launch_year = year)""",
    "mission_type_counts": shares("mission_type"),
    "orbit_counts": shares("mission_orbit"),
    "orbit_by_year": top_yearly("mission_orbit", 6),
    "mission_success": success_top("mission_type", 10),
    "pad_stats": """SELECT lat, lon, country, total, success, round_even(success / total * 100, 1) success_rate, label,
        round(least(greatest(total / max(total) OVER () * 20 + 5, 5), 25), 6) dot_size FROM (
          SELECT pad_latitude lat, pad_longitude lon, pad_country_code country, count(*) total,
            cast(coalesce(sum(is_success), 0) AS bigint) success,
            coalesce(min(location_name), pad_country_code) label FROM frame GROUP BY 1, 2, 3)""",
    "country_top12": """SELECT pad_country_code, count(*) launches FROM frame GROUP BY 1 ORDER BY launches DESC, 1 LIMIT 12""",
    "country_success": success_top("pad_country_code", 10),
    "country_by_year": top_yearly("pad_country_code", 4),
    "rocket_chart_values": """SELECT rocket_name AS name, round(mass_kg / 1000, 6) mass_t,
        round(cost_per_launch_usd / 1000000, 6) cost_m, height_meters height FROM rockets""",
    "rocket_radar": """SELECT rocket_name AS name, round(least(height_meters / 120, 1), 6) h, round(least(mass_kg / 1400000, 1), 6) m,
        round(coalesce(success_rate_pct, 0) / 100, 6) sr,
        round(1 - least(coalesce(nullif(cost_per_launch_usd, 0), 1) / 100000000, 1), 6) eco,
        round(least(coalesce(nullif(stages, 0), 1) / 3, 1), 6) stage
        FROM rockets WHERE height_meters IS NOT NULL AND mass_kg IS NOT NULL""",
    "rocket_specs": f"""SELECT rocket_name "{SPECS['rocket_name']}", height_meters "{SPECS['height_meters']}",
        diameter_meters "{SPECS['diameter_meters']}",
        coalesce(format('{{:,}}', cast(round_even(mass_kg, 0) AS bigint)), '{K.MISSING_MARK}') "{SPECS['mass_kg']}",
        coalesce('$' || format('{{:,}}', cost_per_launch_usd), '{K.MISSING_MARK}') "{SPECS['cost_per_launch_usd']}",
        success_rate_pct "{SPECS['success_rate_pct']}", first_flight_date "{SPECS['first_flight_date']}",
        stages "{SPECS['stages']}", boosters "{SPECS['boosters']}", is_active "{SPECS['is_active']}" FROM rockets""",
    "rocket_cards": """SELECT rocket_name, printf('%.0f', height_meters) || ' m' height, printf('%.0f', mass_kg / 1000) || ' t' mass,
        printf('%.0f', success_rate_pct) || '%' success_rate, '$' || printf('%.0f', cost_per_launch_usd / 1000000) || 'M' cost,
        CASE WHEN length(description) > 240 THEN substr(description, 1, 240) || '…' ELSE description END description FROM rockets""",
    "rocket_first_image": """SELECT name rocket_name, CASE WHEN n % 3 = 1 THEN 'rocket/' || number END image_url FROM raw_rockets""",
    "weather_box_stats": """SELECT measure, outcome, total, round(q1, 6) q1, round(median, 6) median, round(q3, 6) q3,
        min(CASE WHEN inside THEN reading END) whisker_low, max(CASE WHEN inside THEN reading END) whisker_high,
        count(CASE WHEN NOT inside THEN 1 END) outliers FROM placed_readings
        GROUP BY measure, outcome, total, q1, median, q3""",
    "weather_outliers": "SELECT launch_id, measure, outcome, reading FROM placed_readings WHERE NOT inside",
    "weather_sample": """SELECT launch_id, outcome, temperature_2m_mean, wind_speed_10m_max FROM observed
        ORDER BY sha1('7:' || launch_id), launch_id LIMIT 600""",
    "temp_histogram": """SELECT outcome, bin, count(*) launches, round(min(lo) + (bin - 1) * min(width), 6) bin_start FROM (
          SELECT outcome, lo, width, cast(least(floor((t - lo) / width) + 1, 35) AS int) bin FROM (
            SELECT outcome, temperature_2m_mean t FROM observed),
            (SELECT min(temperature_2m_mean) lo, (max(temperature_2m_mean) - min(temperature_2m_mean)) / 35 width FROM observed))
        GROUP BY 1, 2""",
    "weather_by_year": """SELECT launch_year, round(avg(temperature_2m_mean), 6) temp, round(avg(wind_speed_10m_max), 6) wind
        FROM observed WHERE launch_year IS NOT NULL GROUP BY 1""",
    "gallery_search": f"SELECT launch_id, launch_name, launch_year, image_url FROM images WHERE {FOUND}",
    "gallery_page": f"""SELECT launch_id, image_url, coalesce(nullif(launch_name, ''), '{K.MISSING_MARK}') || ' · ' || launch_year caption,
        CASE source WHEN '{K.CATALOGUE_SOURCE}' THEN 'Launch Library' ELSE 'Spacex' END source_label FROM images
        ORDER BY launch_year, source, launch_id, image_url, launch_name NULLS FIRST LIMIT 20 OFFSET {20 * PAGE}""",
    "gallery_after": f"""SELECT launch_id, image_url, coalesce(nullif(launch_name, ''), '{K.MISSING_MARK}') || ' · ' || launch_year caption,
        CASE source WHEN '{K.CATALOGUE_SOURCE}' THEN 'Launch Library' ELSE 'Spacex' END source_label FROM images
        WHERE launch_year IS NOT NULL AND (launch_year, source, launch_id, image_url, coalesce(launch_name, '')) >= {AFTER_CARD}
        ORDER BY launch_year, source, launch_id, image_url, launch_name NULLS FIRST LIMIT 20""",
    "gallery_pages": f"""SELECT count(*) total, cast(greatest(1, ceil(count(*) / 20)) AS bigint) pages FROM images WHERE {FOUND}""",
    "cost_kpis": """SELECT cast(sum(estimated_cost_usd) AS double) total_cost, avg(estimated_cost_usd) mean_cost,
        avg(CASE WHEN is_success = 1 THEN estimated_cost_usd END) mean_cost_success,
        count(*) launches, count(DISTINCT provider_name) providers FROM costs""",
    "cost_by_provider": """SELECT provider_name, round_even(avg(estimated_cost_usd) / 1e6, 1) cost_m FROM costs
        WHERE provider_name IS NOT NULL GROUP BY 1""",
    "cost_trend_top5": """SELECT launch_year, provider_name, round_even(avg(estimated_cost_usd) / 1e6, 1) cost_m FROM costs
        WHERE provider_name IN (SELECT provider_name FROM costs WHERE provider_name IS NOT NULL GROUP BY 1
          ORDER BY avg(estimated_cost_usd) DESC, 1 LIMIT 5) GROUP BY 1, 2""",
    "cost_by_year": """SELECT launch_year, round_even(cast(sum(estimated_cost_usd) AS double) / 1e9, 3) cost_b FROM costs GROUP BY 1""",
    "cost_vs_success": """SELECT provider_name, avg(estimated_cost_usd) / 1e6 cost_m,
        round_even(cast(sum(is_success) AS bigint) / count(is_success) * 100, 1) success_pct, count(*) launches,
        cast(greatest(10, least(40, count(*) / 5)) AS double) marker_size, split_part(provider_name, ' ', 1) label
        FROM costs WHERE provider_name IS NOT NULL GROUP BY provider_name""",
    "cost_category": """SELECT cost_category, count(*) launches, avg(estimated_cost_usd) mean_cost,
        round(count(*) / sum(count(*)) OVER (), 6) share FROM costs GROUP BY 1""",
    "cost_by_mission": """SELECT mission_type, round_even(avg(estimated_cost_usd) / 1e6, 1) cost_m FROM costs
        WHERE mission_type IS NOT NULL GROUP BY 1""",
    "context_overview": OVERVIEW,
    "context_providers": MEAN_RATES,
    "context_costs": f"""SELECT 'category' part, cost_category AS label, cast(count(*) AS double) measure FROM costs GROUP BY 2
        UNION ALL {mean_cost('provider', 'provider_name')}
        UNION ALL ({mean_cost('rocket', 'rocket_name', DEAREST)})""",
    "context_top_values": " UNION ALL ".join(f"({top_values(c, n)})" for c, n in TOP_VALUES),
    "context_rockets": ROCKET_LINES,
    "context_document": DOCUMENT,
    "launch_explorer": f"""SELECT launch_name "{EXPLORER['launch_name']}", launch_year "{EXPLORER['launch_year']}",
        provider_name "{EXPLORER['provider_name']}", rocket_name "{EXPLORER['rocket_name']}",
        mission_type "{EXPLORER['mission_type']}", mission_orbit "{EXPLORER['mission_orbit']}",
        pad_country_code "{EXPLORER['pad_country_code']}",
        CASE is_success WHEN 1 THEN '{K.EXPLORER_RESULTS[0]}' WHEN 0 THEN '{K.EXPLORER_RESULTS[1]}'
          ELSE '{K.EXPLORER_RESULTS[2]}' END "{EXPLORER['is_success']}",
        round_even(temperature_2m_mean, 1) "{EXPLORER['temperature_2m_mean']}",
        round_even(wind_speed_10m_max, 1) "{EXPLORER['wind_speed_10m_max']}",
        launch_image_count "{EXPLORER['launch_image_count']}" FROM features""",
}

QUERIES["gallery_images"] = f"SELECT source, launch_name, launch_year, image_url FROM ({QUERIES['images_from_raw']})"

QUERIES["gallery_silver_images"] = "SELECT source, launch_name, launch_year, image_url FROM images WHERE launch_year IS NOT NULL"

IN_YEARS = f"launch_year BETWEEN {FILTER['first_year']} AND {FILTER['last_year']}"
IN_LISTS = f"provider_name IN ({quoted(FILTER['providers'])})"
QUERIES |= {
    # run k starts at page s_k (from 0); the last run is the one that resets
    "landing_cursor": f"""SELECT run_id, page, launches FROM (
          SELECT strftime(o_orderdate, 'p%Y-%m') page, count(*) launches,
            row_number() OVER (ORDER BY strftime(o_orderdate, 'p%Y-%m')) - 1 place, count(*) OVER () n FROM orders GROUP BY 1)
        JOIN (SELECT unnest(range(1, {RESET_RUN + 1})) run) ON true
        JOIN (SELECT 'run' || unnest(range(1, {RESET_RUN + 1})) run_id, unnest(range(1, {RESET_RUN + 1})) k) ON k = run
        JOIN (SELECT n all_pages, s1, s2, s3, s4, 0 s5 FROM (SELECT *, CASE WHEN s3 + {PAGES_A_RUN} >= n THEN 0 ELSE s3 + {PAGES_A_RUN} END s4 FROM (
            SELECT *, CASE WHEN s2 + {PAGES_A_RUN} >= n THEN 0 ELSE s2 + {PAGES_A_RUN} END s3 FROM (
            SELECT *, CASE WHEN s1 + {PAGES_A_RUN} >= n THEN 0 ELSE s1 + {PAGES_A_RUN} END s2 FROM (
            SELECT 0 s1, count(DISTINCT strftime(o_orderdate, 'p%Y-%m')) n FROM orders))))) ON true
        WHERE place >= [s1, s2, s3, s4, s5][run] AND place < [s1, s2, s3, s4, s5][run] + {PAGES_A_RUN}""",
    "accumulated_silver": """SELECT run_id, launch_id, launch_name, status, cast(substr(run_id, 1, 4) AS int) run_year FROM run_records
        QUALIFY row_number() OVER (PARTITION BY launch_id ORDER BY run_id DESC) = 1""",
    "gold_after_update": """SELECT launch_year, provider_name, total_launches,
          CASE WHEN launch_year = newest THEN total_launches ELSE successful_launches END successful_launches,
          CASE WHEN launch_year = newest THEN 100.0::DOUBLE ELSE success_rate_pct END success_rate_pct
        FROM metrics JOIN (SELECT year(max(o_orderdate)) newest FROM orders) ON true""",
    "pruned_filter": f"""SELECT launch_id, launch_year, provider_name, mission_orbit FROM launches
        WHERE {IN_YEARS} AND {IN_LISTS} AND mission_orbit IN ({quoted(FILTER['orbits'])})""",
    "pruned_season": f"""SELECT launch_year AS year, {', '.join(f"count(CASE WHEN month(launch_date) = {m} THEN 1 END) m{m}" for m in range(1, 13))}
        FROM launches WHERE launch_year BETWEEN
          (SELECT min(launch_year) FROM metrics WHERE {IN_YEARS} AND {IN_LISTS}) AND
          (SELECT max(launch_year) FROM metrics WHERE {IN_YEARS} AND {IN_LISTS}) GROUP BY 1""",
    "pruned_busiest_years": """SELECT launch_year, provider_name, count(*) launches FROM launches WHERE launch_year IN (
          SELECT launch_year FROM metrics GROUP BY 1 ORDER BY sum(total_launches) DESC, launch_year LIMIT 2) GROUP BY 1, 2""",
    "bucketed_features": QUERIES["gold_launch_features"],
    "written_status": """SELECT 'launches' table_name, count(DISTINCT coalesce(launch_year, -1)) partitions,
          cast(min(launch_year) AS varchar) "first", cast(max(launch_year) AS varchar) "last", count(*) AS rows, count(launch_date) filled FROM launches
        UNION ALL SELECT 'weather', count(DISTINCT coalesce(weather_year, -1)), cast(min(weather_year) AS varchar), cast(max(weather_year) AS varchar),
          count(*), count(weather_date) FROM weather
        UNION ALL SELECT 'images', count(DISTINCT source), min(source), max(source), count(*), count(launch_date) FROM images""",
    "gallery_deep_page": QUERIES["gallery_page"].replace(f"OFFSET {20 * PAGE}", f"OFFSET {20 * DEEP_PAGE}"),
    "quarantined_scan": """SELECT 'read' outcome, cast(launch_year AS varchar) part, count(*) AS rows FROM costs GROUP BY 2
        UNION ALL SELECT 'left out', 'part-broken.parquet', 0""",
}

ORACLE = {name: with_ctes(sql) for name, sql in QUERIES.items()}
