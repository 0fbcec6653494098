"""RAW contracts, declared so that no job infers a schema."""

from __future__ import annotations

# --- Fixed values: RAW record structures --------------------------------------
LAUNCH = """
id STRING, name STRING, net STRING, type STRING, image STRING, infographic STRING,
status STRUCT<id: INT, name: STRING, abbrev: STRING>,
launch_service_provider STRUCT<id: INT, name: STRING>,
rocket STRUCT<id: INT, configuration: STRUCT<id: INT, name: STRING, family: STRING>>,
mission STRUCT<id: INT, name: STRING, type: STRING, orbit: STRUCT<name: STRING>>,
pad STRUCT<id: INT, name: STRING, country_code: STRING, latitude: STRING, longitude: STRING,
           location: STRUCT<name: STRING, country_code: STRING>>
"""

# as LAUNCH, with the two optional fields the launch frame falls back on
LAUNCH_WIDE = """
id STRING, name STRING, net STRING, type STRING, image STRING, infographic STRING,
status STRUCT<id: INT, name: STRING, abbrev: STRING>,
launch_service_provider STRUCT<id: INT, name: STRING, type: STRING>,
rocket STRUCT<id: INT, configuration: STRUCT<id: INT, name: STRING, family: STRING>>,
mission STRUCT<id: INT, name: STRING, type: STRING, orbit: STRUCT<name: STRING, abbrev: STRING>>,
pad STRUCT<id: INT, name: STRING, country_code: STRING, latitude: STRING, longitude: STRING,
           location: STRUCT<name: STRING, country_code: STRING>>
"""

WEATHER = """
launch_id STRING, date STRING, latitude STRING, longitude STRING,
weather STRUCT<timezone: STRING, elevation: DOUBLE,
               daily: STRUCT<temperature_2m_mean: ARRAY<DOUBLE>, wind_speed_10m_max: ARRAY<DOUBLE>>>
"""

ROCKET = """
id STRING, name STRING, type STRING, active BOOLEAN, stages INT, boosters INT,
cost_per_launch BIGINT, success_rate_pct DOUBLE, first_flight STRING, country STRING,
company STRING, height STRUCT<meters: DOUBLE>, diameter STRUCT<meters: DOUBLE>,
mass STRUCT<kg: DOUBLE>, description STRING, wikipedia STRING, flickr_images ARRAY<STRING>
"""

CATALOGUE_IMAGE = """
launch_library_id STRING, name STRING, net STRING, image STRING, infographic STRING
"""

VENDOR_IMAGE = """
spacex_launch_id STRING, name STRING, date_utc STRING, success BOOLEAN, rocket_id STRING,
webcast STRING, wikipedia STRING, article STRING, reddit_campaign STRING, image_urls ARRAY<STRING>
"""

VENDOR_LAUNCH = """
id STRING, name STRING, date_utc STRING, success BOOLEAN, rocket STRING, launchpad STRING,
links STRUCT<patch: STRUCT<small: STRING, large: STRING>, flickr: STRUCT<original: ARRAY<STRING>>,
             reddit: STRUCT<campaign: STRING>, webcast: STRING, wikipedia: STRING, article: STRING>
"""

LAUNCHPAD = """
id STRING, name STRING, country_code STRING, latitude DOUBLE, longitude DOUBLE,
locality STRING, region STRING
"""

# --- Fixed values: Silver columns as name -> (RAW path, type) -------------------
SILVER_LAUNCH_COLUMNS = {
    "launch_id": ("id", "string"),
    "launch_name": ("name", "string"),
    "launch_net_utc": ("net", "string"),
    "status_id": ("status.id", "int"),
    "status_name": ("status.name", "string"),
    "status_abbrev": ("status.abbrev", "string"),
    "provider_id": ("launch_service_provider.id", "int"),
    "provider_name": ("launch_service_provider.name", "string"),
    "rocket_internal_id": ("rocket.id", "int"),
    "rocket_config_id": ("rocket.configuration.id", "int"),
    "rocket_name": ("rocket.configuration.name", "string"),
    "rocket_family": ("rocket.configuration.family", "string"),
    "mission_id": ("mission.id", "int"),
    "mission_name": ("mission.name", "string"),
    "mission_type": ("mission.type", "string"),
    "mission_orbit": ("mission.orbit.name", "string"),
    "pad_id": ("pad.id", "int"),
    "pad_name": ("pad.name", "string"),
    "pad_country_code": ("pad.country_code", "string"),
    "pad_latitude": ("pad.latitude", "double"),
    "pad_longitude": ("pad.longitude", "double"),
    "location_name": ("pad.location.name", "string"),
    "location_country_code": ("pad.location.country_code", "string"),
    "launch_type": ("type", "string"),
}
SILVER_WEATHER_COLUMNS = {
    "launch_id": ("launch_id", "string"),
    "weather_date_raw": ("date", "string"),
    "weather_latitude": ("latitude", "double"),
    "weather_longitude": ("longitude", "double"),
    "weather_timezone": ("weather.timezone", "string"),
    "weather_elevation": ("weather.elevation", "double"),
    "temperatures": ("weather.daily.temperature_2m_mean", "array<double>"),
    "wind_speeds": ("weather.daily.wind_speed_10m_max", "array<double>"),
}
SILVER_ROCKET_COLUMNS = {
    "spacex_rocket_id": ("id", "string"),
    "rocket_name": ("name", "string"),
    "rocket_type": ("type", "string"),
    "is_active": ("active", "boolean"),
    "stages": ("stages", "int"),
    "boosters": ("boosters", "int"),
    "cost_per_launch_usd": ("cost_per_launch", "bigint"),
    "success_rate_pct": ("success_rate_pct", "double"),
    "first_flight_date": ("first_flight", "string"),
    "country": ("country", "string"),
    "company": ("company", "string"),
    "height_meters": ("height.meters", "double"),
    "diameter_meters": ("diameter.meters", "double"),
    "mass_kg": ("mass.kg", "double"),
    "description": ("description", "string"),
    "wikipedia_url": ("wikipedia", "string"),
}
LAUNCH_FRAME_COLUMNS = {
    "launch_id": ("id", "string"),
    "launch_name": ("name", "string"),
    "net": ("net", "string"),
    "status_abbrev": ("status.abbrev", "string"),
    "provider_name": ("launch_service_provider.name", "string"),
    "provider_type": ("launch_service_provider.type", "string"),
    "rocket_name": ("rocket.configuration.name", "string"),
    "rocket_family": ("rocket.configuration.family", "string"),
    "mission_type": ("mission.type", "string"),
    "mission_orbit": ("mission.orbit.name", "string"),
    "orbit_abbrev": ("mission.orbit.abbrev", "string"),
    "pad_country_code": ("pad.country_code", "string"),
    "location_name": ("pad.location.name", "string"),
    "pad_latitude": ("pad.latitude", "double"),
    "pad_longitude": ("pad.longitude", "double"),
}
