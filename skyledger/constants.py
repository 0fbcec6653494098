"""Names, labels and numbers that results must reproduce as they are."""

from __future__ import annotations

# --- Fixed values: landing file names --------------------------------------
LAUNCHES_FILE = "launch_library_launches.jsonl"
WEATHER_FILE = "open_meteo_samples.jsonl"
ROCKETS_FILE = "spacex_rockets.json"
CATALOGUE_IMAGES_FILE = "launch_library_images.jsonl"
VENDOR_IMAGES_FILE = "spacex_launches_images.jsonl"
PAYLOADS_FILE = "spacex_payloads.json"
CORES_FILE = "spacex_cores.json"
SHIPS_FILE = "spacex_ships.json"
MANIFEST_FILE = "manifest.json"
RUN_ID_FORMAT = "%Y%m%d_%H%M%S"

# --- Fixed values: image source names --------------------------------------
CATALOGUE_SOURCE = "launch_library"
VENDOR_SOURCE = "spacex"

# --- Fixed values: estimated launch costs -----------------------------------
# rocket, cost per launch (USD), cost per kg to low orbit (USD), category
ROCKET_COSTS = [
    ("Falcon 9", 62_000_000, 2_720, "Standard"),
    ("Falcon Heavy", 90_000_000, 1_410, "Heavy"),
    ("Starship", 10_000_000, 100, "Heavy"),
    ("Falcon 1", 7_000_000, 4_109, "Budget"),
    ("Ariane 5", 165_000_000, 10_500, "Premium"),
    ("Ariane 6", 75_000_000, 4_500, "Standard"),
    ("Atlas V", 130_000_000, 8_000, "Premium"),
    ("Delta IV Heavy", 350_000_000, 13_000, "Premium"),
    ("Vulcan Centaur", 110_000_000, 5_600, "Standard"),
    ("Soyuz-2", 55_000_000, 7_000, "Standard"),
    ("Proton-M", 65_000_000, 4_600, "Standard"),
    ("PSLV", 15_000_000, 1_500, "Budget"),
    ("GSLV", 45_000_000, 2_500, "Standard"),
    ("GSLV Mk III", 48_000_000, 2_600, "Standard"),
    ("H-IIA", 90_000_000, 8_400, "Premium"),
    ("H3", 50_000_000, 5_500, "Standard"),
    ("Long March 2D", 30_000_000, 2_000, "Budget"),
    ("Long March 3B", 55_000_000, 5_000, "Standard"),
    ("Long March 5", 70_000_000, 2_500, "Standard"),
    ("Electron", 7_500_000, 35_714, "Budget"),
    ("Antares", 85_000_000, 8_000, "Standard"),
    ("Pegasus", 40_000_000, 75_000, "Budget"),
    ("New Glenn", 60_000_000, 2_500, "Standard"),
    ("Vega", 37_000_000, 3_600, "Budget"),
    ("Vega-C", 42_000_000, 3_000, "Budget"),
]
DEFAULT_COST_USD = 50_000_000
DEFAULT_COST_PER_KG_USD = 5_000
DEFAULT_COST_CATEGORY = "Standard"

# --- Fixed values: mission profile rules, first match wins -------------------
# keywords looked for in the lower-cased launch name, mission type, orbit
MISSION_RULES = [
    (("starlink",), "Satellite Deployment", "LEO"),
    (("crew", "dragon"), "Crewed Mission", "LEO"),
    (("crs", "cargo"), "Cargo Resupply", "LEO"),
    (("transport",), "Ride Share", "LEO"),
    (("starship", "booster"), "Test Flight", "Suborbital"),
    (("gps", "nrol", "military"), "Government Payload", "MEO"),
    (("planet", "eutelsat", "intelsat", "communications"), "Communications", "GTO"),
]
EVERY_FIFTH_PROFILE = ("Technology Demonstration", "LEO")
DEFAULT_PROFILE = ("Orbital Launch", "LEO")

# --- Fixed values: synthetic launch records ----------------------------------
SYNTHETIC_PROVIDER_ID = 121
SYNTHETIC_PROVIDER_NAME = "SpaceX"
SYNTHETIC_SEED_NAME = "Synthetic Launch"
SYNTHETIC_PAD_NAME = "SpaceX Launch Site"
SYNTHETIC_PAD_COUNTRY = "US"
SYNTHETIC_PAD_LATITUDE = 25.997
SYNTHETIC_PAD_LONGITUDE = -97.155
SYNTHETIC_ROCKET_FAMILY = "Falcon"
SYNTHETIC_SUCCESS_STATUS = (3, "Launch Successful", "Success")
SYNTHETIC_FAILURE_STATUS = (4, "Launch Failure", "Failure")
SYNTHETIC_ID_MINIMUM = 2_000
SYNTHETIC_ID_SPAN = 800_000

# --- Fixed values: success score ---------------------------------------------
DEFAULT_BASE_RATE = 0.82
PROBABILITY_BANDS = [
    (80, "Condiciones óptimas para el lanzamiento"),
    (60, "Condiciones aceptables — proceder con precaución"),
    (40, "Condiciones desfavorables — riesgo elevado"),
]
LOWEST_PROBABILITY_BAND = "Condiciones peligrosas — lanzamiento no recomendado"

# --- Fixed values: labels ------------------------------------------------------
SUCCESS_LABEL = "Éxito"
FAILURE_LABEL = "Fallo"
UNKNOWN_LABEL = "Desconocido"
OTHERS_LABEL = "Otros"
MISSING_MARK = "—"
NOT_AVAILABLE = "N/D"

EXPLORER_HEADINGS = {
    "launch_name": "Misión",
    "launch_year": "Año",
    "provider_name": "Agencia",
    "rocket_name": "Cohete",
    "mission_type": "Tipo Misión",
    "mission_orbit": "Órbita",
    "pad_country_code": "País",
    "is_success": "Resultado",
    "temperature_2m_mean": "Temp (°C)",
    "wind_speed_10m_max": "Viento (km/h)",
    "launch_image_count": "Imágenes",
}
EXPLORER_RESULTS = ("✓ Éxito", "✗ Fallo", "?")

ROCKET_SPEC_HEADINGS = {
    "rocket_name": "Cohete",
    "height_meters": "Altura (m)",
    "diameter_meters": "Diámetro (m)",
    "mass_kg": "Masa (kg)",
    "cost_per_launch_usd": "Costo ($)",
    "success_rate_pct": "Éxito (%)",
    "first_flight_date": "Primer Vuelo",
    "stages": "Etapas",
    "boosters": "Boosters",
    "is_active": "Activo",
}
PROVIDER_TABLE_HEADINGS = {
    "provider_name": "Agencia",
    "total": "Lanzamientos",
    "success": "Exitosos",
    "rate": "Tasa Éxito",
}
