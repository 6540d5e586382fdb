"""Constants, column lists and run settings that results depend on."""

# Unit conversion.
KELVIN_OFFSET = 273.15
KNOTS_PER_MS = 1.94384
MM_PER_M = 1000.0

# Label rule and risk score.
WIND_LIMIT_KTS = 25.0
PRECIP_LIMIT_MM = 10.0
WIND_SCALE = 25.0
PRECIP_SCALE = 10.0
CAPE_SCALE = 1000.0
FALLBACK_QUANTILE = 0.75
FALLBACK_ERROR = 0.01
RULE_SOURCE = "WEATHER_RULE"
FALLBACK_SOURCE = "PR2_QUANTILE_FALLBACK"

# Rolling features look at the current row and the two before it.
ROLLING_ROWS = 3
ROLLING_FEATURES = (
    ("wind_speed_max_3h", "max", "wind_speed_kts"),
    ("wind_speed_avg_3h", "avg", "wind_speed_kts"),
    ("precipitation_sum_3h", "sum", "precipitation_mm"),
    ("cape_avg_3h", "avg", "cape_j_kg"),
)

# Archive variable names and the names events use for them.
ARCHIVE_NAMES = {
    "time": "timestamp_utc",
    "2m_temperature": "temperature_k",
    "10m_u_component_of_wind": "wind_u_ms",
    "10m_v_component_of_wind": "wind_v_ms",
    "total_precipitation": "precipitation_m",
    "surface_pressure": "surface_pressure_pa",
    "convective_available_potential_energy": "cape_j_kg",
}
ARCHIVE_VARIABLES = tuple(name for name in ARCHIVE_NAMES if name != "time")

# Delivery.
TOPIC = "weather.raw"
UNKNOWN_KEY = "UNKNOWN"
FLUSH_ROWS = 10
REQUIRED_KEYS = ("event_id", "airport", "timestamp_utc")

EVENT_COLUMNS = (
    "event_id",
    "airport",
    "timestamp_utc",
    "latitude",
    "longitude",
    "temperature_k",
    "temperature_c",
    "wind_u_ms",
    "wind_v_ms",
    "wind_speed_ms",
    "wind_speed_kts",
    "precipitation_m",
    "precipitation_mm",
    "surface_pressure_pa",
    "cape_j_kg",
)
DELIVERY_COLUMNS = ("_kafka_topic", "_kafka_partition", "_kafka_offset", "_ingested_at_utc")
STORED_COLUMNS = (
    "event_id",
    "airport",
    "timestamp_utc",
    "temperature_c",
    "wind_speed_kts",
    "precipitation_mm",
    "surface_pressure_pa",
    "cape_j_kg",
    *DELIVERY_COLUMNS,
)
BRONZE_MEASURES = (
    "latitude",
    "longitude",
    "temperature_c",
    "wind_speed_kts",
    "precipitation_mm",
    "surface_pressure_pa",
    "cape_j_kg",
)
BRONZE_COLUMNS = (
    "event_id",
    "airport",
    "timestamp_utc",
    "event_date",
    *BRONZE_MEASURES,
    *DELIVERY_COLUMNS,
    "_source_object",
)
FEATURE_COLUMNS = (
    "temperature_c",
    "wind_speed_kts",
    "wind_speed_max_3h",
    "wind_speed_avg_3h",
    "precipitation_mm",
    "precipitation_sum_3h",
    "surface_pressure_pa",
    "cape_j_kg",
    "cape_avg_3h",
    "hour_of_day",
    "day_of_week",
    "month",
)
GOLD_COLUMNS = ("event_id", "airport", "timestamp_utc", *FEATURE_COLUMNS, "label", "label_source")

# Model settings.
SPLIT_TRAIN_PERCENT = 80
MODEL_SEED = 42
EXPERIMENTS = (
    {"run_name": "rf_trees_5_depth_3", "model_type": "random_forest", "numTrees": 5, "maxDepth": 3},
    {"run_name": "rf_trees_10_depth_3", "model_type": "random_forest", "numTrees": 10, "maxDepth": 3},
    {"run_name": "rf_trees_20_depth_5", "model_type": "random_forest", "numTrees": 20, "maxDepth": 5},
    {"run_name": "rf_trees_30_depth_5", "model_type": "random_forest", "numTrees": 30, "maxDepth": 5},
    {
        "run_name": "logistic_regression_baseline",
        "model_type": "logistic_regression",
        "maxIter": 20,
        "regParam": 0.01,
    },
)
FINAL_FOREST = EXPERIMENTS[2]

# Stations: only JFK is given; the other two are for tests.
STATIONS = (
    ("JFK", "John F. Kennedy International Airport", 40.6413, -73.7781),
    ("LAX", "Los Angeles International Airport", 33.9416, -118.4085),
    ("ORD", "O'Hare International Airport", 41.9742, -87.9073),
)
