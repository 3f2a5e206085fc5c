"""Rule data used as default arguments throughout the library.

Every function that applies a rule takes the rule table as an argument;
the values below are only the defaults. Nothing here is code.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the reference behaviour for equal results.
# Stated plainly, in the order the rules apply.
# ---------------------------------------------------------------------------

# City spelling -> canonical city, compared on lower(city); else city as is,
# NULL -> 'Unknown'.
CITY_ALIASES: dict[str, str] = {
    "hanoi": "Hà Nội",
    "ho chi minh city": "Hồ Chí Minh",
    "ho chi minh": "Hồ Chí Minh",
    "da nang": "Đà Nẵng",
    "haiphong": "Hải Phòng",
    "hai phong": "Hải Phòng",
    "can tho": "Cần Thơ",
}
CITY_UNKNOWN = "Unknown"

# Station name -> city by case-sensitive substring, first rule wins; else the
# station name itself.
STATION_CITY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("Hà Nội", "Hanoi"), "Hà Nội"),
    (("Hồ Chí Minh", "HCM"), "Hồ Chí Minh"),
    (("Đà Nẵng",), "Đà Nẵng"),
    (("Hải Phòng",), "Hải Phòng"),
    (("Cần Thơ",), "Cần Thơ"),
]

# Category text (lower, trimmed) -> code by substring, in the reference's
# order. With this order 'very_unhealthy' can never be reached.
AQI_CATEGORY_RULES_LITERAL: list[tuple[tuple[str, ...], str]] = [
    (("tốt",), "good"),
    (("trung bình",), "moderate"),
    (("kém",), "unhealthy_sg"),
    (("xấu",), "unhealthy"),
    (("rất xấu",), "very_unhealthy"),
    (("nguy hại",), "hazardous"),
]
# Default: the longer 'rất xấu' is tested before 'xấu'.
AQI_CATEGORY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("tốt",), "good"),
    (("trung bình",), "moderate"),
    (("kém",), "unhealthy_sg"),
    (("rất xấu",), "very_unhealthy"),
    (("xấu",), "unhealthy"),
    (("nguy hại",), "hazardous"),
]
AQI_CATEGORY_DEFAULT = "unknown"

# Hazard type from bulletin text: (keywords, fields searched, code).
# Fields are 'title' and/or 'summary', both lower-cased; first rule wins.
DISASTER_TYPE_RULES: list[tuple[tuple[str, ...], tuple[str, ...], str]] = [
    (("bão",), ("title", "summary"), "storm"),
    (("lũ",), ("title", "summary"), "flood"),
    (("sạt lở",), ("title", "summary"), "landslide"),
    (("động đất",), ("title", "summary"), "earthquake"),
    (("hạn hán",), ("title", "summary"), "drought"),
    (("triều cường",), ("title", "summary"), "high_tide"),
    (("rét",), ("title",), "cold_wave"),
    (("nắng nóng",), ("title",), "heatwave"),
    (("giông", "lốc"), ("title",), "thunderstorm"),
]
DISASTER_TYPE_DEFAULT = "other"

# Severity from the lower-cased title; first rule wins.
SEVERITY_RULES: list[tuple[tuple[str, ...], str]] = [
    (("khẩn cấp", "rất mạnh"), "extreme"),
    (("cảnh báo", "mạnh"), "high"),
]
SEVERITY_DEFAULT = "normal"

# Severity score weights as the reference's scorer states them (these level
# names never occur in staged data, so every score is 0 there).
SEVERITY_WEIGHTS_LITERAL: dict[str, int] = {"critical": 4, "warning": 3, "watch": 2, "info": 1}
# Alternative weights that match the staged level names.
SEVERITY_WEIGHTS_STAGED: dict[str, int] = {"extreme": 4, "high": 3, "normal": 1}

# Ordered cut lists: (operator, bound, label); first true rule wins.
IMPACT_CUTS = [(">=", 12, "extreme"), (">=", 8, "high"), (">=", 4, "moderate")]
IMPACT_DEFAULT = "low"

RISK_LEVEL_CUTS = [(">=", 70, "critical"), (">=", 50, "high"), (">=", 25, "moderate")]
RISK_LEVEL_DEFAULT = "low"

PM25_CATEGORY_CUTS = [
    ("<=", 12, "good"),
    ("<=", 35.4, "moderate"),
    ("<=", 55.4, "unhealthy_sg"),
    ("<=", 150.4, "unhealthy"),
    ("<=", 250.4, "very_unhealthy"),
]
PM25_CATEGORY_DEFAULT = "hazardous"

COMFORT_CUTS = [("<", 15, "cold"), ("<", 25, "comfortable"), ("<", 33, "warm"), ("<", 40, "hot")]
COMFORT_DEFAULT = "extreme_heat"

RAIN_CUTS = [("=", 0, "none"), ("<", 2.5, "light"), ("<", 7.6, "moderate"), ("<", 50, "heavy")]
RAIN_DEFAULT = "extreme"

DAY_LABEL_CUTS = [
    ("<=", 50, "Good"),
    ("<=", 100, "Moderate"),
    ("<=", 150, "Sensitive"),
    ("<=", 200, "Unhealthy"),
    ("<=", 300, "Very Unhealthy"),
]
DAY_LABEL_DEFAULT = "Hazardous"

MONTH_TIER_CUTS = [(">=", 50, "High"), (">=", 20, "Medium")]
MONTH_TIER_DEFAULT = "Low"
UNHEALTHY_DAY_THRESHOLD = 100

# AQI sub-index breakpoints: pollutant -> [(upper concentration bound,
# concentration low, concentration high, index low, index span)].
# Segment 1 is value / high * span; later segments are
# index_low + (value - c_low) / (c_high - c_low) * span. Above the last
# bound the index is 500; pollutants not listed use least(int(value), 500).
AQI_BREAKPOINTS: dict[str, list[tuple[float, float, float, int, int]]] = {
    "pm25": [
        (12.0, 0.0, 12.0, 0, 50),
        (35.4, 12.1, 35.4, 50, 50),
        (55.4, 35.5, 55.4, 100, 50),
        (150.4, 55.5, 150.4, 150, 50),
        (250.4, 150.5, 250.4, 200, 100),
        (500.4, 250.5, 500.4, 300, 200),
    ],
    "pm10": [
        (54, 0, 54.0, 0, 50),
        (154, 55, 154.0, 50, 50),
        (254, 155, 254.0, 100, 50),
        (354, 255, 354.0, 150, 50),
        (424, 355, 424.0, 200, 100),
        (604, 425, 604.0, 300, 200),
    ],
    "o3": [
        (54, 0, 54.0, 0, 50),
        (70, 55, 70.0, 50, 50),
        (85, 71, 85.0, 100, 50),
        (105, 86, 105.0, 150, 50),
        (200, 106, 200.0, 200, 100),
    ],
}
AQI_ABOVE_LAST = 500
AQI_CAP = 500

# Composite risk: aqi/500*40 (cap 40) + flow/5000*30 (cap 30) + fires*3 (cap 30), cap 100.
RISK_AQI_SCALE, RISK_AQI_CAP = 500.0, 40
RISK_FLOW_SCALE, RISK_FLOW_CAP = 5000.0, 30
RISK_FIRE_POINTS, RISK_FIRE_CAP = 3, 30
RISK_TOTAL_CAP = 100
# Intermediate AQI component: official AQI / 500 * 40, else pm25 / 250 * 40.
RISK_PM25_SCALE = 250.0

# Heat index (simplified, used when temperature > 27): a + b*T + c*H + d*T*H
HEAT_INDEX_COEFFS = (-8.785, 1.611, 2.339, -0.1461)
HEAT_INDEX_MIN_TEMP = 27

# Physical bounds per measurement code (lo, hi); outside -> NULL.
# 'pm25' is added next to the reference key 'pm2_5' so feed codes match.
MEASUREMENT_BOUNDS: dict[str, tuple[float, float]] = {
    "pm2_5": (0.0, 1000.0),
    "pm10": (0.0, 1000.0),
    "aqi": (0.0, 500.0),
    "temperature": (-10.0, 50.0),
    "humidity": (0.0, 100.0),
    "river_discharge": (0.0, 100_000.0),
    "pm25": (0.0, 1000.0),
}
CLEANING_KEY_COLUMNS = ["station_code", "pollutant", "measurement_value"]
CLEANING_TEXT_COLUMNS = ["station_code", "station_name", "pollutant", "city_name", "source_name"]
SOURCE_TIMEZONE = "Asia/Ho_Chi_Minh"

# Stream contract.
VALID_POLLUTANTS = ["pm25", "pm10", "o3", "no2", "so2", "co"]
# field -> accepted JSON kinds ('int' = integral number, 'number' = int or
# decimal/float, 'string'). Booleans are never numbers.
REQUIRED_FIELDS: list[tuple[str, str]] = [
    ("location_id", "int"),
    ("location_name", "string"),
    ("city", "string"),
    ("latitude", "number"),
    ("longitude", "number"),
    ("parameter", "string"),
    ("value", "number"),
    ("date_utc", "string"),
]
# (lat_min, lat_max, lon_min, lon_max), inclusive.
VIETNAM_BOX = (8.0, 24.0, 102.0, 110.0)
QUERY_BOX = (8.18, 23.39, 102.14, 109.46)
MESSAGE_DEFAULTS = {"country": "VN", "unit": "µg/m³", "source": "openaq"}

# River readings' point names that differ from the seed key
# 'river (monitoring point)', and monitoring points that differ from the
# province names of the city seed.
RIVER_NAME_ALIASES: dict[str, str] = {"Sông Sài Gòn (HCM)": "Sông Sài Gòn (Hồ Chí Minh)"}
RIVER_POINT_CITY_ALIASES: dict[str, str] = {"Huế": "Thừa Thiên Huế"}

# Declared model tests: (model, column, test, argument). Tests: not_null,
# unique, accepted_values (argument: the values), accepted_range (argument:
# (min, max), either may be None).
MODEL_TESTS: list[tuple[str, str, str, object]] = [
    ("int_daily_aqi_city", "city_name", "not_null", None),
    ("int_daily_aqi_city", "measurement_date", "not_null", None),
    ("int_weather_hourly", "city_name", "not_null", None),
    ("int_weather_hourly", "observed_at", "not_null", None),
    ("int_weather_hourly", "comfort_level", "accepted_values", ("cold", "comfortable", "warm", "hot", "extreme_heat")),
    ("int_disaster_impact", "event_date", "not_null", None),
    ("int_disaster_impact", "disaster_type", "not_null", None),
    ("int_disaster_impact", "impact_level", "accepted_values", ("low", "moderate", "high", "extreme")),
    ("int_environmental_risk", "risk_date", "not_null", None),
    ("int_environmental_risk", "composite_risk_score", "accepted_range", (0, 100)),
    ("int_environmental_risk", "risk_level", "accepted_values", ("low", "moderate", "high", "critical")),
    ("dim_location", "location_sk", "not_null", None),
    ("dim_location", "location_sk", "unique", None),
    ("dim_location", "location_code", "not_null", None),
    ("dim_location", "location_code", "unique", None),
    ("dim_time", "date_key", "not_null", None),
    ("dim_time", "date_key", "unique", None),
    ("dim_pollutant", "pollutant_sk", "not_null", None),
    ("dim_pollutant", "pollutant_sk", "unique", None),
    ("dim_pollutant", "pollutant_code", "not_null", None),
    ("dim_pollutant", "pollutant_code", "unique", None),
    ("dim_station", "station_sk", "not_null", None),
    ("dim_station", "station_sk", "unique", None),
    ("dim_station", "station_id", "not_null", None),
    ("dim_station", "station_id", "unique", None),
    ("dim_disaster_type", "disaster_type_sk", "not_null", None),
    ("dim_disaster_type", "disaster_type_sk", "unique", None),
    ("dim_disaster_type", "disaster_code", "not_null", None),
    ("dim_disaster_type", "disaster_code", "unique", None),
    ("fact_air_measurements", "station_sk", "not_null", None),
    ("fact_air_measurements", "pollutant_sk", "not_null", None),
    ("fact_air_measurements", "measurement_value", "not_null", None),
    ("fact_air_measurements", "measurement_value", "accepted_range", (0, None)),
    ("fact_weather_observations", "date_key", "not_null", None),
    ("fact_weather_observations", "city_name", "not_null", None),
    ("fact_natural_disasters", "disaster_event_sk", "not_null", None),
    ("fact_natural_disasters", "disaster_event_sk", "unique", None),
    ("fact_natural_disasters", "date_key", "not_null", None),
    ("stg_air_quality", "station_id", "not_null", None),
    ("stg_air_quality", "pollutant_code", "not_null", None),
    ("stg_air_quality", "measurement_value", "not_null", None),
    ("stg_air_quality", "measurement_value", "accepted_range", (0, None)),
    ("stg_weather", "city_name", "not_null", None),
    ("stg_weather", "observed_at", "not_null", None),
    ("stg_weather", "temperature_celsius", "accepted_range", (-10, 55)),
    ("stg_flood", "river_name", "not_null", None),
    ("stg_flood", "discharge_m3s", "not_null", None),
    ("stg_flood", "discharge_m3s", "accepted_range", (0, 100000)),
    ("stg_cem_aqi", "station_name", "not_null", None),
    ("stg_cem_aqi", "aqi_value", "accepted_range", (0, 500)),
    ("stg_nchmf_disaster", "title", "not_null", None),
    ("stg_nchmf_disaster", "disaster_type", "not_null", None),
    ("stg_nchmf_disaster", "disaster_type", "accepted_values",
     ("storm", "flood", "landslide", "earthquake", "drought", "high_tide", "cold_wave", "heatwave", "thunderstorm",
      "other")),
    ("stg_fire_hotspot", "latitude", "not_null", None),
    ("stg_fire_hotspot", "longitude", "not_null", None),
    ("stg_fire_hotspot", "brightness_kelvin", "accepted_range", (200, 600)),
    ("stg_geo_features", "osm_id", "not_null", None),
    ("stg_geo_features", "osm_id", "unique", None),
    ("stg_geo_features", "feature_name", "not_null", None),
]

# Fire confidence classes kept for the fire component.
FIRE_CONFIDENCE = ["high", "nominal", "h", "n"]

# Date dimension labels.
MONTH_NAMES_VI = [
    "Tháng 1", "Tháng 2", "Tháng 3", "Tháng 4", "Tháng 5", "Tháng 6",
    "Tháng 7", "Tháng 8", "Tháng 9", "Tháng 10", "Tháng 11", "Tháng 12",
]
SEASONS_VI = [((3, 4, 5), "Xuân"), ((6, 7, 8), "Hè"), ((9, 10, 11), "Thu")]
SEASON_DEFAULT_VI = "Đông"
WEEKEND_DOW = (0, 6)  # Sunday = 0
DIM_TIME_START = "2024-01-01"
DIM_TIME_END_EXCLUSIVE = "2027-01-01"

# Disaster type dimension rows: code, English name, Vietnamese name, category.
DISASTER_TYPES: list[tuple[str, str, str, str]] = [
    ("storm", "Tropical Storm/Typhoon", "Bão", "meteorological"),
    ("flood", "Flood", "Lũ lụt", "hydrological"),
    ("landslide", "Landslide", "Sạt lở đất", "geophysical"),
    ("earthquake", "Earthquake", "Động đất", "geophysical"),
    ("drought", "Drought", "Hạn hán", "climatological"),
    ("high_tide", "High Tide/Storm Surge", "Triều cường", "hydrological"),
    ("cold_wave", "Cold Wave", "Rét đậm/rét hại", "meteorological"),
    ("heatwave", "Heatwave", "Nắng nóng", "meteorological"),
    ("thunderstorm", "Thunderstorm", "Giông bão", "meteorological"),
    ("other", "Other", "Khác", "other"),
]

# Surrogate key null marker and separator (public dbt-utils 1.x form).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"

# Bulletin time pattern and its parse format.
LOCAL_TIME_REGEX = r"\d{2}:\d{2} \d{2}/\d{2}/\d{4}"
LOCAL_TIME_FORMAT = "HH:mm dd/MM/yyyy"

# HTML layouts: table rows need this many cells; header rows carry these words.
HTML_MIN_CELLS = 4
HTML_HEADER_WORDS = ("Trạm", "Station")
HTML_NUMERIC_REGEX = r"^\d*\.?\d*$"

# Freshness check window (hours).
FRESHNESS_HOURS = 25

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------
