"""Staging models (T-1 ... T-7): raw all-text tables -> typed, cleaned frames.

Each model is a single projection + filter over its source, so at scale it
is one map-only stage fused with the scan; Catalyst inlines it into the
models that read it (as inlined SQL views would be). Dirty text goes
through ``try_cast`` (ANSI mode would fail the job on a bad row).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import (
    alias_value, aqi_category, disaster_type, parse_local_time, severity_level, station_city,
)


def text_to_timestamp(c: str | Column, keep_wall_clock: bool = True) -> Column:
    """ISO text -> timestamp. With ``keep_wall_clock`` a zone offset in the
    text is ignored (a SQL ``timestamp`` without zone), else the instant is
    converted to the session zone."""
    x = F.col(c) if isinstance(c, str) else c
    if keep_wall_clock:
        return x.try_cast("timestamp_ntz").cast("timestamp")
    return x.try_cast("timestamp")


def _num(c: str, p: int, s: int) -> Column:
    return F.col(c).try_cast(f"decimal({p},{s})")


def stg_air_quality(df: DataFrame, city_aliases: Mapping[str, str] = rules.CITY_ALIASES) -> DataFrame:
    """T-1: typed readings, canonical city, lower-case code, value >= 0."""
    value = _num("value", 12, 4)
    return (df.filter(F.col("value").isNotNull() & (value >= 0))
              .select(F.col("location_id").try_cast("int").alias("station_id"),
                      F.coalesce(F.col("location_name"), F.lit("Unknown")).alias("station_name"),
                      alias_value("city", city_aliases).alias("city"),
                      _num("latitude", 10, 6).alias("latitude"),
                      _num("longitude", 10, 6).alias("longitude"),
                      F.lower(F.trim(F.col("parameter"))).alias("pollutant_code"),
                      value.alias("measurement_value"),
                      F.coalesce(F.col("unit"), F.lit("µg/m³")).alias("unit"),
                      text_to_timestamp("last_updated").alias("measured_at_utc"),
                      text_to_timestamp("_extracted_at").alias("ingested_at")))


def stg_weather(df: DataFrame, t_lo: float = -10, t_hi: float = 50) -> DataFrame:
    """T-2: typed hourly weather; temperature outliers dropped."""
    temp = _num("temperature_2m", 6, 2)
    return (df.filter(F.col("time").isNotNull() & temp.between(t_lo, t_hi))
              .select(F.coalesce(F.col("city"), F.lit("Unknown")).alias("city_name"),
                      _num("latitude", 10, 6).alias("latitude"),
                      _num("longitude", 10, 6).alias("longitude"),
                      text_to_timestamp("time").alias("observed_at"),
                      temp.alias("temperature_celsius"),
                      _num("relative_humidity_2m", 5, 2).alias("humidity_percent"),
                      F.coalesce(_num("precipitation", 8, 2), F.lit(0).cast("decimal(8,2)")).alias("precipitation_mm"),
                      _num("wind_speed_10m", 6, 2).alias("wind_speed_kmh"),
                      _num("wind_direction_10m", 5, 1).alias("wind_direction_deg"),
                      F.coalesce(_num("uv_index", 4, 1), F.lit(0).cast("decimal(4,1)")).alias("uv_index"),
                      _num("surface_pressure", 8, 2).alias("surface_pressure_hpa"),
                      text_to_timestamp("_extracted_at").alias("ingested_at")))


def stg_flood(df: DataFrame) -> DataFrame:
    """T-3: typed daily river discharge; negative discharge dropped."""
    discharge = _num("river_discharge", 12, 2)
    return (df.filter(F.col("time").isNotNull() & (discharge >= 0))
              .select(F.coalesce(F.col("river_name"), F.lit("Unknown")).alias("river_name"),
                      _num("latitude", 10, 6).alias("latitude"),
                      _num("longitude", 10, 6).alias("longitude"),
                      text_to_timestamp("time").alias("observed_at"),
                      discharge.alias("discharge_m3s"),
                      text_to_timestamp("_extracted_at").alias("ingested_at")))


def stg_cem_aqi(df: DataFrame, category_rules: Sequence[tuple] = rules.AQI_CATEGORY_RULES,
                city_rules: Sequence[tuple] = rules.STATION_CITY_RULES) -> DataFrame:
    """T-4: official index rows: city from station name, category code,
    bulletin time parsed from ``HH:mm dd/MM/yyyy`` anywhere in the text.

    The index arrives as float text ('45.0'), so it is rounded through a
    decimal before becoming an integer.
    """
    return (df.filter(F.col("aqi_value").isNotNull())
              .select(F.coalesce(F.trim(F.col("station_name")), F.lit("Unknown")).alias("station_name"),
                      station_city("station_name", city_rules).alias("city_name"),
                      F.round(_num("aqi_value", 12, 4), 0).cast("int").alias("aqi_value"),
                      aqi_category("category", category_rules).alias("aqi_category"),
                      F.coalesce(F.trim(F.col("category")), F.lit("Unknown")).alias("aqi_category_vi"),
                      parse_local_time("published_time").alias("measured_at"),
                      text_to_timestamp("_crawled_at").alias("ingested_at")))


def stg_nchmf_disaster(df: DataFrame, type_rules: Sequence[tuple] = rules.DISASTER_TYPE_RULES,
                       severity_rules: Sequence[tuple] = rules.SEVERITY_RULES) -> DataFrame:
    """T-5: bulletins with hazard type and severity from keyword rules."""
    return (df.filter(F.col("title").isNotNull() & (F.col("title") != "N/A"))
              .select(F.coalesce(F.trim(F.col("title")), F.lit("No Title")).alias("title"),
                      F.coalesce(F.trim(F.col("summary")), F.lit("No Summary")).alias("summary"),
                      F.coalesce(F.col("detail_url"), F.lit("N/A")).alias("detail_url"),
                      disaster_type("title", "summary", type_rules).alias("disaster_type"),
                      severity_level("title", severity_rules).alias("severity_level"),
                      parse_local_time("publish_date").alias("published_at"),
                      text_to_timestamp("_crawled_at").alias("ingested_at")))


def stg_fire_hotspot(df: DataFrame) -> DataFrame:
    """T-6: typed fire detections; rows without coordinates dropped."""
    return (df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
              .select(_num("latitude", 10, 6).alias("latitude"),
                      _num("longitude", 10, 6).alias("longitude"),
                      _num("bright_ti4", 8, 2).alias("brightness_kelvin"),
                      _num("scan", 4, 2).alias("scan_km"),
                      _num("track", 4, 2).alias("track_km"),
                      _num("frp", 10, 2).alias("fire_radiative_power_mw"),
                      F.coalesce(F.col("satellite"), F.lit("Unknown")).alias("satellite"),
                      F.coalesce(F.col("instrument"), F.lit("Unknown")).alias("instrument"),
                      F.col("confidence").alias("confidence_level"),
                      F.coalesce(F.col("daynight"), F.lit("D")).alias("daynight"),
                      F.col("acq_date").try_cast("date").alias("detection_date"),
                      F.lpad(F.col("acq_time").cast("string"), 4, "0").alias("detection_time_hhmm"),
                      text_to_timestamp("_extracted_at").alias("ingested_at")))


def stg_geo_features(df: DataFrame) -> DataFrame:
    """T-7: named map features."""
    return (df.filter(F.col("name").isNotNull() & (F.trim(F.col("name")) != "")
                      & F.col("latitude").isNotNull())
              .select(F.col("node_id").try_cast("bigint").alias("osm_id"),
                      F.coalesce(F.trim(F.col("name")), F.lit("Unnamed")).alias("feature_name"),
                      F.lower(F.trim(F.col("amenity_type"))).alias("feature_type"),
                      _num("latitude", 10, 6).alias("latitude"),
                      _num("longitude", 10, 6).alias("longitude"),
                      text_to_timestamp("_extracted_at").alias("ingested_at")))
