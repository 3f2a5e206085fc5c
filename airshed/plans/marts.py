"""Marts (T-12 ... T-19): dimensions and facts of the star schema.

Dimensions from seeds and rule tables are fixed-size and broadcast into
the facts; facts are map-only projections of staged data (no shuffle)
except the DISTINCT station dimension (one shuffle on its columns, with
map-side dedup first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import bucketize, surrogate_key
from airshed.operators.aggregates import distinct_dim
from airshed.operators.joins import join_dim, stack
from airshed.plans.intermediate import river_station_key
from airshed.sources.readers import date_spine, inline_table

DISASTER_TYPE_SCHEMA = "disaster_code string, disaster_name_en string, disaster_name_vi string, category string"


def dim_location(cities: DataFrame, rivers: DataFrame) -> DataFrame:
    """T-12: provinces UNION ALL river stations, keyed by md5(code)."""
    c = cities.select(F.col("city_code").alias("location_code"), F.col("city_name").alias("location_name"),
                      "latitude", "longitude", "region", F.lit("province").alias("location_type"))
    r = rivers.select(F.col("river_id").alias("location_code"), river_station_key(rivers).alias("location_name"),
                      "latitude", "longitude", F.col("basin").alias("region"),
                      F.lit("river_station").alias("location_type"))
    both = stack(c, r)
    return both.select(surrogate_key("location_code").alias("location_sk"), *both.columns)


def dim_time(spark: SparkSession, start: str = rules.DIM_TIME_START,
             end_exclusive: str = rules.DIM_TIME_END_EXCLUSIVE) -> DataFrame:
    """T-13: one row per day in [start, end)."""
    return enrich_dates(date_spine(spark, start, end_exclusive), "date_day")


def enrich_dates(df: DataFrame, day_col: str) -> DataFrame:
    d = F.col(day_col).cast("date")
    month = F.month(d)
    month_name = F.element_at(F.array(*[F.lit(m) for m in rules.MONTH_NAMES_VI]), month)
    season = None
    for months, label in rules.SEASONS_VI:
        cond = month.isin(list(months))
        season = F.when(cond, label) if season is None else season.when(cond, label)
    season = season.otherwise(rules.SEASON_DEFAULT_VI)
    dow = F.dayofweek(d) - 1  # Sunday = 0
    return df.select(
        d.alias("date_key"), F.year(d).alias("year"), F.quarter(d).alias("quarter"), month.alias("month"),
        F.weekofyear(d).alias("week_of_year"), dow.alias("day_of_week"), F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"), month_name.alias("month_name_vi"), season.alias("season_vi"),
        dow.isin(list(rules.WEEKEND_DOW)).alias("is_weekend"))


def dim_pollutant(standards: DataFrame) -> DataFrame:
    """T-14: pollutant standards keyed by md5(code)."""
    return standards.select(surrogate_key("pollutant_code").alias("pollutant_sk"), *standards.columns)


def dim_station(stg_air: DataFrame, country: str = "VN") -> DataFrame:
    """T-15: DISTINCT stations (a renamed or moved station gives two rows,
    as in the reference; the quality pass reports the duplicate id)."""
    st = distinct_dim(stg_air, ["station_id", "station_name", "city", "latitude", "longitude"],
                      not_null=["station_id"])
    return st.select(surrogate_key("station_id").alias("station_sk"), "station_id", "station_name", "city",
                     F.lit(country).alias("country_code"), "latitude", "longitude")


def dim_disaster_type(spark: SparkSession, rows=rules.DISASTER_TYPES) -> DataFrame:
    """T-16: hazard types from the fixed rule table."""
    t = inline_table(spark, rows, DISASTER_TYPE_SCHEMA)
    return t.select(surrogate_key("disaster_code").alias("disaster_type_sk"), *t.columns)


def fact_air_measurements(stg_air: DataFrame) -> DataFrame:
    """T-17: one row per station x pollutant x time, PM2.5 category."""
    cat = F.when(F.col("pollutant_code") == "pm25",
                 bucketize("measurement_value", rules.PM25_CATEGORY_CUTS, rules.PM25_CATEGORY_DEFAULT))
    return stg_air.select(
        surrogate_key("station_id").alias("station_sk"),
        surrogate_key("pollutant_code").alias("pollutant_sk"),
        F.to_date(F.date_trunc("day", "measured_at_utc")).alias("date_key"),
        "station_id", "station_name", "city", "latitude", "longitude", "pollutant_code",
        "measurement_value", "unit", cat.alias("pm25_aqi_category"), "measured_at_utc", "ingested_at")


def fact_weather_observations(weather_hourly: DataFrame) -> DataFrame:
    """T-18: hourly weather fact."""
    return weather_hourly.select(
        F.to_date(F.date_trunc("day", "observed_at")).alias("date_key"),
        "city_name", "latitude", "longitude", "observed_at", "observation_date", "observation_hour",
        "temperature_celsius", "humidity_percent", "precipitation_mm", "wind_speed_kmh",
        "wind_direction_deg", "uv_index", "heat_index", "comfort_level", "rain_intensity", "ingested_at")


def fact_natural_disasters(stg_disaster: DataFrame, types: DataFrame) -> DataFrame:
    """T-19: one row per bulletin, enriched from the (fixed, broadcast)
    type dimension by a LEFT join."""
    d = stg_disaster.alias("d")
    joined = join_dim(d, types.alias("dt"), F.col("d.disaster_type") == F.col("dt.disaster_code"),
                      how="left", broadcast=True)
    return joined.select(
        surrogate_key(F.col("d.title"), F.col("d.published_at")).alias("disaster_event_sk"),
        F.col("dt.disaster_type_sk"),
        F.to_date(F.date_trunc("day", F.col("d.published_at"))).alias("date_key"),
        "d.title", "d.summary", "d.detail_url", "d.disaster_type", "d.severity_level",
        "dt.disaster_name_en", "dt.disaster_name_vi", F.col("dt.category").alias("hazard_category"),
        "d.published_at", "d.ingested_at")
