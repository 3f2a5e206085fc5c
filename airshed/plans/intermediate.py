"""Intermediate models (T-8 ... T-11): per-day aggregates, joins, scores.

Every join here is between frames that were aggregated first (per city x
day, per day), so the shuffle carries pre-aggregated rows. Full outer joins
cannot be broadcast; they run as shuffled hash / sort-merge joins on the
(city, day) keys, and AQE coalesces the small partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import (
    aqi_component, bucketize, capped_scaled, heat_index, weight_of,
)
from airshed.operators.aggregates import mode_value
from airshed.operators.joins import full_join_coalesced, join_dim


def int_daily_aqi_city(stg_air: DataFrame, stg_cem: DataFrame) -> DataFrame:
    """T-8: station readings per city x day x pollutant, full-outer joined
    with the official index per city x day (mode of category, ties to the
    smallest code). Grain: (city, date, pollutant)."""
    openaq = (stg_air.groupBy(F.col("city").alias("city_name"),
                              F.date_trunc("day", "measured_at_utc").alias("measurement_date"),
                              "pollutant_code")
                     .agg(F.avg("measurement_value").alias("avg_pollutant_value"),
                          F.min("measurement_value").alias("min_pollutant_value"),
                          F.max("measurement_value").alias("max_pollutant_value"),
                          F.count(F.lit(1)).alias("openaq_readings"),
                          F.avg("latitude").alias("latitude"),
                          F.avg("longitude").alias("longitude")))
    cem = (stg_cem.filter(F.col("measured_at").isNotNull())
                  .groupBy("city_name", F.date_trunc("day", "measured_at").alias("measurement_date"))
                  # numeric average (exact), not a double one
                  .agg(F.avg(F.col("aqi_value").cast("decimal(12,0)")).alias("cem_avg_aqi"),
                       F.min("aqi_value").alias("cem_min_aqi"),
                       F.max("aqi_value").alias("cem_max_aqi"),
                       mode_value("aqi_category").alias("cem_dominant_category"),
                       F.count(F.lit(1)).alias("cem_readings")))
    joined = full_join_coalesced(openaq, cem, ["city_name", "measurement_date"])
    return joined.select("city_name", "measurement_date", "latitude", "longitude", "pollutant_code",
                         "avg_pollutant_value", "min_pollutant_value", "max_pollutant_value",
                         "openaq_readings", "cem_avg_aqi", "cem_min_aqi", "cem_max_aqi",
                         "cem_dominant_category", "cem_readings")


def int_weather_hourly(stg_weather: DataFrame) -> DataFrame:
    """T-9: hourly weather with heat index, comfort and rain classes."""
    t, p = F.col("temperature_celsius"), F.col("precipitation_mm")
    return stg_weather.select(
        "city_name", "latitude", "longitude", "observed_at",
        F.date_trunc("day", "observed_at").alias("observation_date"),
        F.hour("observed_at").alias("observation_hour"),
        "temperature_celsius", "humidity_percent", "precipitation_mm", "wind_speed_kmh",
        "wind_direction_deg", "uv_index",
        heat_index(t, "humidity_percent").alias("heat_index"),
        bucketize(t, rules.COMFORT_CUTS, rules.COMFORT_DEFAULT).alias("comfort_level"),
        bucketize(p, rules.RAIN_CUTS, rules.RAIN_DEFAULT).alias("rain_intensity"),
        "ingested_at")


def int_disaster_impact(stg_disaster: DataFrame,
                        weights: Mapping[str, int] = rules.SEVERITY_WEIGHTS_LITERAL,
                        ts_col: str = "published_at", type_col: str = "disaster_type",
                        severity_col: str = "severity_level") -> DataFrame:
    """T-10: per day x type x severity: count, first/last time, weighted
    score and impact class."""
    ts = F.col(ts_col).cast("timestamp")
    agg = (stg_disaster.groupBy(F.date_trunc("day", ts).alias("event_date"),
                                F.col(type_col).alias("disaster_type"),
                                F.col(severity_col).alias("severity_level"))
                       .agg(F.count(F.lit(1)).alias("alert_count"),
                            F.min(ts).alias("first_alert_at"),
                            F.max(ts).alias("last_alert_at"),
                            F.sum(weight_of(F.col(severity_col), weights)).alias("total_severity_score")))
    return agg.withColumn("impact_level", bucketize("total_severity_score", rules.IMPACT_CUTS,
                                                    rules.IMPACT_DEFAULT))


def river_station_key(rivers: DataFrame) -> F.Column:
    """Feed-side river name of a seed row: ``name (monitoring point)``."""
    return F.concat(F.col("river_name"), F.lit(" ("), F.col("monitoring_point"), F.lit(")"))


def flood_risk(stg_flood: DataFrame, rivers: DataFrame,
               point_aliases: Mapping[str, str] | None = None,
               broadcast_seed: bool = True, seed_key=None,
               river_aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Per day x city: average discharge and its capped 0-30 component.

    The reference seed is a fixed-size table (one row per monitoring point)
    and is broadcast, so readings never shuffle for this join; a station
    table that grows with the data passes ``broadcast_seed=False`` (AQE
    measures it). ``seed_key`` is the seed-side key matched
    against the readings' river name (default ``name (point)``);
    ``river_aliases`` renames readings' river names first (spellings that
    differ from the seed), ``point_aliases`` maps monitoring points to
    province names.
    """
    key = river_station_key(rivers) if seed_key is None else seed_key
    seed = rivers.select(key.alias("_river_key"), F.col("monitoring_point").alias("city_name"))
    if point_aliases:
        lookup = F.create_map(*[F.lit(v) for kv in point_aliases.items() for v in kv])
        seed = seed.withColumn("city_name", F.coalesce(F.element_at(lookup, F.col("city_name")),
                                                       F.col("city_name")))
    if river_aliases:
        names = F.create_map(*[F.lit(v) for kv in river_aliases.items() for v in kv])
        stg_flood = stg_flood.withColumn("river_name", F.coalesce(F.element_at(names, F.col("river_name")),
                                                                  F.col("river_name")))
    prep = join_dim(stg_flood, seed, stg_flood["river_name"] == seed["_river_key"],
                    broadcast=broadcast_seed)
    return (prep.groupBy(F.date_trunc("day", "observed_at").alias("risk_date"), "city_name")
                .agg(F.avg("discharge_m3s").alias("avg_discharge"))
                .withColumn("flood_risk_score",
                            capped_scaled("avg_discharge", rules.RISK_FLOW_SCALE, rules.RISK_FLOW_CAP,
                                          rules.RISK_FLOW_CAP)))


def fire_risk(stg_fire: DataFrame, confidence: Iterable[str] = rules.FIRE_CONFIDENCE,
              date_col: str = "detection_date", frp_col: str = "fire_radiative_power_mw",
              conf_col: str = "confidence_level") -> DataFrame:
    """Per day: hotspot count, mean radiative power, least(count*3, 30)."""
    return (stg_fire.filter(F.col(conf_col).isin(list(confidence)))
                    .groupBy(F.col(date_col).alias("risk_date"))
                    .agg(F.count(F.lit(1)).alias("hotspot_count"),
                         F.avg(frp_col).alias("avg_frp"))
                    .withColumn("fire_risk_score",
                                F.least(F.col("hotspot_count") * rules.RISK_FIRE_POINTS,
                                        F.lit(rules.RISK_FIRE_CAP))))


def aqi_risk(daily_aqi: DataFrame) -> DataFrame:
    return daily_aqi.select(
        F.col("measurement_date").alias("risk_date"), "city_name", "latitude", "longitude",
        aqi_component("cem_avg_aqi", "avg_pollutant_value", "pollutant_code").alias("aqi_risk_score"))


def combine_risk(aqi: DataFrame, flood: DataFrame, fire: DataFrame,
                 regional_name: str = "Regional") -> DataFrame:
    """Air, flood and fire components per day and province; composite score
    and level (the level uses the unrounded sum).

    The components are stacked, so each input is read and planned once, and
    fill each other within a day: an air row takes the flood columns
    of its (day, city) and a flood row without an air row stays as it is, all take the fire
    columns of their day, and a fire row stays only on a day of its own.
    Flood has one row a day and city, fire one a day; what meets in a task is
    a day's places, not its readings. Rows without a day or city match nothing by it.
    """
    air = aqi.select(F.to_date("risk_date").alias("risk_date"), "city_name", "latitude", "longitude", "aqi_risk_score",
                     F.lit("air").alias("_kind"))
    water = flood.select(F.to_date("risk_date").alias("risk_date"), "city_name", "flood_risk_score", "avg_discharge",
                         F.lit("water").alias("_kind"))
    daily = fire.select(F.to_date("risk_date").alias("risk_date"), "fire_risk_score", "hotspot_count", F.lit("fire").alias("_kind"))
    stacked = air.unionByName(water, allowMissingColumns=True).unionByName(daily, allowMissingColumns=True)
    # one exchange, by day, serves both windows
    stacked = stacked.repartition("risk_date")
    day, place = Window.partitionBy("risk_date"), Window.partitionBy("risk_date", "city_name")
    dated, placed = F.col("risk_date").isNotNull(), F.col("risk_date").isNotNull() & F.col("city_name").isNotNull()
    kind = F.col("_kind")
    seen = stacked.withColumns({
        "_air": F.count_if(kind == "air").over(place), "_local": F.count_if(kind != "fire").over(day),
        **{f"_{c}": F.max(c).over(place) for c in ("flood_risk_score", "avg_discharge")},
        **{f"_{c}": F.max(c).over(day) for c in ("fire_risk_score", "hotspot_count")}})
    rows = seen.where((kind == "air") | (kind == "water") & ~(placed & (F.col("_air") > 0))
                      | (kind == "fire") & ~(dated & (F.col("_local") > 0)))
    rows = rows.withColumns({
        **{c: F.when(placed, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("flood_risk_score", "avg_discharge")},
        **{c: F.when(dated, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("fire_risk_score", "hotspot_count")}})
    parts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("aqi_risk_score", "flood_risk_score", "fire_risk_score")}
    total = parts["aqi_risk_score"] + parts["flood_risk_score"] + parts["fire_risk_score"]
    return rows.select(
        "risk_date", F.coalesce("city_name", F.lit(regional_name)).alias("province_name"), "latitude", "longitude",
        *(c.alias(n) for n, c in parts.items()),
        F.round(total, 1).alias("composite_risk_score"),
        bucketize(total, rules.RISK_LEVEL_CUTS, rules.RISK_LEVEL_DEFAULT).alias("risk_level"),
        "avg_discharge", "hotspot_count")


def int_environmental_risk(daily_aqi: DataFrame, stg_flood: DataFrame, rivers: DataFrame,
                           stg_fire: DataFrame,
                           point_aliases: Mapping[str, str] | None = None,
                           confidence: Iterable[str] = rules.FIRE_CONFIDENCE,
                           broadcast_seed: bool = True, seed_key=None,
                           river_aliases: Mapping[str, str] | None = None) -> DataFrame:
    """T-11: composite 0-100 risk per day and province."""
    return combine_risk(aqi_risk(daily_aqi),
                        flood_risk(stg_flood, rivers, point_aliases, broadcast_seed, seed_key, river_aliases),
                        fire_risk(stg_fire, confidence))
