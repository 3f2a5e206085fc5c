"""The SQL-model layer as one fixed composition (T-1 ... T-19).

Staging models are views (lazy frames inlined by Catalyst into their
readers); intermediate and mart models are built in dependency order, and
the marts are written as tables when a target is given. The order is
fixed here — there is no model-graph resolver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from airshed import rules
from airshed.plans import intermediate as I
from airshed.plans import marts as M
from airshed.plans import staging as S
from airshed.sources.readers import seed_frame

STAGING = {
    "stg_air_quality": ("air_quality", S.stg_air_quality),
    "stg_weather": ("weather", S.stg_weather),
    "stg_flood": ("flood", S.stg_flood),
    "stg_cem_aqi": ("cem_aqi", S.stg_cem_aqi),
    "stg_nchmf_disaster": ("nchmf_disaster", S.stg_nchmf_disaster),
    "stg_fire_hotspot": ("fire_hotspot", S.stg_fire_hotspot),
    "stg_geo_features": ("geo_features", S.stg_geo_features),
}

MART_TABLES = ("dim_location", "dim_time", "dim_pollutant", "dim_station", "dim_disaster_type",
               "fact_air_measurements", "fact_weather_observations", "fact_natural_disasters")


class _Models(dict):
    """Models by name, each settled as it is added."""

    def __init__(self, settle: Callable[[str, DataFrame], DataFrame] | None):
        super().__init__()
        self._settle = settle

    def __setitem__(self, name: str, model: DataFrame) -> None:
        super().__setitem__(name, self._settle(name, model) if self._settle else model)


def written_to(target: str, fmt: str = "parquet") -> Callable[[str, DataFrame], DataFrame]:
    """Write a model below ``target`` (replaced each run) and read it back."""
    def settle(name: str, model: DataFrame) -> DataFrame:
        path = f"{target.rstrip('/')}/{name}"
        model.write.mode("overwrite").format(fmt).save(path)
        return model.sparkSession.read.format(fmt).schema(model.schema).load(path)

    return settle


def build_models(spark: SparkSession, bronze: Mapping[str, DataFrame],
                 seeds: Mapping[str, DataFrame] | None = None,
                 point_aliases: Mapping[str, str] | None = None,
                 settle: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All models from the raw tables (``bronze`` keyed by source name:
    air_quality, weather, flood, cem_aqi, nchmf_disaster, fire_hotspot,
    geo_features) and the seeds (default: packaged). ``settle`` replaces a
    model before others read it, e.g. by its written table
    (``written_to``): then each model is computed once, whatever reads it."""
    seeds = dict(seeds or {n: seed_frame(spark, n) for n in ("vietnam_cities", "vietnam_rivers",
                                                              "pollutant_standards")})
    aliases = point_aliases if point_aliases is not None else rules.RIVER_POINT_CITY_ALIASES
    m: dict[str, DataFrame] = _Models(settle)
    for name, (source, fn) in STAGING.items():
        if source in bronze:
            m[name] = fn(bronze[source])
    if {"stg_air_quality", "stg_cem_aqi"} <= m.keys():
        m["int_daily_aqi_city"] = I.int_daily_aqi_city(m["stg_air_quality"], m["stg_cem_aqi"])
    if "stg_weather" in m:
        m["int_weather_hourly"] = I.int_weather_hourly(m["stg_weather"])
        m["fact_weather_observations"] = M.fact_weather_observations(m["int_weather_hourly"])
    if "stg_nchmf_disaster" in m:
        m["int_disaster_impact"] = I.int_disaster_impact(m["stg_nchmf_disaster"], rules.SEVERITY_WEIGHTS_LITERAL)
    if {"int_daily_aqi_city", "stg_flood", "stg_fire_hotspot"} <= m.keys():
        m["int_environmental_risk"] = I.int_environmental_risk(
            m["int_daily_aqi_city"], m["stg_flood"], seeds["vietnam_rivers"], m["stg_fire_hotspot"], aliases,
            river_aliases=rules.RIVER_NAME_ALIASES)
    m["dim_location"] = M.dim_location(seeds["vietnam_cities"], seeds["vietnam_rivers"])
    m["dim_time"] = M.dim_time(spark)
    m["dim_pollutant"] = M.dim_pollutant(seeds["pollutant_standards"])
    m["dim_disaster_type"] = M.dim_disaster_type(spark)
    if "stg_air_quality" in m:
        m["dim_station"] = M.dim_station(m["stg_air_quality"])
        m["fact_air_measurements"] = M.fact_air_measurements(m["stg_air_quality"])
    if "stg_nchmf_disaster" in m:
        m["fact_natural_disasters"] = M.fact_natural_disasters(m["stg_nchmf_disaster"], m["dim_disaster_type"])
    return dict(m)


def test_models(models: Mapping[str, DataFrame], stop_on_failure: bool = False) -> DataFrame:
    """The declared model tests (QT1-QT4), one scan per model; give it
    written models (``build_models(settle=written_to(...))``), so that no test
    computes a model again. With ``stop_on_failure`` a failing test raises,
    stopping the pipeline."""
    from airshed.operators.quality import assert_rules, model_tests

    results = model_tests(models)
    if stop_on_failure:
        assert_rules(results)
    return results


def write_marts(models: Mapping[str, DataFrame], target: str, fmt: str = "parquet") -> list[str]:
    """Write the mart tables under ``target`` (replaced each run)."""
    written = []
    for name in MART_TABLES:
        if name in models:
            models[name].write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{name}")
            written.append(name)
    return written
