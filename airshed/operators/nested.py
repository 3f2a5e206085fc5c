"""Nested feed documents -> rows.

All flattening is built from ``from_json`` / variant access, ``explode``,
``inline(arrays_zip(...))`` and higher-order functions, so it runs inside
the JVM per document; no document is ever collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed import rules


def as_list(doc: Column) -> Column:
    """A JSON document that is one object or a list of objects, as a
    JSON list (a lone object is wrapped). The shape is read from the first
    non-blank character, so the document is not parsed twice."""
    return F.when(F.ltrim(doc).startswith("["), doc).otherwise(F.concat(F.lit("["), doc, F.lit("]")))


def to_json_row(*cols: str | Column) -> Column:
    """Serialise columns as one JSON object (non-ASCII kept as is)."""
    return F.to_json(F.struct(*cols))


LOCATION_SCHEMA = """
struct<location: struct<id: bigint, name: string, locality: string, city: string,
                        coordinates: struct<latitude: double, longitude: double>,
                        sensors: array<struct<id: bigint, parameter: struct<name: string, units: string>>>>,
       latest: struct<results: array<struct<sensorsId: bigint, value: double, datetime: string>>>>
"""


def flatten_latest(df: DataFrame, doc_col: str = "doc",
                   targets: Iterable[str] = rules.VALID_POLLUTANTS,
                   keep: Sequence[str] = ()) -> DataFrame:
    """N1 + J6: one row per latest measurement of a location document.

    The sensor id -> parameter lookup searches the document's own sensor
    list from its end, so it never leaves the row and the last entry of a
    repeated id counts. Missing
    sensors give an empty name and are dropped by the target filter; the
    measurement time is either text or an object with ``utc``. A missing
    ``locality`` falls back to ``city`` (a null one stays null) and a
    missing name becomes 'Unknown'.
    """
    parsed = df.select(*keep, F.from_json(F.col(doc_col), LOCATION_SCHEMA).alias("d"),
                       F.try_parse_json(F.col(doc_col)).alias("_v"))
    loc = F.col("d.location")
    lv = F.col("_v")
    # name defaults only when missing; a locality key (even null) wins over city
    name = get_or(lv, "$.location.name", "string", F.lit("Unknown"))
    city = F.when(_present(lv, "$.location.locality"), loc["locality"]) \
        .otherwise(get_or(lv, "$.location.city", "string", F.lit("")))
    # sensors with a falsy id (missing or 0) or no parameter are skipped
    sensors = F.filter(loc["sensors"], lambda s: s["id"].isNotNull() & (s["id"] != 0) & s["parameter"].isNotNull())
    rows = parsed.select(
        *keep,
        loc["id"].alias("location_id"),
        name.alias("location_name"),
        city.alias("city"),
        loc["coordinates"]["latitude"].alias("latitude"),
        loc["coordinates"]["longitude"].alias("longitude"),
        sensors.alias("_sensors"),
        F.explode(F.col("d.latest.results")).alias("_m"))
    same = F.filter("_sensors", lambda s: s["id"] == F.col("_m.sensorsId"))
    info = F.get(same, F.size(same) - 1)["parameter"]
    dt = F.col("_m.datetime")
    dt_text = F.coalesce(F.get_json_object(dt, "$.utc"),
                         F.when(~dt.startswith("{"), dt), F.lit(""))
    out = rows.select(
        *keep, "location_id", "location_name", "city", "latitude", "longitude",
        F.lower(F.coalesce(info["name"], F.lit(""))).alias("parameter"),
        F.col("_m.value").alias("value"),
        F.coalesce(info["units"], F.lit("")).alias("unit"),
        dt_text.alias("last_updated"))
    return out.filter(F.col("parameter").isin(list(targets)))


def _present(v: Column, path: str) -> Column:
    """The key exists (a JSON null counts as present)."""
    return F.try_variant_get(v, path, "variant").isNotNull()


def get_or(v: Column, path: str, type_: str, default: Column) -> Column:
    """Value at ``path`` as ``type_``; ``default`` only when the key is
    missing — a JSON null stays NULL (dictionary ``get`` semantics)."""
    return F.when(_present(v, path), F.try_variant_get(v, path, type_)).otherwise(default)


def flatten_parameters(df: DataFrame, doc_col: str = "doc", produced_at: Column | None = None) -> DataFrame:
    """One stream message per location x parameter. Defaults (id 0,
    name/city 'Unknown', coordinates 0.0, parameter 'unknown', value 0.0,
    unit, time = now) apply only to missing keys; JSON nulls stay NULL."""
    now = produced_at if produced_at is not None else F.current_timestamp().cast("string")
    v = F.try_parse_json(F.col(doc_col))
    rows = df.select(v.alias("_v"), F.explode(F.try_variant_get(v, "$.parameters", "array<variant>")).alias("_p"))
    lv, pv = F.col("_v"), F.col("_p")
    updated = get_or(pv, "$.lastUpdated", "string", now)
    return rows.select(
        get_or(lv, "$.id", "bigint", F.lit(0).cast("bigint")).alias("location_id"),
        get_or(lv, "$.name", "string", F.lit("Unknown")).alias("location_name"),
        get_or(lv, "$.city", "string", F.lit("Unknown")).alias("city"),
        F.lit(rules.MESSAGE_DEFAULTS["country"]).alias("country"),
        get_or(lv, "$.coordinates.latitude", "double", F.lit(0.0)).alias("latitude"),
        get_or(lv, "$.coordinates.longitude", "double", F.lit(0.0)).alias("longitude"),
        get_or(pv, "$.parameter", "string", F.lit("unknown")).alias("parameter"),
        get_or(pv, "$.lastValue", "double", F.lit(0.0)).alias("value"),
        get_or(pv, "$.unit", "string", F.lit(rules.MESSAGE_DEFAULTS["unit"])).alias("unit"),
        updated.alias("date_utc"),
        updated.alias("date_local"),
        F.lit(rules.MESSAGE_DEFAULTS["source"]).alias("source"),
        now.alias("produced_at"))


def flatten_arrays(df: DataFrame, struct_col: str, time_field: str, fields: Sequence[str],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays -> one row per entry of the time array (a
    NULL time entry still gives a row); a shorter value array yields NULL
    at the missing positions, a longer one is cut at the time array."""
    s = F.col(struct_col)
    rows = df.select(*keep, s.alias("_s"), F.posexplode(s[time_field]).alias("_i", time_field))
    return rows.select(*keep, time_field,
                       *[F.get(F.col("_s")[f], F.col("_i")).alias(f) for f in fields])


ELEMENTS_SCHEMA = ("struct<elements: array<struct<type: string, id: bigint, lat: double, lon: double, "
                   "tags: string>>>")


def flatten_elements(df: DataFrame, doc_col: str = "doc", element_type: str = "node",
                     default_name: str = "Unknown") -> DataFrame:
    """N5 + F17: map elements of one type -> points with tag lookups. The
    amenity tag has no default; a missing name tag becomes 'Unknown' (a
    null one stays null). Of a repeated tag the last value counts."""
    d = F.from_json(F.col(doc_col), ELEMENTS_SCHEMA)
    rows = df.select(F.explode(d["elements"]).alias("e")).filter(F.col("e.type") == element_type)
    # a map read from JSON keeps every entry of a repeated key, in order
    entries = F.coalesce(F.map_entries(F.from_json(F.col("e.tags"), "map<string, string>")),
                         F.array().cast("array<struct<key: string, value: string>>"))
    tag = lambda k: F.filter(entries, lambda t: t["key"] == F.lit(k))
    last = lambda a: F.get(a, F.size(a) - 1)["value"]
    name = F.when(F.size(tag("name")) > 0, last(tag("name"))).otherwise(F.lit(default_name))
    return rows.select(
        F.col("e.id").alias("node_id"), F.col("e.lat").alias("latitude"), F.col("e.lon").alias("longitude"),
        last(tag("amenity")).alias("amenity_type"), name.alias("name"))


def zip_by_position(left: DataFrame, left_array: str, right: DataFrame, right_array: str,
                    key: str | Sequence[str]) -> DataFrame:
    """Pair two lists by position within the same key; stops at the
    shorter list. The lists of a key meet once, whole (``key`` is unique on
    both sides), and are zipped inside the row."""
    keys = [key] if isinstance(key, str) else list(key)
    both = left.select(*keys, F.col(left_array).alias("_left")).join(
        right.select(*keys, F.col(right_array).alias("_right")), keys)
    return zip_arrays(both, "_left", "_right", keep=keys)


def zip_arrays(df: DataFrame, left_array: str, right_array: str, keep: Sequence[str] = ()) -> DataFrame:
    """J7 within a row: (pos, left_item, right_item) up to the shorter list;
    no join and no shuffle."""
    n = F.least(F.size(left_array), F.size(right_array))
    pairs = F.arrays_zip(F.slice(left_array, 1, F.greatest(n, F.lit(0))).alias("left_item"),
                         F.slice(right_array, 1, F.greatest(n, F.lit(0))).alias("right_item"))
    return df.select(*keep, F.posexplode(pairs).alias("pos", "_p")).select(
        *keep, "pos", F.col("_p")["left_item"].alias("left_item"), F.col("_p")["right_item"].alias("right_item"))
