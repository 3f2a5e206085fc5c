"""Check queries Q25-Q32: scores, nested documents, HTML, fallback, stream
validation, change fold and quality rules over the driver tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import aqi_subindex, bucketize, risk_score
from airshed.operators.changes import apply_changes
from airshed.operators.fallback import with_fallback
from airshed.operators.html import html_items
from airshed.operators.nested import as_list, flatten_arrays, flatten_latest
from airshed.operators.quality import Rule, aqi_range_rule, run_rules
from airshed.plans.check_staging import CODE_OF_TYPE, ladder_sql, map_lit, ntz, sql_case, sround, station_places, table
from airshed.streaming.validator import reason_counts, validate

# Documents hold at most this many readings: bounded arrays whatever the
# skew of a station.
DOC_CHUNK = 64


# ---------------------------------------------------------------------------
# Q25: AQI sub-index per pollutant, PM2.5 class, composite risk (M1 M2 M8)
# ---------------------------------------------------------------------------



def q25_aqi_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn(
        "pollutant_code", F.element_at(map_lit(CODE_OF_TYPE), F.col("event_type")))
    aqi = aqi_subindex(F.col("pollutant_code"), F.col("value"))
    pm = F.when(F.col("pollutant_code") == "pm25",
                bucketize("value", rules.PM25_CATEGORY_CUTS, rules.PM25_CATEGORY_DEFAULT))
    out = ev.select("event_id", "pollutant_code", aqi.alias("aqi_value"), pm.alias("pm25_category"),
                    F.col("value").cast("decimal(12,2)").alias("flow"), (F.col("user_id") % 12).alias("fires"))
    return out.select("event_id", "pollutant_code", "aqi_value", "pm25_category",
                      risk_score("aqi_value", "flow", "fires").cast("double").alias("risk_score"))


def _sql_num(x) -> str:
    return str(Decimal(str(x)))


def aqi_sql(code_sql: str, v: str) -> str:
    """The AQI CASE as SQL text, generated from the same breakpoint table."""
    arms = []
    for code, segs in rules.AQI_BREAKPOINTS.items():
        inner = []
        for upper, c_lo, c_hi, i_lo, span in segs:
            if c_lo == 0 and i_lo == 0:
                raw = f"{v} / {_sql_num(c_hi)} * {span}"
            else:
                raw = f"{i_lo} + ({v} - {_sql_num(c_lo)}) / ({_sql_num(c_hi)} - {_sql_num(c_lo)}) * {span}"
            inner.append(f"when {v} <= {_sql_num(upper)} then cast(round({raw}) as integer)")
        arms.append(f"when {code_sql} = '{code}' then case when {v} is null then null "
                    f"{' '.join(inner)} else {rules.AQI_ABOVE_LAST} end")
    generic = f"case when {v} is not null then least(cast(round({v}) as integer), {rules.AQI_CAP}) end"
    return f"case {' '.join(arms)} else {generic} end"


_PM_SQL = ladder_sql("value", rules.PM25_CATEGORY_CUTS, rules.PM25_CATEGORY_DEFAULT)
Q25 = f"""
with e as (select *, {sql_case('event_type', CODE_OF_TYPE)} as pollutant_code from events),
a as (select event_id, pollutant_code, {aqi_sql('pollutant_code', 'value')} as aqi_value,
             case when pollutant_code = 'pm25' then {_PM_SQL} end as pm25_category,
             cast(value as decimal(12, 2)) as flow, user_id % 12 as fires from e)
select event_id, pollutant_code, aqi_value, pm25_category,
       least({sround('least(coalesce(aqi_value, 0) / 500.0 * 40, 40) + least(coalesce(flow, 0) / 5000.0 * 30, 30)'
                     ' + least(coalesce(fires, 0) * 3, 30)', 1)}, 100) as risk_score
from a
"""


# ---------------------------------------------------------------------------
# Q26: location documents built from readings and flattened back
# ---------------------------------------------------------------------------

TARGET_TYPES = ("click", "view", "purchase")


def _outdated(sensor):
    """An earlier entry of the same id with other contents."""
    return F.named_struct(F.lit("id"), sensor["id"], F.lit("parameter"),
                          F.named_struct(F.lit("name"), F.lit("NONE"), F.lit("units"), F.lit("none")))


def location_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per station and block of <= DOC_CHUNK readings:
    location with a sensor list (id -> parameter) and the latest results
    that refer to sensors by id; 'error' readings have no sensor entry, the
    other ids are listed twice and only the last entry holds.
    Even stations carry a locality; every third station writes times as
    ``{"utc": ...}`` objects."""
    ev = table(spark, sf_dir, "events")
    pl = station_places(spark, sf_dir)
    j = ev.join(pl, ev["user_id"] == pl["c_custkey"])
    sid = F.crc32(F.col("event_type"))
    sensor = F.when(F.col("event_type") != "error",
                    F.struct(sid.alias("id"), F.struct(F.upper("event_type").alias("name"),
                                                       F.lit("ppm").alias("units")).alias("parameter")))
    docs = (j.groupBy("user_id", "c_name", "n_name", "n_nationkey", "n_regionkey",
                      F.expr(f"event_id div {DOC_CHUNK}").alias("chunk"))
             .agg(F.concat(F.transform(F.array_distinct(F.collect_list(sensor)), _outdated),
                           F.array_distinct(F.collect_list(sensor))).alias("sensors"),
                  F.collect_list(F.struct(sid.alias("sensorsId"), F.col("value"),
                                          F.col("ts").cast("string").alias("datetime"))).alias("results")))
    location = F.struct(
        F.col("user_id").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("user_id") % 2 == 0, F.col("c_name")).alias("locality"), F.col("n_name").alias("city"),
        F.struct((F.lit(8.0) + F.col("n_nationkey") * 0.5).alias("latitude"),
                 (F.lit(102.0) + F.col("n_regionkey") * 1.5).alias("longitude")).alias("coordinates"),
        F.col("sensors"))
    as_objects = F.transform("results", lambda r: F.named_struct(
        F.lit("sensorsId"), r["sensorsId"], F.lit("value"), r["value"],
        F.lit("datetime"), F.named_struct(F.lit("utc"), r["datetime"])))
    doc = F.when(F.col("user_id") % 3 == 0,
                 F.to_json(F.struct(location.alias("location"), F.struct(as_objects.alias("results")).alias("latest"))))\
        .otherwise(F.to_json(F.struct(location.alias("location"), F.struct(F.col("results")).alias("latest"))))
    return docs.select(doc.alias("doc"))


def q26_flatten_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten_latest(location_documents(spark, sf_dir), "doc", TARGET_TYPES)
    return rows.select("location_id", "location_name", "city", "latitude", "longitude", "parameter", "value",
                       "unit", ntz(F.col("last_updated").cast("timestamp_ntz")).alias("last_updated"))


Q26 = """
select e.user_id as location_id, c.c_name as location_name,
       case when e.user_id % 2 = 0 then c.c_name else n.n_name end as city,
       cast(8 + n.n_nationkey * 0.5 as double) as latitude, cast(102 + n.n_regionkey * 1.5 as double) as longitude,
       e.event_type as parameter, e.value, 'ppm' as unit, e.ts as last_updated
from events e join customer c on e.user_id = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
where e.event_type in ('click', 'view', 'purchase')
"""


# ---------------------------------------------------------------------------
# Q27: parallel arrays zipped back to rows, short array -> NULL
# ---------------------------------------------------------------------------

HOURLY_DOCS = ("array<struct<user_id: bigint, hourly: struct<time: array<timestamp_ntz>, value: array<double>, "
               "event_type: array<string>>>>")


def q27_zip_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel-array responses per station block: odd blocks have a short
    value array and arrive wrapped in a list (the single-object / list
    shapes of one feed, N6); both are normalised, parsed and zipped."""
    ev = table(spark, sf_dir, "events").withColumn("chunk", F.expr(f"event_id div {DOC_CHUNK}"))
    g = ev.groupBy("user_id", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("event_id", "ts", "value", "event_type"))).alias("r"))
    values = F.transform("r", lambda x: x["value"])
    hourly = F.struct(
        F.transform("r", lambda x: x["ts"]).alias("time"),
        F.when(F.col("chunk") % 2 == 1, F.slice(values, 1, F.size("r") - 1)).otherwise(values).alias("value"),
        F.transform("r", lambda x: x["event_type"]).alias("event_type"))
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}  # keep microseconds through JSON
    obj = F.to_json(F.struct("user_id", hourly.alias("hourly")), micros)
    doc = F.when(F.col("chunk") % 2 == 1, F.concat(F.lit("["), obj, F.lit("]"))).otherwise(obj)
    parsed = g.select(F.explode(F.from_json(as_list(doc), HOURLY_DOCS, micros)).alias("d")).select("d.*")
    flat = flatten_arrays(parsed, "hourly", "time", ["value", "event_type"], keep=["user_id"])
    return flat.select("user_id", ntz("time").alias("time"), "value", "event_type")


Q27 = f"""
with e as (select user_id, event_id // {DOC_CHUNK} as chunk, event_id, ts, value, event_type from events),
l as (select user_id, chunk, max(event_id) as last_id from e group by 1, 2)
select e.user_id, e.ts as time,
       case when e.chunk % 2 = 1 and e.event_id = l.last_id then null else e.value end as value, e.event_type
from e join l using (user_id, chunk)
"""


# ---------------------------------------------------------------------------
# Q28: list items, titles and absolute links from raw pages
# ---------------------------------------------------------------------------

def q28_html_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages keep their list in ``li`` entries: that layout's selector
    is passed as configuration."""
    return html_items(table(spark, sf_dir, "pages"), item_tag="li", fallback="")


def _strip_sql(x: str) -> str:
    t = f"regexp_replace({x}, '(?s)\\s*<[^>]*>\\s*', '', 'g')"
    for ent, ch in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&amp;", "&")):
        t = f"replace({t}, '{ent}', '{ch}')"
    return f"regexp_replace({t}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')"


Q28 = f"""
with q as (select page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) as base,
                  regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1) as items from pages),
x as (select page_id, base, unnest(items) as item, unnest(range(len(items))) as item_no from q),
a as (select *, case when length(regexp_extract(item, '(?is)<h3[^>]*>\\s*(<a\\b[^>]*>.*?</a>)', 1)) > 0
                     then regexp_extract(item, '(?is)<h3[^>]*>\\s*(<a\\b[^>]*>.*?</a>)', 1)
                     else regexp_extract(item, '(?is)(<a\\b[^>]*>.*?</a>)', 1) end as a from x),
r as (select page_id, item_no,
             case when length(a) > 0 then {_strip_sql('a')} else 'N/A' end as title,
             {_strip_sql("regexp_extract(item, '(?is)<div[^>]*class=\"[^\"]*\\bsummary\\b[^\"]*\"[^>]*>(.*?)</div>', 1)")}
                 as summary,
             {_strip_sql("regexp_extract(item, '(?is)<span[^>]*class=\"[^\"]*\\bdate\\b[^\"]*\"[^>]*>(.*?)</span>', 1)")}
                 as publish_date,
             case when length(a) > 0 then regexp_extract(a, '(?is)href="([^"]*)"', 1) else '' end as href, base
      from a)
select page_id, item_no, title, summary, publish_date,
       case when href is null or href = '' then href when starts_with(href, 'http') then href
            else base || href end as detail_url
from r where not (title = 'N/A' and summary = '')
"""


# ---------------------------------------------------------------------------
# Q29: per source, fall back to the latest earlier batch
# ---------------------------------------------------------------------------

# The last hour of the readings; one source stopped three hours before it,
# another one longer ago than a batch may be served.
AS_OF, FALLBACK_TTL = "2024-01-30 23:00:00", "6 HOURS"
GAPS = {"error": 3, "signup": 9}


def q29_snapshot_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    hist = ev.select("event_id", "event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("batch"))
    for source, hours in GAPS.items():
        hist = hist.filter((F.col("event_type") != source) | (F.col("batch") <= F.lit(AS_OF).cast("timestamp")
                                                              - F.expr(f"INTERVAL {hours} HOURS")))
    out = with_fallback(hist, "event_type", "batch", AS_OF, ttl=FALLBACK_TTL)
    return out.select("event_id", "event_type", ntz("batch").alias("batch"), "is_fallback")


Q29 = """
with h as (select event_id, event_type, date_trunc('hour', ts) as batch from events
           where not (event_type = 'error' and date_trunc('hour', ts) > timestamp '2024-01-30 20:00:00')
             and not (event_type = 'signup' and date_trunc('hour', ts) > timestamp '2024-01-30 14:00:00')),
m as (select timestamp '2024-01-30 23:00:00' as ref),
cur as (select h.* from h where batch = (select ref from m)),
missing as (select distinct event_type from h where event_type not in (select event_type from cur)),
chosen as (select h.event_type, max(h.batch) as batch from h join missing using (event_type)
           where h.batch < (select ref from m) and h.batch >= (select ref from m) - interval 6 hour group by 1)
select event_id, event_type, batch, false as is_fallback from cur
union all
select h.event_id, h.event_type, h.batch, true from h join chosen using (event_type, batch)
"""


# ---------------------------------------------------------------------------
# Q30: stream validation, batch twin: seeded faults -> reason counts (ST1 ST2 A10)
# ---------------------------------------------------------------------------

PARAM_OF_TYPE = {"click": "pm25", "view": "pm10", "purchase": "o3", "signup": "no2", "error": "nox"}
# Fault seeded on a message by its id; first matching modulus wins.
FAULTS = [(101, "malformed_text"), (103, "json_list"), (107, "no_location_id"), (109, "float_id"),
          (113, "bool_id"), (127, "null_city"), (131, "text_value")]
NEGATIVE_EVERY = 53
LON = 105.5


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw stream messages (JSON text), some with seeded faults."""
    ev = table(spark, sf_dir, "events")
    fault = None
    for mod, name in FAULTS:
        cond = F.col("event_id") % mod == 0
        fault = F.when(cond, F.lit(name)) if fault is None else fault.when(cond, F.lit(name))
    fault = fault.otherwise(F.lit("none"))
    v = F.when(F.col("event_id") % NEGATIVE_EVERY == 0, -F.col("value")).otherwise(F.col("value"))
    fields = {
        "location_id": F.col("user_id"),
        "location_name": F.concat(F.lit("Station "), F.col("user_id").cast("string")),
        "city": F.lit("Hà Nội"),
        "latitude": F.lit(8.0) + (F.col("user_id") % 20),
        "longitude": F.lit(LON),
        "parameter": F.element_at(map_lit(PARAM_OF_TYPE), F.col("event_type")),
        "value": v,
        "unit": F.lit("µg/m³"),
        "date_utc": F.col("ts").cast("string"),
    }

    def msg(**override):
        cols = {**fields, **override}
        return F.to_json(F.struct(*[c.alias(k) for k, c in cols.items() if c is not None]),
                         {"ignoreNullFields": "false"})

    text = (F.when(F.col("_f") == "malformed_text",
                   F.concat(F.lit('{"location_id": '), F.col("user_id").cast("string")))
             .when(F.col("_f") == "json_list", F.lit("[1, 2]"))
             .when(F.col("_f") == "no_location_id", msg(location_id=None))
             .when(F.col("_f") == "float_id", msg(location_id=F.col("user_id").cast("double")))
             .when(F.col("_f") == "bool_id", msg(location_id=F.lit(True)))
             .when(F.col("_f") == "null_city", msg(city=F.lit(None).cast("string")))
             .when(F.col("_f") == "text_value", msg(value=v.cast("string")))
             .otherwise(msg()))
    return ev.withColumn("_f", fault).select("event_id", text.alias("value"))


def q30_validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_counts(validate(messages(spark, sf_dir), "value"))


_FAULT_SQL = "case " + " ".join(f"when event_id % {m} = 0 then '{n}'" for m, n in FAULTS) + " else 'none' end"
_VALID_SQL = ", ".join(f"'{p}'" for p in rules.VALID_POLLUTANTS)
_LAT0, _LAT1, _LON0, _LON1 = rules.VIETNAM_BOX
MESSAGE_SQL = f"""
select *, case when fault = 'malformed_text' then 'malformed'
                  when fault in ('json_list', 'no_location_id') then 'missing:location_id'
                  when fault in ('float_id', 'bool_id') then 'type:location_id'
                  when fault = 'null_city' then 'type:city'
                  when fault = 'text_value' then 'type:value'
                  when param not in ({_VALID_SQL}) then 'enum:parameter'
                  when v < 0 then 'range:value'
                  when not (lat between {_LAT0} and {_LAT1} and {LON} between {_LON0} and {_LON1}) then 'box'
             end as reason
from (select event_id, user_id, ts, {_FAULT_SQL} as fault, {sql_case('event_type', PARAM_OF_TYPE)} as param,
                  case when event_id % {NEGATIVE_EVERY} = 0 then -value else value end as v,
                  cast(8.0 + (user_id % 20) as double) as lat from events)
"""
Q30 = f"""
with r as ({MESSAGE_SQL})
select case when reason is null then 'valid' else 'invalid' end as status, coalesce(reason, '') as reason,
       count(*) as n
from r group by 1, 2
"""


# ---------------------------------------------------------------------------
# Q31: change rows folded to the latest state per key
# ---------------------------------------------------------------------------

OP_OF_STATUS = {"O": "c", "F": "u", "P": "d"}


def q31_change_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate",
        F.element_at(map_lit(OP_OF_STATUS), F.col("o_orderstatus")).alias("op"))
    out = apply_changes(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], op_col="op")
    return out.select("o_custkey", "o_orderkey", "o_totalprice", ntz("o_orderdate").alias("o_orderdate"))


Q31 = """
select o_custkey, o_orderkey, o_totalprice, o_orderdate from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
  from orders) where rn = 1 and o_orderstatus <> 'P'
"""


# ---------------------------------------------------------------------------
# Q32: data-quality rules, failing-row counts in one pass (QT1-QT6)
# ---------------------------------------------------------------------------

QUALITY_RULES = [
    Rule("not_null", "user_id"),
    Rule("not_null", "props"),
    Rule("unique", "event_id"),
    Rule("unique", "user_id"),
    Rule("accepted_values", "event_type", values=("click", "view", "purchase", "signup")),
    Rule("accepted_range", "value", min_value=0, max_value=300),
    aqi_range_rule("value"),
    Rule("expression", "value", condition="event_type = 'error' and value > 100"),
]


def q32_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props", (F.col("value") * 3).alias("value"))
    return run_rules(ev, QUALITY_RULES)


Q32 = """
with e as (select event_id, user_id, event_type, props, value * 3 as value from events)
select 'not_null' as rule, 'user_id' as "column", count(*) filter (where user_id is null) as failed from e
union all select 'not_null', 'props', count(*) filter (where props is null) from e
union all select 'unique', 'event_id', cast(coalesce(sum(n), 0) as bigint) from
  (select event_id, count(*) as n from e where event_id is not null group by 1 having count(*) > 1)
union all select 'unique', 'user_id', cast(coalesce(sum(n), 0) as bigint) from
  (select user_id, count(*) as n from e where user_id is not null group by 1 having count(*) > 1)
union all select 'accepted_values', 'event_type',
  count(*) filter (where event_type is not null and event_type not in ('click', 'view', 'purchase', 'signup'))
  from e
union all select 'accepted_range', 'value', count(*) filter (where value is not null and (value < 0 or value > 300))
  from e
union all select 'accepted_range', 'value', count(*) filter (where value is not null and (value < 0 or value > 500))
  from e
union all select 'expression', 'value', count(*) filter (where event_type = 'error' and value > 100) from e
"""

QUERIES = {
    "q25_aqi_scores": q25_aqi_scores,
    "q26_flatten_documents": q26_flatten_documents,
    "q27_zip_arrays": q27_zip_arrays,
    "q28_html_items": q28_html_items,
    "q29_snapshot_fallback": q29_snapshot_fallback,
    "q30_validate_messages": q30_validate_messages,
    "q31_change_fold": q31_change_fold,
    "q32_quality_rules": q32_quality_rules,
}
ORACLE = {
    "q25_aqi_scores": Q25, "q26_flatten_documents": Q26, "q27_zip_arrays": Q27, "q28_html_items": Q28,
    "q29_snapshot_fallback": Q29, "q30_validate_messages": Q30, "q31_change_fold": Q31,
    "q32_quality_rules": Q32,
}
