"""Check queries Q44-Q54: pages in the feeds' own layouts, jobs that write
files and read them back, and the models and sinks no other query runs.
Their oracles are computed from the source columns, not from what the jobs
wrote."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import in_box
from airshed.operators.aggregates import observe_counts, status_counts
from airshed.operators.html import html_items, html_tables
from airshed.operators.nested import flatten_elements
from airshed.operators.quality import Rule, rows_by_rule
from airshed.plans.check_gold import ORACLE as GOLD_ORACLE
from airshed.plans.check_gold import events_as_raw_aqi
from airshed.plans.check_nested import MESSAGE_SQL, messages
from airshed.plans.check_staging import CODE_OF_TYPE, MONTHS_SQL, NULLK, SEASON_SQL, map_lit, ntz, shifted, sql_case, table
from airshed.plans.gold import run_bronze_to_silver, run_silver_to_gold
from airshed.plans.marts import dim_pollutant, dim_time
from airshed.plans.staging import stg_geo_features
from airshed.session import scratch_path
from airshed.sources.readers import EmptyFeedError, read_feed_csv, read_source, seed_frame, seed_rows
from airshed.sources.sinks import land
from airshed.sources.versions import put
from airshed.streaming.validator import publish, validate

BLOCK = 4096   # order keys of a page: bounded pages whatever a customer orders


def _pages(spark: SparkSession, sf_dir: str, part: Column, head: Column, tail: Column) -> DataFrame:
    """A page per customer and block of orders: head, one part per order in
    the order of their keys, tail."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.expr(f"o_orderkey div {BLOCK}").alias("block"),
                                              part.alias("part"))
    g = o.groupBy("o_custkey", "block").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "part"))).alias("parts"))
    return g.select("o_custkey", "block", F.lit("https://portal.example/tin?x=1").alias("url"),
                    F.concat(head, F.array_join(F.transform("parts", lambda p: p["part"]), "\n"), tail).alias("html"))


def _with_key(text: str) -> Column:
    """``text`` with every ``{k}`` replaced by the order key."""
    return F.replace(F.lit(text), F.lit("{k}"), F.col("o_orderkey").cast("string"))


def _by_key(variants: list[str]) -> Column:
    out = F.lit("")
    for i, text in enumerate(variants):
        out = F.when(F.col("o_orderkey") % len(variants) == i, _with_key(text)).otherwise(out)
    return out


# ---------------------------------------------------------------------------
# Q44: list pages in the default layout
# ---------------------------------------------------------------------------

ITEMS = [
    '<div class="item"><h3><b><a href="/tin/{k}">T&agrave;i &#7841; &#x1ea1; {k}</a></b></h3><div class="summary">S <div>inner {k}'
    '</div> t</div><span class="date">d{k}</span></div>',
    "<div class='hot item'><a href='http://x.vn/{k}'> Link {k} </a></div>",
    '<div class=item><div class="summary">only {k}</div></div>',
    '<div class="item"><p>blank {k}</p></div>',
    '<div class="item"><h3><a>no target {k}</a></h3><span class="dates">x</span></div>',
    '<!-- <div class="item"><a href="/c">comment {k}</a></div> -->',
    '<div class="items"><a href="/n">another class {k}</a></div>',
]
LIST_HEAD = ("<html><script>var x = '<div class=\"news-list\"><div class=\"item\"><a>s</a></div></div>';</script>"
             "<div class=\"item\"><a href=\"/out\">outside the list</a></div><div class='wide news-list'>")
LIST_TAIL = '</div><div class="summary">FOOT</div><span class="date">FD</span></html>'


def q44_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir, _by_key(ITEMS), F.lit(LIST_HEAD), F.lit(LIST_TAIL))
    return html_items(pages, keep=("o_custkey", "block")).select(
        "o_custkey", "block", "title", "summary", "publish_date", "detail_url")


Q44 = f"""
with o as (select o_custkey, o_orderkey, o_orderkey // {BLOCK} as block, o_orderkey % 7 as kind,
                  cast(o_orderkey as varchar) as k from orders),
full_lists as (select o_custkey, block from o group by 1, 2 having min(kind) <= 4),
bare as (select o_custkey, block from o group by 1, 2 having min(kind) > 4)
select o_custkey, block,
       case kind when 0 then 'Tài ạ ạ ' || k when 1 then 'Link ' || k when 4 then 'no target ' || k else 'N/A' end as title,
       case kind when 0 then 'Sinner ' || k || 't' when 2 then 'only ' || k else '' end as summary,
       case kind when 0 then 'd' || k else '' end as publish_date,
       case kind when 0 then 'https://portal.example/tin/' || k when 1 then 'http://x.vn/' || k when 2 then '' end as detail_url
from o join full_lists using (o_custkey, block) where kind in (0, 1, 2, 4)
union all
-- pages whose list has no item: every div whose class names news or items
select o_custkey, block, 'outside the list', '', '', 'https://portal.example/out' from bare
union all
select o_custkey, block, 'another class ' || first(k order by o_orderkey), '', '', 'https://portal.example/n'
from o join bare using (o_custkey, block) where kind = 6 group by 1, 2
union all
select o_custkey, block, 'another class ' || k, '', '', 'https://portal.example/n' from o join bare using (o_custkey, block) where kind = 6
"""


# ---------------------------------------------------------------------------
# Q45: table pages
# ---------------------------------------------------------------------------

ROWS = [
    "<tr><td>Tr&#7841;m<!-- <td>no cell</td> --> {k} </td><td>{k}.5</td><td><b>Tốt</b> lắm</td><td>08:00 {k}</td></tr>",
    "<tr><td>S&oacute;c {k}</td><td> {k} </td><td>Kém <table><tr><td>in {k}</td></tr></table></td><td>09:00 {k}</td></tr>",
    "<tr><td>Bến {k}</td><td>n/a</td><td>Xấu</td><td>10:00</td><td>more</td></tr>",
    "<tr><td>short {k}</td><td>1</td><td>x</td></tr>",
    "<!-- <tr><td>gone {k}</td><td>1</td><td>x</td><td>y</td></tr> -->",
    "<tr><th>Station {k}</th><td>1</td><td>x</td><td>y</td></tr>",
]
TABLE_HEAD = ("<html><table class=\"menu\"><tbody><tr><td>a</td><td>1</td><td>b</td><td>c</td></tr></tbody></table>"
              "<table class='table table-striped'><thead><tr><th>Trạm</th><th>AQI</th><th>Loại</th><th>Giờ</th></tr></thead><tbody>")
PLAIN_HEAD = "<html><table><tr><th>Trạm</th><th>AQI</th><th>Loại</th><th>Giờ</th></tr>"


def q45_table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.col("o_custkey") % 3 == 0   # no class and no tbody: all rows of the first table
    pages = _pages(spark, sf_dir, _by_key(ROWS), F.when(plain, PLAIN_HEAD).otherwise(TABLE_HEAD),
                   F.when(plain, "</table><p>foot</p>").otherwise("</tbody></table></html>"))
    return html_tables(pages, keep=("o_custkey", "block")).select(
        "o_custkey", "block", "station_name", "aqi_value", "category", "published_time")


Q45 = f"""
with o as (select o_custkey, o_orderkey // {BLOCK} as block, o_orderkey % 6 as kind, cast(o_orderkey as varchar) as k from orders)
select o_custkey, block, case kind when 1 then 'Sóc ' else 'Bến ' end || k as station_name,
       case kind when 1 then cast(k as double) end as aqi_value,
       case kind when 1 then 'Kémin ' || k else 'Xấu' end as category,
       -- a nested table's cells are cells of the row around it
       case kind when 1 then 'in ' || k else '10:00' end as published_time
from o where kind in (1, 2)
"""


# ---------------------------------------------------------------------------
# Q46: bronze -> silver -> gold as files (T-20 T-21 T-22 S12 A9)
# ---------------------------------------------------------------------------

def q46_lake_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    first = run_bronze_to_silver(events_as_raw_aqi(table(spark, sf_dir, "events")), silver, source_tz=None,
                                 value_type="decimal(12,4)")
    again = run_bronze_to_silver(events_as_raw_aqi(table(spark, sf_dir, "events")), silver, source_tz=None,
                                 value_type="decimal(12,4)")   # a rerun replaces the table
    written = run_silver_to_gold(spark, silver, gold)
    monthly = spark.read.parquet(f"{gold}/monthly_risk_index")
    return monthly.select(
        "city_name", "year", "month", F.col("avg_monthly_aqi").cast("double").alias("avg_monthly_aqi"),
        F.col("risk_index_pct").cast("double").alias("risk_index_pct"), "total_station_days", "risk_tier",
        F.lit(first["read"]).alias("rows_read"), F.lit(again["written"]).alias("rows_silver"),
        spark.read.parquet(silver).select(F.count(F.lit(1))).scalar().alias("rows_in_lake"),
        F.lit(written["daily"]).alias("rows_daily"), F.lit(written["monthly"]).alias("rows_monthly"))


Q46 = f"""
with m as ({GOLD_ORACLE['q19_monthly_index']}), d as ({GOLD_ORACLE['q18_daily_summary']})
select m.*, (select count(*) from events) as rows_read,
       (select count(*) from events where event_id % 31 <> 0) as rows_silver,
       (select count(*) from events where event_id % 31 <> 0) as rows_in_lake,
       (select count(*) from d) as rows_daily, (select count(*) from m) as rows_monthly
from m
"""


# ---------------------------------------------------------------------------
# Q47: named map features (T-7 F7 N5)
# ---------------------------------------------------------------------------

def q47_geo_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as map nodes in JSON documents: padded, blank and missing
    names, missing places; of a repeated tag the last value counts."""
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, '"name": "  "').when(k % 5 == 1, '"other": "x"') \
        .otherwise(F.concat(F.lit('"name": "old", "name": " '), "c_name", F.lit(' "')))
    lat = F.when(k % 7 != 0, F.concat(F.lit('"lat": '), F.col("c_nationkey").cast("string"), F.lit(".25, "))).otherwise("")
    node = F.concat(F.lit('{"type": "node", "id": '), k.cast("string"), F.lit(", "), lat, F.lit('"lon": 105.5, "tags": {"amenity": " '),
                    "c_mktsegment", F.lit('", '), name, F.lit("}}"))
    docs = table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 64").alias("block")).agg(
        F.concat(F.lit('{"elements": ['), F.array_join(F.collect_list(node), ", "), F.lit("]}")).alias("doc"))
    flat = flatten_elements(docs).select(
        F.col("node_id").cast("string").alias("node_id"), F.col("latitude").cast("string").alias("latitude"),
        F.col("longitude").cast("string").alias("longitude"), "amenity_type", "name",
        F.lit("2024-04-12 00:00:00").alias("_extracted_at"))
    s = stg_geo_features(flat)
    return s.select("osm_id", "feature_name", "feature_type", F.col("latitude").cast("double").alias("latitude"),
                    F.col("longitude").cast("double").alias("longitude"), ntz("ingested_at").alias("ingested_at"))


Q47 = """
select c_custkey as osm_id, case when c_custkey % 5 = 1 then 'Unknown' else c_name end as feature_name,
       lower(c_mktsegment) as feature_type, c_nationkey + 0.25 as latitude, 105.5 as longitude,
       timestamp '2024-04-12 00:00:00' as ingested_at
from customer where c_custkey % 5 <> 0 and c_custkey % 7 <> 0
"""
Q47 = Q47.replace("c_nationkey + 0.25 as", "cast(c_nationkey + 0.25 as double) as").replace("105.5 as", "cast(105.5 as double) as")


# ---------------------------------------------------------------------------
# Q48 / Q49: whole dimensions against the readings (T-14, T-13)
# ---------------------------------------------------------------------------

def q48_pollutant_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dim_pollutant(seed_frame(spark, "pollutant_standards"))
    readings = table(spark, sf_dir, "events").withColumn("code", F.element_at(map_lit(CODE_OF_TYPE), F.col("event_type")))
    counts = readings.groupBy("code").agg(F.count(F.lit(1)).alias("n_readings"))
    return dim.join(counts, dim["pollutant_code"] == counts["code"], "left").drop("code").withColumn(
        "n_readings", F.coalesce("n_readings", F.lit(0)))


def _seed_values(name: str) -> tuple[str, str]:
    rows = seed_rows(name)
    quote = lambda v: "null" if v == "" else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(quote(v) for v in r.values()) + ")" for r in rows), ", ".join(rows[0])


_VALUES, _NAMES = _seed_values("pollutant_standards")
_DOUBLES = _NAMES.split(", ")[3:]
Q48 = f"""
with s as (select * from (values {_VALUES}) t({_NAMES})),
c as (select {sql_case('event_type', CODE_OF_TYPE)} as code, count(*) as n from events group by 1)
select md5(pollutant_code) as pollutant_sk, pollutant_code, pollutant_name, unit,
       {', '.join(f'cast({d} as double) as {d}' for d in _DOUBLES)}, coalesce(n, 0) as n_readings
from s left join c on c.code = s.pollutant_code
"""


def q49_time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy(F.to_date(shifted("o_orderdate")).alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    dim = dim_time(spark)
    return dim.join(counts, dim["date_key"] == counts["day"], "left").drop("day").withColumn(
        "n_orders", F.coalesce("n_orders", F.lit(0)))


Q49 = f"""
with s as (select cast(unnest(range(date '2024-01-01', date '2027-01-01', interval 1 day)) as date) as d),
c as (select cast(o_orderdate + interval 29 year as date) as day, count(*) as n from orders group by 1)
select d as date_key, year(d) as year, quarter(d) as quarter, month(d) as month, extract('week' from d) as week_of_year,
       dayofweek(d) as day_of_week, day(d) as day_of_month, dayofyear(d) as day_of_year, {MONTHS_SQL} as month_name_vi,
       {SEASON_SQL} as season_vi, dayofweek(d) in (0, 6) as is_weekend, coalesce(n, 0) as n_orders
from s left join c on c.day = s.d
"""


# ---------------------------------------------------------------------------
# Q50: the rows that break a rule (QT5)
# ---------------------------------------------------------------------------

def q50_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 97 != 0, F.col("event_type")).alias("event_type"), "value",
        F.floor("value").cast("long").alias("whole"))
    checked = {
        "range": Rule("accepted_range", "value", min_value=1, max_value=150), "null": Rule("not_null", "event_type"),
        "values": Rule("accepted_values", "event_type", values=("click", "view", "purchase", "signup")),
        "expression": Rule("expression", "value", condition="event_type = 'view' and value > 100"),
        "unique": Rule("unique", "whole")}
    return rows_by_rule(ev, checked).select("rule", "event_id")


Q50 = """
with e as (select event_id, case when event_id % 97 <> 0 then event_type end as event_type, value,
                  cast(floor(value) as bigint) as whole from events)
select 'range' as rule, event_id from e where value < 1 or value > 150
union all select 'null', event_id from e where event_id % 97 = 0
union all select 'values', event_id from e where event_type = 'error'
union all select 'expression', event_id from e where event_type = 'view' and value > 100
union all select 'unique', event_id from e where whole in (select whole from e group by 1 having count(*) > 1)
"""


# ---------------------------------------------------------------------------
# Q51: keyed JSON records
# ---------------------------------------------------------------------------

def q51_keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "keyed")
    good = validate(messages(spark, sf_dir)).where("status = 'valid'").select("message.*")
    publish(good, fmt="json", path=path)
    back = read_source(spark, path, "key string, value string", fmt="json")
    return back.select("key", F.get_json_object("value", "$.location_name").alias("location_name"),
                       F.get_json_object("value", "$.value").cast("double").alias("value"),
                       F.get_json_object("value", "$.date_utc").cast("timestamp_ntz").alias("date_utc"))


Q51 = f"""
select user_id || '_' || param as key, 'Station ' || user_id as location_name, v as value, ts as date_utc
from ({MESSAGE_SQL}) where reason is null
"""


# ---------------------------------------------------------------------------
# Q52: CSV feed; an empty one is an error
# ---------------------------------------------------------------------------

def q52_csv_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    full, empty = scratch_path(spark, "fires"), scratch_path(spark, "no-fires")
    ev = table(spark, sf_dir, "events")
    none = F.lit(None).cast("string")
    feed = ev.select(
        F.lit("10.5").alias("latitude"), F.lit("106.5").alias("longitude"), none.alias("bright_ti4"), none.alias("scan"),
        none.alias("track"), F.to_date("ts").cast("string").alias("acq_date"), F.date_format("ts", "HHmm").alias("acq_time"),
        F.concat(F.lit('a, "b" '), "event_type").alias("satellite"), none.alias("instrument"), none.alias("confidence"),
        none.alias("version"), none.alias("bright_ti5"), F.col("value").cast("string").alias("frp"), none.alias("daynight"))
    feed.write.option("header", "true").option("escape", '"').csv(full)
    feed.where("false").write.option("header", "true").csv(empty)
    try:
        read_feed_csv(spark, empty)
        failed = False
    except EmptyFeedError:
        failed = True
    # an empty feed is an error; the caller serves the last good one
    back = read_source(spark, full, None, fmt="csv", header="true", escape='"')
    back = back.select("acq_date", "acq_time", "satellite", F.col("frp").cast("double").alias("frp"))
    n = read_feed_csv(spark, full).select(F.count(F.lit(1))).scalar()
    return back.withColumns({"empty_failed": F.lit(failed), "n_rows": n})


Q52 = """
select cast(cast(ts as date) as varchar) as acq_date, strftime(ts, '%H%M') as acq_time, 'a, "b" ' || event_type as satellite,
       value as frp, true as empty_failed, (select count(*) from events) as n_rows
from events
"""


# ---------------------------------------------------------------------------
# Q53: several landed JSON batches as one relation, in the query box
# ---------------------------------------------------------------------------

def q53_batches_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.lit(7.0) + F.col("c_nationkey") * 0.75).alias("lat"), (F.lit(101.0) + F.col("c_custkey") % 11).alias("lon"))
    paths = []
    for i in range(3):
        paths.append(scratch_path(spark, f"batch{i}"))
        c.where(F.col("c_custkey") % 3 == i).write.json(paths[-1])
    back = read_source(spark, paths, "c_custkey long, lat double, lon double", fmt="json")
    return back.where(in_box("lat", "lon", rules.QUERY_BOX))


Q53 = """
select c_custkey, 7.0 + c_nationkey * 0.75 as lat, 101.0 + c_custkey % 11 as lon from customer
where 7.0 + c_nationkey * 0.75 between 8.18 and 23.39 and 101.0 + c_custkey % 11 between 102.14 and 109.46
"""
Q53 = Q53.replace("7.0 + c_nationkey * 0.75 as lat, 101.0 + c_custkey % 11 as lon",
                  "cast(7.0 + c_nationkey * 0.75 as double) as lat, cast(101.0 + c_custkey % 11 as double) as lon")


# ---------------------------------------------------------------------------
# Q54: landing: success, rerun, empty, failed (S13 S14 S11), run statistics
# ---------------------------------------------------------------------------

RUN = datetime(2024, 2, 1, 6, 0, 0)


def q54_landing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, log = scratch_path(spark, "lake"), scratch_path(spark, "runlog")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    land(o, "orders", RUN, "daily", lake, log)
    land(o, "orders", RUN, "daily", lake, log)                            # a retry replaces its files and its log row
    land(o.where("o_orderstatus = 'none'"), "nothing", RUN, "daily", lake, log)
    # a lake below a file cannot be written
    blocked = scratch_path(spark, "blocked")
    put(spark, blocked, "a file")
    land(o, "broken", RUN, "daily", blocked, log)
    rows = spark.read.parquet(f"{lake}/orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    counted, seen = observe_counts(validate(messages(spark, sf_dir)).select("status"), "messages")
    stats = status_counts(counted).first()
    extra = spark.range(1).select(
        F.lit("messages").alias("what"), F.lit("").alias("status"), F.lit(seen.get["rows"]).alias("n"),
        F.lit(stats["valid_count"]).alias("valid"), F.lit(stats["pass_rate_pct"]).alias("pass_rate"))
    runs = spark.read.parquet(log).select(F.col("source_name").alias("what"), "status", F.col("row_count").alias("n"))
    lake_rows = rows.select(F.lit("lake").alias("what"), F.col("o_orderstatus").alias("status"), "n")
    return runs.unionByName(lake_rows).unionByName(extra, allowMissingColumns=True)


Q54 = f"""
with m as ({MESSAGE_SQL})
select 'orders' as what, 'SUCCESS' as status, (select count(*) from orders) as n, null::bigint as valid, null::double as pass_rate
union all select 'nothing', 'EMPTY', 0, null, null
union all select 'broken', 'FAILED', 0, null, null
union all select 'lake', o_orderstatus, count(*), null, null from orders group by 2
union all select 'messages', '', count(*), count(*) filter (where reason is null),
  round(100.0 * count(*) filter (where reason is null) / count(*), 1) from m
"""

QUERIES = {
    "q44_list_pages": q44_list_pages, "q45_table_pages": q45_table_pages, "q46_lake_jobs": q46_lake_jobs,
    "q47_geo_features": q47_geo_features, "q48_pollutant_dim": q48_pollutant_dim, "q49_time_dim": q49_time_dim,
    "q50_failing_rows": q50_failing_rows, "q51_keyed_json": q51_keyed_json, "q52_csv_feed": q52_csv_feed,
    "q53_batches_in_box": q53_batches_in_box, "q54_landing_log": q54_landing_log,
}
ORACLE = {
    "q44_list_pages": Q44, "q45_table_pages": Q45, "q46_lake_jobs": Q46, "q47_geo_features": Q47,
    "q48_pollutant_dim": Q48, "q49_time_dim": Q49, "q50_failing_rows": Q50, "q51_keyed_json": Q51,
    "q52_csv_feed": Q52, "q53_batches_in_box": Q53, "q54_landing_log": Q54,
}
