"""Check queries Q1-Q9 and the shared adapters that present the driver
tables in the shape of the raw feeds.

Column roles on the driver tables:

* ``events``: ts = measured time, user_id = station, event_type = pollutant
  (or, for the city-level summaries, the place series), value = reading.
* ``customer`` x ``nation`` x ``region``: stations' places (a station's
  city is its nation name).
* ``orders``: official daily index feed, bulletins and change rows.
* ``lineitem`` x ``supplier``: river readings x river stations.
* ``documents``: bulletin text; ``pages``: raw HTML.

Every query reads whole tables; nothing is sampled or capped. Outputs use
portable types (double, bigint, string, date, timestamp without zone).
Values the reference keeps as decimals are computed as decimals (exact,
so independent of partitioning) and cast to double at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import disaster_type, surrogate_key
from airshed.operators.cleaning import drop_all_null, null_out_of_range
from airshed.operators.joins import join_dim
from airshed.plans.gold import clean_air_quality
from airshed.plans.marts import dim_disaster_type, enrich_dates
from airshed.plans.staging import stg_air_quality, stg_weather
from airshed.session import scratch_path
from airshed.sources.readers import date_spine_from, read_csv_table


def sround(expr: str, digits: int) -> str:
    """DuckDB SQL rounding a double the way Spark does (half-up on the
    shortest decimal form of the double)."""
    return f"cast(round(cast({expr} as decimal(38, 12)), {digits}) as double)"


def half_up_div_sql(num: str, den: str) -> str:
    """DuckDB SQL: integer num / positive integer den, rounded half away
    from zero (exact, no floating point)."""
    return f"(sign({num}) * ((2 * abs({num}) + {den}) // (2 * {den})))"


def spark_avg_sql(col: str, scale: int, digits: int) -> tuple[str, str]:
    """DuckDB SQL for Spark's ``round(avg(decimal(p, scale)), digits)``,
    computed exactly: Spark's average of a decimal is the quotient rounded
    half-up to ``scale + 4`` decimals, which is then rounded to ``digits``.
    Returns (average in units of 10^-(scale+4) as an integer expression,
    the rounded value as a double)."""
    total = f"cast(round(sum({col}) * {10 ** scale}) as hugeint)"
    units = half_up_div_sql(f"({total} * 10000)", f"count({col})")
    step = 10 ** (scale + 4 - digits)
    rounded = half_up_div_sql(units, str(step))
    return units, f"(cast({rounded} as double) / {10 ** digits})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, with the partitions its files give."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dbl(c: str | Column, digits: int | None = None) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return (F.round(x, digits) if digits is not None else x).cast("double")


def ntz(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


# Shift that moves the 1995-2001 order/lineitem dates onto the 2024 event
# dates, so the full outer joins see matched and unmatched keys.
SHIFT = "INTERVAL 29 YEARS"


def shifted(c: str) -> Column:
    return F.col(c) + F.expr(SHIFT)


def map_lit(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def sql_case(col: str, d: dict, default: str = "null") -> str:
    arms = " ".join(f"when {col} = '{k}' then '{v}'" for k, v in d.items())
    return f"case {arms} else {default} end"


def ladder_sql(value: str, cuts, last: str) -> str:
    """Label of the first cut of a fixed list that holds for ``value``, by
    joining the labels' list with the number of cuts that fail."""
    labels = ", ".join(f"'{label}'" for _, _, label in cuts)
    tests = ", ".join(f"{value} {op} {bound}" for op, bound, _ in cuts)
    return f"(case when {value} is null then '{last}' else coalesce(([{labels}])[list_position([{tests}], true)], '{last}') end)"


def sql_keyword_case(fields: dict[str, str], rules_list, default: str, lower: bool = True) -> str:
    """The SQL CASE an ordered keyword rule list stands for."""
    arms = []
    for rule in rules_list:
        if len(rule) == 2:
            words, label = rule
            names = tuple(fields)
        else:
            words, names, label = rule
        conds = []
        for n in names:
            src = f"lower({fields[n]})" if lower else fields[n]
            conds += [f"{src} like '%{w}%'" for w in words]
        arms.append(f"when {' or '.join(conds)} then '{label}'")
    return f"case {' '.join(arms)} else {default} end"


# ---------------------------------------------------------------------------
# Shared adapters
# ---------------------------------------------------------------------------

def station_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer (station) x nation (city). nation is the fixed 25-row TPC-H
    table, so it is broadcast. customer grows with the data: the join of
    the readings with it is AQE's to plan."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).drop("c_nationkey")


# Event type -> pollutant code of the air-quality feed.
CODE_OF_TYPE = {"click": "pm25", "view": "pm10", "purchase": "o3", "signup": "no2", "error": "co"}


# Nations whose stations spell a known city; one has no city at all.
CITY_OF_NATION = {0: ("hanoi", "Hà Nội"), 1: ("Ho Chi Minh City", "Hồ Chí Minh"), 2: ("DA NANG", "Đà Nẵng"),
                  3: ("Hai Phong", "Hải Phòng"), 4: ("haiphong", "Hải Phòng"), 5: ("Can Tho", "Cần Thơ"),
                  6: ("ho chi minh", "Hồ Chí Minh"), 7: (None, "Unknown")}
NULL_EVERY, NEGATIVE_EVERY, NO_STATION_EVERY = 17, 19, 43


def city_spelling() -> Column:
    out = F.col("n_name")
    for k, (spelling, _) in CITY_OF_NATION.items():
        out = F.when(F.col("n_nationkey") == k, F.lit(spelling)).otherwise(out)
    return out


def air_quality_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the raw (all-text) air-quality feed: the code arrives
    upper-cased and padded (' PM25 '), some cities in other spellings or
    missing, some values missing or negative, some station ids missing."""
    ev = table(spark, sf_dir, "events")
    pl = station_places(spark, sf_dir)
    j = ev.join(pl, ev["user_id"] == pl["c_custkey"])
    return j.select(
        F.when(F.col("event_id") % NO_STATION_EVERY != 0, F.col("user_id").cast("string")).alias("location_id"),
        F.col("c_name").alias("location_name"),
        city_spelling().alias("city"),
        (F.lit(8.0) + F.col("n_nationkey") * 0.5).cast("string").alias("latitude"),
        (F.lit(102.0) + F.col("n_regionkey") * 1.5).cast("string").alias("longitude"),
        F.concat(F.lit(" "), F.upper(F.element_at(map_lit(CODE_OF_TYPE), F.col("event_type"))),
                 F.lit(" ")).alias("parameter"),
        F.when(F.col("event_id") % NULL_EVERY != 0,
               F.when(F.col("event_id") % NEGATIVE_EVERY == 0, -F.col("value")).otherwise(F.col("value")))
         .cast("string").alias("value"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.lit("ppm")).alias("unit"),
        F.col("ts").cast("string").alias("last_updated"),
        F.col("ts").cast("string").alias("_extracted_at"),
    )


CITY_SQL = "case n.n_nationkey " + " ".join(f"when {k} then '{name}'" for k, (_, name) in CITY_OF_NATION.items()) \
    + " else n.n_name end"
AIR_SQL = f"""
select case when e.event_id % {NO_STATION_EVERY} <> 0 then cast(e.user_id as integer) end as station_id, c.c_name as station_name, {CITY_SQL} as city,
       cast(8 + n.n_nationkey * 0.5 as decimal(10, 6)) as latitude,
       cast(102 + n.n_regionkey * 1.5 as decimal(10, 6)) as longitude,
       lower(trim(' ' || upper({sql_case('e.event_type', CODE_OF_TYPE)}) || ' ')) as pollutant_code,
       cast(e.value as decimal(12, 4)) as measurement_value,
       coalesce(case when e.event_type = 'error' then null else 'ppm' end, 'µg/m³') as unit,
       e.ts as measured_at_utc, e.ts as ingested_at
from events e join customer c on e.user_id = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
where e.event_id % {NULL_EVERY} <> 0 and (e.event_id % {NEGATIVE_EVERY} <> 0 or e.value <= 0)
"""

# Priority -> official category text (the feed's Vietnamese wording).
PRIORITY_CATEGORY = {
    "1-URGENT": "Rất xấu", "2-HIGH": "Xấu", "3-MEDIUM": "Kém",
    "4-NOT SPECIFIED": "Trung bình", "5-LOW": "Tốt",
}


def cem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the official-index crawl: one reading per order, the
    customer's city as station (some station names contain a known city),
    index = floor(price) mod 500 as float text (some missing), priority as category text
    (some of the worst class, some unknown), the shifted order date as
    bulletin time (some unreadable)."""
    o = table(spark, sf_dir, "orders")
    pl = station_places(spark, sf_dir)
    j = o.join(pl, o["o_custkey"] == pl["c_custkey"])
    t = shifted("o_orderdate")
    key = F.col("o_orderkey")
    station = F.when(F.col("n_nationkey") == 0, "Trạm Hà Nội 1").when(F.col("n_nationkey") == 3, "KK Hải Phòng") \
        .otherwise(F.col("n_name"))
    return j.select(
        station.alias("station_name"),
        F.when(key % 17 != 0, F.concat((F.floor("o_totalprice") % 500).cast("string"), F.lit(".0"))).alias("aqi_value"),
        F.when(key % 13 == 0, " Nguy hại ").when(key % 29 == 0, "không rõ")
         .otherwise(F.element_at(map_lit(PRIORITY_CATEGORY), F.col("o_orderpriority"))).alias("category"),
        F.when(key % 11 == 0, "đang cập nhật")
         .otherwise(F.concat(F.lit("Cập nhật "), F.date_format(t, "HH:mm dd/MM/yyyy"))).alias("published_time"),
        t.cast("string").alias("_crawled_at"),
    )


# what each category text stands for
CODE_OF_PRIORITY = {"1-URGENT": "very_unhealthy", "2-HIGH": "unhealthy", "3-MEDIUM": "unhealthy_sg",
                    "4-NOT SPECIFIED": "moderate", "5-LOW": "good"}
CEM_SQL = f"""
select case n.n_nationkey when 0 then 'Trạm Hà Nội 1' when 3 then 'KK Hải Phòng' else n.n_name end as station_name,
       case n.n_nationkey when 0 then 'Hà Nội' when 3 then 'Hải Phòng' else n.n_name end as city_name,
       cast(floor(o.o_totalprice) as bigint) % 500 as aqi_value,
       case when o.o_orderkey % 13 = 0 then 'hazardous' when o.o_orderkey % 29 = 0 then 'unknown'
            else {sql_case('o.o_orderpriority', CODE_OF_PRIORITY)} end as aqi_category,
       case when o.o_orderkey % 11 <> 0 then o.o_orderdate + INTERVAL 29 YEAR end as measured_at
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
where o.o_orderkey % 17 <> 0
"""


# ---------------------------------------------------------------------------
# Q1: seed CSV scan with header + join by key to counts
# ---------------------------------------------------------------------------

NATION_SEED_SCHEMA = "n_nationkey int, n_name string, n_regionkey int"


def q01_seed_csv_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "seed-nation")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey") \
        .coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    seed = read_csv_table(spark, path, NATION_SEED_SCHEMA)
    region = table(spark, sf_dir, "region")
    counts = (table(spark, sf_dir, "customer")
              .groupBy("c_nationkey")
              .agg(F.count(F.lit(1)).alias("n_customers"),
                   F.round(F.avg(F.col("c_acctbal").cast("decimal(12,2)")), 2).alias("avg_acctbal")))
    # counts has one row per nation key: bounded by the fixed nation table
    j = (seed.join(F.broadcast(region), seed["n_regionkey"] == region["r_regionkey"])
             .join(F.broadcast(counts), seed["n_nationkey"] == counts["c_nationkey"], "left"))
    return j.select("r_name", "n_name", F.coalesce("n_customers", F.lit(0)).alias("n_customers"),
                    dbl("avg_acctbal").alias("avg_acctbal"))


Q01 = f"""
select r.r_name, n.n_name, coalesce(c.n_customers, 0) as n_customers, c.avg_acctbal
from nation n join region r on n.n_regionkey = r.r_regionkey
left join (select c_nationkey, count(*) as n_customers,
                  {spark_avg_sql('cast(c_acctbal as decimal(12, 2))', 2, 2)[1]} as avg_acctbal
           from customer group by 1) c on c.c_nationkey = n.n_nationkey
"""


# ---------------------------------------------------------------------------
# Q2: inline hazard-type table with keys, joined to classified text
# ---------------------------------------------------------------------------

def doc_title(c: str = "text") -> Column:
    return F.substring_index(F.col(c), "\n", 1)


# Headlines in the feed's language: text, hazard type, severity. A document
# whose id falls on one has it as title (and its text as summary, if the
# headline's type outranks whatever the text may hold).
HEADLINES = [
    ("Tin BÃO khẩn cấp trên biển Đông", "storm", "extreme"),
    ("Cảnh báo lũ quét", "flood", "high"),
    ("Nguy cơ sạt lở bờ sông", "landslide", "normal"),
    ("Tin động đất rất mạnh", "earthquake", "extreme"),
    ("Hạn hán kéo dài", "drought", "normal"),
    ("Triều cường dâng, cảnh báo ngập", "high_tide", "high"),
    ("Rét đậm, rét hại", "cold_wave", "normal"),
    ("Nắng nóng mạnh diện rộng", "heatwave", "high"),
    ("Mưa giông về chiều", "thunderstorm", "normal"),
    ("Lốc xoáy khẩn cấp", "thunderstorm", "extreme"),
    ("Thông báo định kỳ", "other", "normal"),
]
#: every HEADLINE_EVERY-th document has no headline, but its own first line
HEADLINE_EVERY = 12


def bulletin_title() -> Column:
    k = F.col("doc_id") % HEADLINE_EVERY
    out = doc_title()
    for i, (text, _, _) in enumerate(HEADLINES):
        out = F.when(k == i, F.lit(text)).otherwise(out)
    return out


def bulletin_summary() -> Column:
    """The document's text; under a headline a line without any key word."""
    return F.when(F.col("doc_id") % HEADLINE_EVERY < len(HEADLINES), F.lit("Chi tiết trong bản tin.")).otherwise(F.col("text"))


def headline_sql(field: int, otherwise: str) -> str:
    arms = " ".join(f"when {i} then '{h[field]}'" for i, h in enumerate(HEADLINES))
    return f"case doc_id % {HEADLINE_EVERY} {arms} else {otherwise} end"


def q02_disaster_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(bulletin_title().alias("title"), bulletin_summary().alias("summary"))
    typed = docs.select(disaster_type("title", "summary").alias("disaster_code"))
    counts = typed.groupBy("disaster_code").agg(F.count(F.lit(1)).alias("n_documents"))
    dim = dim_disaster_type(spark)
    # counts has at most one row per rule label (+ the default): bounded
    j = join_dim(dim, counts, "disaster_code", how="left", broadcast=True)
    return j.select("disaster_type_sk", "disaster_code", "disaster_name_en", "disaster_name_vi", "category",
                    F.coalesce("n_documents", F.lit(0)).alias("n_documents"))


DOC_TITLE_SQL = "split_part(text, chr(10), 1)"
# a document without a headline: the words its text may hold by chance
TYPE_SQL = headline_sql(1, f"""(case when lower(text) like '%bão%' then 'storm' when lower(text) like '%lũ%' then 'flood'
  when lower({DOC_TITLE_SQL}) like '%rét%' then 'cold_wave' else 'other' end)""")
SEV_SQL = headline_sql(2, "'normal'")

DISASTER_VALUES = ", ".join(
    "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rules.DISASTER_TYPES)

Q02 = f"""
with dim as (select md5(coalesce(cast(disaster_code as varchar), '{rules.SURROGATE_NULL}')) as disaster_type_sk, *
             from (values {DISASTER_VALUES}) as t(disaster_code, disaster_name_en, disaster_name_vi, category)),
counts as (select {TYPE_SQL} as disaster_code, count(*) as n_documents from documents group by 1)
select dim.*, coalesce(counts.n_documents, 0) as n_documents
from dim left join counts on dim.disaster_code = counts.disaster_code
"""


# ---------------------------------------------------------------------------
# Q3: date dimension over the order date range (S8 D-3 D-4 D-5)
# ---------------------------------------------------------------------------

def q03_date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("start"),
        F.date_add(F.max(F.to_date("o_orderdate")), 1).alias("end"))
    return enrich_dates(date_spine_from(bounds, "start", "end"), "date_day")


MONTHS_SQL = "case month(d) " + " ".join(
    f"when {i + 1} then '{m}'" for i, m in enumerate(rules.MONTH_NAMES_VI)) + " end"
SEASON_SQL = "case " + " ".join(
    f"when month(d) in ({', '.join(map(str, ms))}) then '{lab}'" for ms, lab in rules.SEASONS_VI
) + f" else '{rules.SEASON_DEFAULT_VI}' end"

Q03 = f"""
with s as (select cast(unnest(range(min(cast(o_orderdate as date)),
                                    max(cast(o_orderdate as date)) + interval 1 day,
                                    interval 1 day)) as date) as d from orders)
select d as date_key, year(d) as year, quarter(d) as quarter, month(d) as month,
       extract('week' from d) as week_of_year, dayofweek(d) as day_of_week, day(d) as day_of_month,
       dayofyear(d) as day_of_year, {MONTHS_SQL} as month_name_vi, {SEASON_SQL} as season_vi,
       dayofweek(d) in (0, 6) as is_weekend
from s
"""


# ---------------------------------------------------------------------------
# Q4: staging of the air-quality feed (P1 P2 F1 T1 T8 D-7)
# ---------------------------------------------------------------------------

def q04_stage_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stg_air_quality(air_quality_raw(spark, sf_dir))
    return s.select("station_id", "station_name", "city", dbl("latitude").alias("latitude"),
                    dbl("longitude").alias("longitude"), "pollutant_code",
                    dbl("measurement_value").alias("measurement_value"), "unit",
                    ntz("measured_at_utc").alias("measured_at_utc"), ntz("ingested_at").alias("ingested_at"),
                    F.lpad(F.col("station_id").cast("string"), 4, "0").alias("station_code"))


Q04 = f"""
select station_id, station_name, city, cast(latitude as double) as latitude,
       cast(longitude as double) as longitude, pollutant_code,
       cast(measurement_value as double) as measurement_value, unit, measured_at_utc, ingested_at,
       lpad(cast(station_id as varchar), 4, '0') as station_code
from ({AIR_SQL})
"""


# ---------------------------------------------------------------------------
# Q5: local -> UTC shift and partition parts (P5 D-8)
# ---------------------------------------------------------------------------

def q05_utc_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("station_code"), F.lit("aqi").alias("pollutant"),
        F.col("o_totalprice").alias("measurement_value"), F.col("o_orderdate").alias("extracted_at"))
    c = clean_air_quality(o, bounds={"aqi": (0.0, 1e12)}, source_tz=rules.SOURCE_TIMEZONE)
    return c.select(F.col("station_code").cast("long").alias("o_orderkey"),
                    ntz("extracted_at").alias("extracted_at"), "year", "month", "day")


Q05 = """
select o_orderkey, o_orderdate - interval 7 hour as extracted_at,
       cast(year(o_orderdate - interval 7 hour) as integer) as year,
       cast(month(o_orderdate - interval 7 hour) as integer) as month,
       cast(day(o_orderdate - interval 7 hour) as integer) as day
from orders
"""


# ---------------------------------------------------------------------------
# Q6: surrogate keys over one and two columns
# ---------------------------------------------------------------------------

def q06_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", surrogate_key("user_id").alias("station_sk"),
                     surrogate_key("event_type", F.to_date("ts")).alias("type_day_sk"))


NULLK = rules.SURROGATE_NULL
Q06 = f"""
select event_id, md5(coalesce(cast(user_id as varchar), '{NULLK}')) as station_sk,
       md5(coalesce(cast(event_type as varchar), '{NULLK}') || '-' ||
           coalesce(cast(cast(ts as date) as varchar), '{NULLK}')) as type_day_sk
from events
"""


# ---------------------------------------------------------------------------
# Q7: weather staging with the temperature outlier filter (F2)
# ---------------------------------------------------------------------------

def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("city"),
        F.col("l_discount").cast("string").alias("latitude"),
        F.col("l_tax").cast("string").alias("longitude"),
        F.col("l_shipdate").cast("string").alias("time"),
        (F.col("l_quantity") - 20).cast("string").alias("temperature_2m"),
        F.col("l_linenumber").cast("string").alias("relative_humidity_2m"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax").cast("string")).alias("precipitation"),
        F.col("l_discount").cast("string").alias("wind_speed_10m"),
        F.lit(None).cast("string").alias("wind_direction_10m"),
        F.lit(None).cast("string").alias("uv_index"),
        F.col("l_extendedprice").cast("string").alias("surface_pressure"),
        F.col("l_shipdate").cast("string").alias("_extracted_at"),
    )


WEATHER_DEC_COLS = ["latitude", "longitude", "temperature_celsius", "humidity_percent", "precipitation_mm",
                    "wind_speed_kmh", "wind_direction_deg", "uv_index", "surface_pressure_hpa"]


def q07_weather_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stg_weather(weather_raw(spark, sf_dir))
    return s.select("city_name", *[dbl(c).alias(c) for c in WEATHER_DEC_COLS],
                    ntz("observed_at").alias("observed_at"), ntz("ingested_at").alias("ingested_at"))


Q07 = """
select l_returnflag as city_name,
       cast(cast(l_discount as decimal(10, 6)) as double) as latitude,
       cast(cast(l_tax as decimal(10, 6)) as double) as longitude,
       cast(cast(l_quantity - 20 as decimal(6, 2)) as double) as temperature_celsius,
       cast(cast(l_linenumber as decimal(5, 2)) as double) as humidity_percent,
       cast(coalesce(case when l_linestatus = 'O' then cast(l_tax as decimal(8, 2)) end, 0) as double)
           as precipitation_mm,
       cast(cast(l_discount as decimal(6, 2)) as double) as wind_speed_kmh,
       cast(null as double) as wind_direction_deg,
       cast(0 as double) as uv_index,
       cast(cast(l_extendedprice as decimal(8, 2)) as double) as surface_pressure_hpa,
       l_shipdate as observed_at, l_shipdate as ingested_at
from lineitem
where l_shipdate is not null and cast(l_quantity - 20 as decimal(6, 2)) between -10 and 50
"""


# ---------------------------------------------------------------------------
# Q8: all-null key drop and per-code range check
# ---------------------------------------------------------------------------

EVENT_BOUNDS = {"click": (0.0, 100.0), "view": (0.0, 200.0), "purchase": (10.0, 300.0), "signup": (0.0, 50.0)}


def q08_range_nulling(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = lambda c, m: F.when(F.col("event_id") % m != 0, c)
    ev = table(spark, sf_dir, "events").select(
        "event_id", blank(F.col("user_id").cast("string"), 7).alias("station_code"),
        blank(F.col("event_type"), 14).alias("pollutant"), blank(F.col("value"), 21).alias("measurement_value"))
    out = null_out_of_range(drop_all_null(ev), "pollutant", "measurement_value", EVENT_BOUNDS)
    return out.select("event_id", F.col("pollutant").alias("event_type"),
                      F.col("measurement_value").alias("value_clean"))


Q08 = """
with e as (select event_id, case when event_id % 7 <> 0 then user_id end as station,
                  case when event_id % 14 <> 0 then event_type end as event_type,
                  case when event_id % 21 <> 0 then value end as value from events),
b as (select * from (values ('click', 0, 100), ('view', 0, 200), ('purchase', 10, 300), ('signup', 0, 50)) t(kind, lo, hi))
select event_id, event_type, case when b.kind is null or value between lo and hi then value end as value_clean
from e left join b on b.kind = e.event_type
where station is not null or event_type is not null or value is not null
"""


# ---------------------------------------------------------------------------
# Q9: freshness window before the latest time (F18 A11 D-11)
# ---------------------------------------------------------------------------

def q09_recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    log = ev.select(F.col("event_type").alias("source_name"),
                    F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
                    F.col("ts").cast("timestamp").alias("logged_at"))
    as_of = ev.select(F.max(F.col("ts").cast("timestamp"))).scalar()
    recent = log.filter((F.col("status") == "SUCCESS")
                        & (F.col("logged_at") >= as_of - F.expr(f"INTERVAL {rules.FRESHNESS_HOURS} HOURS")))
    return recent.groupBy("source_name").agg(F.count(F.lit(1)).alias("n_recent"))


Q09 = f"""
select event_type as source_name, count(*) as n_recent from events
where event_type <> 'error' and ts >= (select max(ts) from events) - interval {rules.FRESHNESS_HOURS} hour
group by 1
"""

QUERIES = {
    "q01_seed_csv_join": q01_seed_csv_join,
    "q02_disaster_types": q02_disaster_types,
    "q03_date_dimension": q03_date_dimension,
    "q04_stage_air_quality": q04_stage_air_quality,
    "q05_utc_partitions": q05_utc_partitions,
    "q06_surrogate_keys": q06_surrogate_keys,
    "q07_weather_outliers": q07_weather_outliers,
    "q08_range_nulling": q08_range_nulling,
    "q09_recent_window": q09_recent_window,
}
ORACLE = {
    "q01_seed_csv_join": Q01, "q02_disaster_types": Q02, "q03_date_dimension": Q03,
    "q04_stage_air_quality": Q04, "q05_utc_partitions": Q05, "q06_surrogate_keys": Q06,
    "q07_weather_outliers": Q07, "q08_range_nulling": Q08, "q09_recent_window": Q09,
}
