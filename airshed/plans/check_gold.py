"""Check queries Q18 and Q19: raw readings -> silver -> daily summary -> monthly index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed import rules
from airshed.plans.check_staging import ladder_sql, sround, table
from airshed.plans.gold import clean_air_quality, daily_city_aqi_summary, monthly_risk_index


# ---------------------------------------------------------------------------
# Q18 / Q19: raw -> silver -> daily summary -> monthly index (flagship)
# ---------------------------------------------------------------------------

def events_as_raw_aqi(events: DataFrame) -> DataFrame:
    """Events as raw readings of seven places (by user): padded texts, the
    'aqi' series and another one ('error' events), values that rise over
    ten days (one place far above the others, two below: months of every
    tier) and leave the physical range, some keys missing."""
    key = F.when(F.col("event_id") % 31 != 0, F.col("user_id").cast("string"))
    place = F.col("user_id") % 7
    below = F.when(place == 0, 6).when(place == 1, 3).otherwise(1)
    rising = F.col("value") * (1 + F.dayofyear("ts") % 10) / below + F.when(F.col("user_id") % 7 == 6, 300).otherwise(0)
    return events.select(
        F.concat(F.lit("  "), key, F.lit(" ")).alias("station_code"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("station_name"),
        F.when(F.col("event_id") % 31 != 0, F.when(F.col("event_type") == "error", " pm10 ").otherwise(" aqi ")).alias("pollutant"),
        F.when(F.col("event_id") % 31 != 0, rising).alias("measurement_value"),
        F.concat(F.lit(" Place "), (F.col("user_id") % 7).cast("string")).alias("city_name"),
        F.lit("events").alias("source_name"),
        F.col("ts").alias("extracted_at"),
    )


def q18_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events_as_raw_aqi(table(spark, sf_dir, "events"))
    silver = clean_air_quality(raw, source_tz=None, value_type="decimal(12,4)")
    return daily_city_aqi_summary(silver).select(
        "city_name", "measurement_date", F.col("avg_aqi").cast("double").alias("avg_aqi"),
        F.col("max_aqi").cast("double").alias("max_aqi"), "station_count",
        "risk_label", "year", "month")


def q19_monthly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_risk_index(q18_daily_summary(spark, sf_dir))


_Q18_SQL = f"""
with r as (
  select 'Place ' || cast(user_id % 7 as varchar) as city_name, ts, user_id,
         cast(raw as decimal(12, 4)) as v
  from (select *, value * (1 + dayofyear(ts) % 10) / case user_id % 7 when 0 then 6 when 1 then 3 else 1 end
                       + case when user_id % 7 = 6 then 300 else 0 end as raw from events)
  where event_type <> 'error' and event_id % 31 <> 0 and raw between 0 and 500
), d as (
  select city_name, cast(ts as date) as measurement_date,
         {sround("avg(v)", 2)} as avg_aqi, {sround("max(v)", 2)} as max_aqi,
         count(distinct user_id) as station_count
  from r where v is not null group by 1, 2
)
select city_name, measurement_date, avg_aqi, max_aqi, station_count,
       {ladder_sql('avg_aqi', rules.DAY_LABEL_CUTS, rules.DAY_LABEL_DEFAULT)} as risk_label,
       cast(year(measurement_date) as integer) as year,
       cast(month(measurement_date) as integer) as month
from d
"""

ORACLE: dict[str, str] = {
    "q18_daily_summary": _Q18_SQL,
    "q19_monthly_index": f"""
with d as ({_Q18_SQL})
select city_name, year, month,
       {sround("avg(avg_aqi)", 2)} as avg_monthly_aqi,
       {sround("100.0 * count(*) filter (where avg_aqi > 100) / count(*)", 1)} as risk_index_pct,
       sum(station_count) as total_station_days,
       {ladder_sql(sround("100.0 * count(*) filter (where avg_aqi > 100) / count(*)", 1), rules.MONTH_TIER_CUTS,
                   rules.MONTH_TIER_DEFAULT)} as risk_tier
from d group by 1, 2, 3
""",
}

QUERIES = {"q18_daily_summary": q18_daily_summary, "q19_monthly_index": q19_monthly_index}
