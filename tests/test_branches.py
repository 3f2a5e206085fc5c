"""The check queries' inputs reach every branch of the rules they check.

Evaluated on the oracle SQL, which ``test_entry`` shows to give the same
rows as the Spark queries."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES

SF = "/root/testdata/sf0.01"
HAZARDS = {"storm", "flood", "landslide", "earthquake", "drought", "high_tide", "cold_wave", "heatwave", "thunderstorm", "other"}


@pytest.fixture(scope="module")
def values():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sql = E.oracle_sql()

    def distinct(query, column, where="true"):
        return {r[0] for r in con.sql(f'select distinct "{column}" from ({sql[query]}) where {where}').fetchall()}

    return distinct


def test_air_quality_cities_and_filters(values):
    cities = values("q04_stage_air_quality", "city")
    assert {"Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Hải Phòng", "Cần Thơ", "Unknown"} <= cities
    assert None in values("q04_stage_air_quality", "station_id")
    assert None not in values("q20_station_dim", "station_id")


def test_null_and_out_of_range_values(values):
    assert None in values("q08_range_nulling", "value_clean", "event_type is not null")
    assert None in values("q08_range_nulling", "event_type")
    missing = duckdb.sql(f"select count(*) from read_parquet('{SF}/events.parquet')").fetchall()[0][0]
    assert len(values("q08_range_nulling", "event_id")) < missing       # rows without any key are gone


def test_official_categories(values):
    found = values("q10_daily_aqi_city", "cem_dominant_category")
    assert {"good", "moderate", "unhealthy_sg", "unhealthy", "very_unhealthy", "hazardous", "unknown"} <= found


def test_risk_components(values):
    assert values("q11_environmental_risk", "risk_level") >= {"low", "moderate", "high"}
    assert "Regional" in values("q11_environmental_risk", "province_name")
    assert len(values("q12_flood_risk", "flood_risk_score")) > 50
    assert len(values("q17_fire_risk", "fire_risk_score")) > 2


def test_daily_and_monthly_labels(values):
    assert len(values("q18_daily_summary", "risk_label")) == 6
    assert len(values("q19_monthly_index", "risk_index_pct")) > 1
    assert values("q19_monthly_index", "risk_tier") == {"Low", "Medium", "High"}


def test_hazards_and_severities(values):
    for query, column in (("q02_disaster_types", "disaster_code"), ("q22_keyword_rules", "disaster_type"),
                          ("q35_fact_disasters", "disaster_type"), ("q39_disaster_impact_bulletins", "disaster_type")):
        where = "n_documents > 0" if query.startswith("q02") else "true"
        assert values(query, column, where) == HAZARDS, query
    assert values("q22_keyword_rules", "severity_level") == {"extreme", "high", "normal"}
    assert values("q35_fact_disasters", "severity_level") == {"extreme", "high", "normal"}


def test_weather_classes(values):
    assert values("q34_fact_weather", "rain_intensity") >= {"light", "moderate", "heavy", "extreme"}
    assert values("q24_weather_classes", "comfort_level") == {"cold", "comfortable", "warm", "hot", "extreme_heat"}


def test_fallback_rows(values):
    assert values("q29_snapshot_fallback", "is_fallback") == {True, False}
    assert values("q29_snapshot_fallback", "event_type", "is_fallback") == {"error"}
    assert "signup" not in values("q29_snapshot_fallback", "event_type")     # older than may be served


def test_items_without_title_summary_or_link(values):
    assert "N/A" in values("q44_list_pages", "title") and "" in values("q44_list_pages", "summary")
    assert {None, ""} <= values("q44_list_pages", "detail_url")
    assert None in values("q45_table_pages", "aqi_value")


def test_rules_that_fail(values):
    assert 0 not in values("q32_quality_rules", "failed", "rule = 'accepted_range'")
    assert {"text", "lake", "log"} == values("q40_land_batch", "copy")
    assert values("q54_landing_log", "status") >= {"SUCCESS", "EMPTY", "FAILED"}
    assert values("q50_failing_rows", "rule") == {"range", "null", "values", "expression", "unique"}
