"""Golden boundary values for the column rules (FIXTURES F12)."""

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions import exprs as X
from conftest import rows


def one(spark, expr, value, ddl="x double"):
    if ddl == "x double" and isinstance(value, int):
        value = float(value)
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("v,label", [
    (None, "Hazardous"), (0, "Good"), (50, "Good"), (50.01, "Moderate"), (100, "Moderate"),
    (150, "Sensitive"), (200, "Unhealthy"), (300, "Very Unhealthy"), (300.01, "Hazardous")])
def test_day_label(spark, v, label):
    assert one(spark, X.bucketize("x", rules.DAY_LABEL_CUTS, rules.DAY_LABEL_DEFAULT), v) == label


@pytest.mark.parametrize("v,label", [(19.9, "Low"), (20, "Medium"), (49.9, "Medium"), (50, "High")])
def test_month_tier(spark, v, label):
    assert one(spark, X.bucketize("x", rules.MONTH_TIER_CUTS, rules.MONTH_TIER_DEFAULT), v) == label


@pytest.mark.parametrize("v,label", [(3, "low"), (4, "moderate"), (8, "high"), (12, "extreme")])
def test_impact(spark, v, label):
    assert one(spark, X.bucketize("x", rules.IMPACT_CUTS, rules.IMPACT_DEFAULT), v) == label


@pytest.mark.parametrize("v,label", [(24.9, "low"), (25, "moderate"), (50, "high"), (70, "critical")])
def test_risk_level(spark, v, label):
    assert one(spark, X.bucketize("x", rules.RISK_LEVEL_CUTS, rules.RISK_LEVEL_DEFAULT), v) == label


@pytest.mark.parametrize("v,c,r", [
    (14.99, "cold", "heavy"), (15, "comfortable", "heavy"), (25, "warm", "heavy"), (33, "hot", "heavy"),
    (40, "extreme_heat", "heavy")])
def test_comfort(spark, v, c, r):
    assert one(spark, X.bucketize("x", rules.COMFORT_CUTS, rules.COMFORT_DEFAULT), v) == c
    assert one(spark, X.bucketize("x", rules.RAIN_CUTS, rules.RAIN_DEFAULT), v) == r


@pytest.mark.parametrize("v,label", [(0, "none"), (2.49, "light"), (2.5, "moderate"), (7.6, "heavy"),
                                     (50, "extreme")])
def test_rain(spark, v, label):
    assert one(spark, X.bucketize("x", rules.RAIN_CUTS, rules.RAIN_DEFAULT), v) == label


@pytest.mark.parametrize("v,label", [(12, "good"), (12.01, "moderate"), (35.4, "moderate"),
                                     (55.4, "unhealthy_sg"), (150.4, "unhealthy"), (250.4, "very_unhealthy"),
                                     (250.5, "hazardous")])
def test_pm25_category(spark, v, label):
    assert one(spark, X.bucketize("x", rules.PM25_CATEGORY_CUTS, rules.PM25_CATEGORY_DEFAULT), v) == label


@pytest.mark.parametrize("code,v,aqi", [
    ("pm25", 0, 0), ("pm25", 12.0, 50), ("pm25", 12.1, 50), ("pm25", 35.4, 100), ("pm25", 35.5, 100),
    ("pm25", 55.4, 150), ("pm25", 150.4, 200), ("pm25", 250.4, 300), ("pm25", 500.4, 500), ("pm25", 600, 500),
    ("pm10", 54, 50), ("pm10", 55, 50), ("pm10", 154, 100), ("pm10", 604, 500), ("pm10", 605, 500),
    ("o3", 54, 50), ("o3", 70, 100), ("o3", 200, 300), ("o3", 201, 500),
    ("no2", 45.5, 46), ("co", 700, 500), ("pm25", None, None)])
def test_aqi_subindex(spark, code, v, aqi):
    ddl = "x decimal(12,4)"
    val = None if v is None else Decimal(str(v))
    assert one(spark, X.aqi_subindex(code, F.col("x")), val, ddl) == aqi


def test_aqi_null_as_500_and_column_code(spark):
    assert one(spark, X.aqi_subindex("pm25", F.col("x"), null_as=500), None) == 500
    df = spark.createDataFrame([("pm25", 35.4), ("pm10", 154.0), ("so2", 20.4), ("o3", None)], "c string, x double")
    got = rows(df.select(X.aqi_subindex(F.col("c"), F.col("x"))))
    assert got == [(100,), (100,), (20,), (None,)]


@pytest.mark.parametrize("aqi,flow,fires,score", [
    (None, None, None, 0.0), (500, 5000, 10, 100.0), (1000, 10000, 20, 100.0), (250, 2500, 2, 41.0),
    (100, None, 1, 11.0), (37, 123.45, 0, 3.7)])
def test_risk_score(spark, aqi, flow, fires, score):
    df = spark.createDataFrame([(aqi, None if flow is None else Decimal(str(flow)), fires)],
                               "a int, f decimal(12,2), h int")
    assert float(df.select(X.risk_score("a", "f", "h")).first()[0]) == score


def test_heat_index(spark):
    df = spark.createDataFrame([(Decimal("27.00"), Decimal("80.00")), (Decimal("30.00"), Decimal("70.00")),
                                (None, Decimal("10.00"))], "t decimal(6,2), h decimal(5,2)")
    got = [r[0] for r in df.select(X.heat_index("t", "h")).collect()]
    # -8.785 + 48.33 + 163.73 - 306.81 = -103.535 -> -103.5 (large negatives, as in the reference)
    assert got == [Decimal("27.00"), Decimal("-103.50"), None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    got = rows(df.select(X.surrogate_key("s"), X.surrogate_key("s", "n")))
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert got[0] == (md5("a"), md5("a-1"))
    assert got[1] == (md5(rules.SURROGATE_NULL), md5(rules.SURROGATE_NULL + "-2"))


def test_city_alias(spark):
    df = spark.createDataFrame([(c,) for c in ["Hanoi", "HO CHI MINH CITY", "ho chi minh", "Da Nang",
                                               "Haiphong", "hai phong", "Can Tho", "Hue", None]], "c string")
    got = [r[0] for r in df.select(X.alias_value("c")).collect()]
    assert got == ["Hà Nội", "Hồ Chí Minh", "Hồ Chí Minh", "Đà Nẵng", "Hải Phòng", "Hải Phòng", "Cần Thơ",
                   "Hue", "Unknown"]


def test_station_city_case_sensitive_first_wins(spark):
    df = spark.createDataFrame([(s,) for s in ["Trạm Hà Nội HCM", "hanoi", "Đà Nẵng 1", "X", None]], "s string")
    got = [r[0] for r in df.select(X.station_city("s")).collect()]
    assert got == ["Hà Nội", "hanoi", "Đà Nẵng", "X", None]


def test_aqi_category_orders(spark):
    df = spark.createDataFrame([(c,) for c in ["Rất xấu", " XẤU ", "Tốt", "Kém", "Nguy hại", None]], "c string")
    default = [r[0] for r in df.select(X.aqi_category("c")).collect()]
    literal = [r[0] for r in df.select(X.aqi_category("c", rules.AQI_CATEGORY_RULES_LITERAL)).collect()]
    assert default == ["very_unhealthy", "unhealthy", "good", "unhealthy_sg", "hazardous", "unknown"]
    assert literal[0] == "unhealthy"  # reference order: 'very_unhealthy' unreachable


def test_disaster_rules_three_valued(spark):
    df = spark.createDataFrame([
        ("Tin bão số 3", None), (None, "mưa lũ lớn"), ("Cảnh báo rét đậm", "trời lạnh"),
        ("Tin thời tiết", "có giông lốc"), ("Giông LỐC mạnh", None), ("KHẨN CẤP sạt lở", None)],
        "title string, summary string")
    got = rows(df.select(X.disaster_type("title", "summary"), X.severity_level("title")))
    assert got == [("storm", "normal"), ("flood", "normal"), ("cold_wave", "high"), ("other", "normal"),
                   ("thunderstorm", "high"), ("landslide", "extreme")]


def test_parse_local_time(spark):
    df = spark.createDataFrame([("08:30 14/04/2026",), ("Cập nhật 08:30 14/04/2026",), ("",), (None,),
                                ("25:61 99/99/2026",), ("14/04/2026",)], "s string")
    got = [r[0] for r in df.select(X.parse_local_time("s").cast("string")).collect()]
    assert got == ["2026-04-14 08:30:00", "2026-04-14 08:30:00", None, None, None, None]


def test_to_utc_shift(spark):
    df = spark.createDataFrame([("2024-04-12 10:00:00",)], "s string")
    assert df.select(X.to_utc(F.col("s")).cast("string")).first()[0] == "2024-04-12 03:00:00"
    assert df.select(X.to_utc(F.col("s"), None).cast("string")).first()[0] == "2024-04-12 10:00:00"


def test_numeric_text_and_links(spark):
    df = spark.createDataFrame([(v,) for v in ["45", "45.5", "4.5.5", "", "abc", ".", None]], "s string")
    assert [r[0] for r in df.select(X.numeric_text("s")).collect()] == [45.0, 45.5, None, None, None, None, None]
    links = spark.createDataFrame([("/a",), ("http://x/b",), ("",)], "l string")
    got = [r[0] for r in links.select(X.absolute_url("l", "https://nchmf.gov.vn")).collect()]
    assert got == ["https://nchmf.gov.vn/a", "http://x/b", ""]


def test_predicates(spark):
    df = spark.createDataFrame([(8.0, 102.0), (24.0, 110.0), (7.99, 105.0), (10.0, 110.01)], "lat double, lon double")
    assert [r[0] for r in df.select(X.in_box("lat", "lon")).collect()] == [True, True, False, False]
