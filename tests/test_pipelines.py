"""Staging, intermediate, mart and gold jobs on hand-made edge rows (FIXTURES F5, F6, F8, F12)."""

from decimal import Decimal

from pyspark.sql import functions as F

from airshed import rules
from airshed.plans import gold, intermediate as I, marts as M, staging as S
from airshed.sources.readers import seed_frame
from conftest import rows

AIR_COLS = ("location_id string, location_name string, city string, latitude string, longitude string, "
            "parameter string, value string, unit string, last_updated string, _source string, "
            "_extracted_at string, _run_mode string")


def air(spark, data):
    return spark.createDataFrame(data, AIR_COLS)


def test_stg_air_quality_edges(spark):
    base = ["1", "St A", "Hanoi", "21.0285", "105.8542", " PM25 ", "45.2", None,
            "2024-04-12T10:00:00+07:00", "openaq", "2024-04-12T03:05:00", "daily"]
    data = [tuple(base),
            tuple(base[:6] + [None] + base[7:]),            # value NULL -> dropped
            tuple(base[:6] + ["-1"] + base[7:]),            # negative -> dropped
            tuple(base[:6] + ["abc"] + base[7:]),           # not a number -> dropped
            tuple(base[:2] + [None] + base[3:]),            # city NULL -> Unknown
            tuple(base[:2] + ["Hue"] + base[3:])]           # unknown spelling passes through
    out = S.stg_air_quality(air(spark, data))
    got = rows(out, "city", "pollutant_code", "measurement_value", "unit", F.col("measured_at_utc").cast("string"))
    assert got[0] == ("Hà Nội", "pm25", Decimal("45.2000"), "µg/m³", "2024-04-12 10:00:00")
    assert [g[0] for g in got] == ["Hà Nội", "Unknown", "Hue"]


def test_stg_weather_bounds_and_defaults(spark):
    cols = ("city string, latitude string, longitude string, time string, temperature_2m string, "
            "relative_humidity_2m string, precipitation string, wind_speed_10m string, wind_direction_10m string, "
            "uv_index string, surface_pressure string, _source string, _extracted_at string, _run_mode string")
    mk = lambda t, time="2024-04-12T10:00": (None, "10.8", "106.6", time, t, "75", None, "12.3", "180",
                                             None, "1010", "om", "2024-04-12T10:05", "daily")
    df = spark.createDataFrame([mk("-10"), mk("50"), mk("50.01"), mk(None), mk("32.5", None), mk("-10.01")], cols)
    out = S.stg_weather(df)
    got = rows(out, "city_name", "temperature_celsius", "precipitation_mm", "uv_index")
    assert got == [("Unknown", Decimal("-10.00"), Decimal("0.00"), Decimal("0.0")),
                   ("Unknown", Decimal("50.00"), Decimal("0.00"), Decimal("0.0"))]


def test_stg_flood_cem_disaster_fire_geo(spark):
    flood = spark.createDataFrame([("Sông Hồng (Hà Nội)", "1", "2", "2024-04-10", d, "x", "2024-04-10", "d")
                                   for d in ["0", "-1", None]],
                                  "river_name string, latitude string, longitude string, time string, "
                                  "river_discharge string, _source string, _extracted_at string, _run_mode string")
    assert rows(S.stg_flood(flood), "discharge_m3s") == [(Decimal("0.00"),)]

    cem = spark.createDataFrame([
        ("Trạm Hà Nội 1", "45.0", "Rất xấu", "Cập nhật 08:30 14/04/2026"),
        ("HCM Q1", "45.5", "XẤU", "08:30 14/04/2026"),
        ("Huế", None, "Tốt", "08:30 14/04/2026"),
        (" Cần Thơ ", "101", None, ""),
    ], "station_name string, aqi_value string, category string, published_time string") \
        .withColumn("_crawled_at", F.lit("2026-04-14 09:00:00"))
    got = rows(S.stg_cem_aqi(cem), "station_name", "city_name", "aqi_value", "aqi_category",
               F.col("measured_at").cast("string"))
    assert got == [("Trạm Hà Nội 1", "Hà Nội", 45, "very_unhealthy", "2026-04-14 08:30:00"),
                   ("HCM Q1", "Hồ Chí Minh", 46, "unhealthy", "2026-04-14 08:30:00"),
                   ("Cần Thơ", "Cần Thơ", 101, "unknown", None)]

    dis = spark.createDataFrame([(None, "x"), ("N/A", "x"), ("Tin lũ khẩn cấp", None), ("Thời tiết", "bão mạnh")],
                                "title string, summary string") \
        .withColumns({"publish_date": F.lit("10:00 01/05/2026"), "detail_url": F.lit(None).cast("string"),
                      "_crawled_at": F.lit("2026-05-01 10:05:00")})
    got = rows(S.stg_nchmf_disaster(dis), "title", "summary", "disaster_type", "severity_level", "detail_url")
    assert got == [("Tin lũ khẩn cấp", "No Summary", "flood", "extreme", "N/A"),
                   ("Thời tiết", "bão mạnh", "storm", "normal", "N/A")]

    fire = spark.createDataFrame([("10.1", "106.1", "45"), ("10.2", None, "12345"), ("10.3", "106.3", "1230")],
                                 "latitude string, longitude string, acq_time string") \
        .withColumns({c: F.lit(None).cast("string") for c in ["bright_ti4", "scan", "track", "frp", "satellite",
                                                              "instrument", "confidence", "daynight"]}) \
        .withColumns({"acq_date": F.lit("2024-04-12"), "_extracted_at": F.lit("2024-04-12 10:00:00")})
    got = rows(S.stg_fire_hotspot(fire), "detection_time_hhmm", "satellite", "daynight")
    assert got == [("0045", "Unknown", "D"), ("1230", "Unknown", "D")]

    geo = spark.createDataFrame([("1", " Bệnh viện ", "Hospital", "21.0"), ("2", "  ", "hospital", "21.0"),
                                 ("3", None, "x", "21.0"), ("4", "Unknown", "fire_station", None)],
                                "node_id string, name string, amenity_type string, latitude string") \
        .withColumns({"longitude": F.lit("105.8"), "_extracted_at": F.lit("2024-04-12 10:00:00")})
    assert rows(S.stg_geo_features(geo), "osm_id", "feature_name", "feature_type") == [(1, "Bệnh viện", "hospital")]


def _stg_air(spark):
    return spark.createDataFrame([
        (1, "A", "Hà Nội", Decimal("21.0"), Decimal("105.8"), "pm25", Decimal("30.0"), "2024-04-12 01:00:00"),
        (2, "B", "Hà Nội", Decimal("21.2"), Decimal("105.6"), "pm25", Decimal("50.0"), "2024-04-12 02:00:00"),
        (3, "C", "Đà Nẵng", Decimal("16.0"), Decimal("108.2"), "pm10", Decimal("80.0"), "2024-04-12 03:00:00"),
    ], "station_id int, station_name string, city string, latitude decimal(10,6), longitude decimal(10,6), "
       "pollutant_code string, measurement_value decimal(12,4), t string") \
        .withColumn("measured_at_utc", F.col("t").cast("timestamp")).drop("t") \
        .withColumns({"unit": F.lit("µg/m³"), "ingested_at": F.col("measured_at_utc")})


def _stg_cem(spark):
    return spark.createDataFrame([
        ("Hà Nội", 120, "unhealthy", "2024-04-12 08:00:00"), ("Hà Nội", 80, "moderate", "2024-04-12 09:00:00"),
        ("Hồ Chí Minh", 60, "moderate", "2024-04-12 08:00:00"), ("Hồ Chí Minh", 60, "good", "2024-04-12 09:00:00"),
        ("Hồ Chí Minh", 70, "x", None)],
        "city_name string, aqi_value int, aqi_category string, t string") \
        .withColumn("measured_at", F.col("t").cast("timestamp")).drop("t")


def test_int_daily_aqi_city_full_join_and_mode(spark):
    out = I.int_daily_aqi_city(_stg_air(spark), _stg_cem(spark))
    got = {(r["city_name"], r["pollutant_code"]): r for r in out.collect()}
    hn = got[("Hà Nội", "pm25")]
    assert hn["openaq_readings"] == 2 and hn["cem_readings"] == 2
    assert hn["cem_dominant_category"] == "moderate"          # tie -> smallest
    assert got[("Hồ Chí Minh", None)]["cem_dominant_category"] == "good"
    assert got[("Đà Nẵng", "pm10")]["cem_readings"] is None   # left-only row kept
    assert len(got) == 3


def test_environmental_risk_long_and_short_river_names(spark):
    daily = I.int_daily_aqi_city(_stg_air(spark), _stg_cem(spark))
    rivers = seed_frame(spark, "vietnam_rivers")
    flood = spark.createDataFrame([("Sông Hồng (Hà Nội)", "2024-04-12 00:00:00", Decimal("2500.00")),
                                   ("Sông Hồng", "2024-04-12 00:00:00", Decimal("9000.00")),
                                   ("Sông Hương (Huế)", "2024-04-13 00:00:00", Decimal("10000.00"))],
                                  "river_name string, t string, discharge_m3s decimal(12,2)") \
        .withColumn("observed_at", F.col("t").cast("timestamp"))
    fire = spark.createDataFrame([("2024-04-12", "high", Decimal("5.0"))] * 4 + [("2024-04-12", "low", Decimal("1"))],
                                 "d string, confidence_level string, fire_radiative_power_mw decimal(10,2)") \
        .withColumn("detection_date", F.col("d").cast("date"))
    out = I.int_environmental_risk(daily, flood, rivers, fire, point_aliases={"Huế": "Thừa Thiên Huế"})
    got = {(str(r["risk_date"]), r["province_name"]): r for r in out.collect()}
    hn = got[("2024-04-12", "Hà Nội")]
    # cem avg 100 -> 8.0; flow 2500 -> 15.0 (short name not joined); 4 fires -> 12
    assert (float(hn["aqi_risk_score"]), float(hn["flood_risk_score"]), hn["fire_risk_score"]) == (8.0, 15.0, 12)
    assert float(hn["composite_risk_score"]) == 35.0 and hn["risk_level"] == "moderate"
    hue = got[("2024-04-13", "Thừa Thiên Huế")]
    assert float(hue["flood_risk_score"]) == 30.0 and hue["fire_risk_score"] == 0


def test_all_feed_river_points_join_the_seed(spark):
    feed_points = ["Sông Hồng (Hà Nội)", "Sông Hồng (Lào Cai)", "Sông Đà (Hòa Bình)", "Sông Mã (Thanh Hóa)",
                   "Sông Cả (Nghệ An)", "Sông Hương (Huế)", "Sông Thu Bồn (Quảng Nam)", "Sông Ba (Phú Yên)",
                   "Sông Đồng Nai (Đồng Nai)", "Sông Tiền (Tiền Giang)", "Sông Hậu (Cần Thơ)", "Sông Sài Gòn (HCM)"]
    flood = spark.createDataFrame([(p, Decimal("100.00")) for p in feed_points], "river_name string, discharge_m3s decimal(12,2)") \
        .withColumn("observed_at", F.lit("2024-04-12 00:00:00").cast("timestamp"))
    out = I.flood_risk(flood, seed_frame(spark, "vietnam_rivers"), rules.RIVER_POINT_CITY_ALIASES,
                       river_aliases=rules.RIVER_NAME_ALIASES)
    cities = {r["city_name"] for r in out.collect()}
    assert len(cities) == 12 and {"Hồ Chí Minh", "Thừa Thiên Huế"} <= cities
    assert I.flood_risk(flood, seed_frame(spark, "vietnam_rivers")).count() == 11   # without the alias


def test_disaster_impact_literal_weights_score_zero(spark):
    df = spark.createDataFrame([("storm", "extreme", "2024-01-01 10:00:00")] * 5,
                               "disaster_type string, severity_level string, t string") \
        .withColumn("published_at", F.col("t").cast("timestamp"))
    lit = I.int_disaster_impact(df).first()
    staged = I.int_disaster_impact(df, rules.SEVERITY_WEIGHTS_STAGED).first()
    assert (lit["total_severity_score"], lit["impact_level"]) == (0, "low")
    assert (staged["total_severity_score"], staged["impact_level"]) == (20, "extreme")


def test_marts(spark):
    assert M.dim_time(spark).count() == 1096
    t = {str(r["date_key"]): r for r in M.dim_time(spark).filter("date_key in ('2024-01-07', '2024-03-01')").collect()}
    assert (t["2024-01-07"]["day_of_week"], t["2024-01-07"]["is_weekend"], t["2024-01-07"]["season_vi"]) == (0, True, "Đông")
    assert (t["2024-03-01"]["month_name_vi"], t["2024-03-01"]["season_vi"]) == ("Tháng 3", "Xuân")
    loc = M.dim_location(seed_frame(spark, "vietnam_cities"), seed_frame(spark, "vietnam_rivers"))
    assert loc.count() == 75 and loc.filter("location_name = 'Sông Hồng (Hà Nội)'").count() == 1
    pol = M.dim_pollutant(seed_frame(spark, "pollutant_standards"))
    assert pol.count() == 6 and pol.filter("pollutant_code = 'o3'").first()["who_guideline_annual"] is None
    assert M.dim_disaster_type(spark).count() == 10
    st = M.dim_station(_stg_air(spark))
    assert st.count() == 3 and st.first()["country_code"] == "VN"
    fact = M.fact_air_measurements(_stg_air(spark))
    cats = {r["station_id"]: r["pm25_aqi_category"] for r in fact.collect()}
    assert cats == {1: "moderate", 2: "unhealthy_sg", 3: None}


def test_fact_natural_disasters_left_join(spark):
    dis = spark.createDataFrame([("t1", "s", "u", "storm", "high", "2024-01-01 10:00:00"),
                                 ("t2", "s", "u", "volcano", "normal", None)],
                                "title string, summary string, detail_url string, disaster_type string, "
                                "severity_level string, p string") \
        .withColumns({"published_at": F.col("p").cast("timestamp"), "ingested_at": F.current_timestamp()})
    out = M.fact_natural_disasters(dis, M.dim_disaster_type(spark))
    got = {r["title"]: r for r in out.collect()}
    assert got["t1"]["disaster_name_en"] == "Tropical Storm/Typhoon" and got["t1"]["hazard_category"] == "meteorological"
    assert got["t2"]["disaster_type_sk"] is None and got["t2"]["date_key"] is None


def test_clean_air_quality_and_gold(spark):
    df = spark.createDataFrame([
        ("S1", "A", " aqi ", "120", "Hà Nội", "x", "2024-04-12 10:00:00"),
        ("S2", "B", "aqi", "501", "Hà Nội", "x", "2024-04-12 11:00:00"),   # above bound -> NULL
        ("S3", "C", "aqi", "NaN", "Hà Nội", "x", "2024-04-12 12:00:00"),   # NaN -> NULL
        ("S1", "A", "aqi", "80", "Hà Nội", "x", "2024-04-13 10:00:00"),
        (None, "D", None, None, "Hà Nội", "x", "2024-04-13 10:00:00"),      # all keys NULL -> dropped
        (None, "E", "pm25", "20", "Hà Nội", "x", "2024-04-13 10:00:00"),    # one key NULL -> kept
    ], "station_code string, station_name string, pollutant string, measurement_value string, city_name string, "
       "source_name string, extracted_at string")
    silver = gold.clean_air_quality(df)
    assert silver.count() == 5
    first = silver.orderBy("extracted_at").first()
    assert first["pollutant"] == "aqi" and str(first["extracted_at"]) == "2024-04-12 03:00:00"
    daily = gold.daily_city_aqi_summary(silver)
    d = {str(r["measurement_date"]): r for r in daily.collect()}
    assert (d["2024-04-12"]["avg_aqi"], d["2024-04-12"]["station_count"], d["2024-04-12"]["risk_label"]) == \
        (120.0, 1, "Sensitive")
    monthly = gold.monthly_risk_index(daily).first()
    assert (monthly["avg_monthly_aqi"], monthly["risk_index_pct"], monthly["risk_tier"]) == (100.0, 50.0, "High")
