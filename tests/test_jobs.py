"""Job runners, the model build, catalog helpers and the keyed sink."""

import os

import pytest
from pyspark.sql import functions as F

from airshed.plans import gold, models
from airshed.sources import readers, sinks
from airshed.streaming import validator as V


def _bronze(spark):
    air = spark.createDataFrame([
        ("1", "St A", "Hanoi", "21.0", "105.8", "pm25", "30", None, "2024-04-12T01:00:00", "2024-04-12T01:05:00"),
        ("2", "St B", "hai phong", "20.8", "106.7", "PM10", "80", None, "2024-04-12T02:00:00", "2024-04-12T02:05:00")],
        "location_id string, location_name string, city string, latitude string, longitude string, "
        "parameter string, value string, unit string, last_updated string, _extracted_at string")
    cem = spark.createDataFrame([("Trạm Hà Nội", "120.0", "Xấu", "08:00 12/04/2024", "2024-04-12 09:00:00")],
                                "station_name string, aqi_value string, category string, published_time string, "
                                "_crawled_at string")
    flood = spark.createDataFrame([("Sông Hồng (Hà Nội)", "1", "2", "2024-04-12", "2500", "2024-04-12")],
                                  "river_name string, latitude string, longitude string, time string, "
                                  "river_discharge string, _extracted_at string")
    fire = spark.createDataFrame([("21.0", "105.8", "h", "2024-04-12", "130", "1.5")],
                                 "latitude string, longitude string, confidence string, acq_date string, "
                                 "acq_time string, frp string") \
        .withColumns({c: F.lit(None).cast("string") for c in ["bright_ti4", "scan", "track", "satellite",
                                                              "instrument", "daynight", "_extracted_at"]})
    dis = spark.createDataFrame([("Tin bão khẩn cấp", "gió mạnh", "10:00 12/04/2024", "/a", "2024-04-12 10:05:00")],
                                "title string, summary string, publish_date string, detail_url string, "
                                "_crawled_at string")
    return {"air_quality": air, "cem_aqi": cem, "flood": flood, "fire_hotspot": fire, "nchmf_disaster": dis}


def test_build_models_and_write_marts(spark, tmp_path):
    m = models.build_models(spark, _bronze(spark))
    risk = {r["province_name"]: r for r in m["int_environmental_risk"].collect()}
    hn = risk["Hà Nội"]
    assert float(hn["aqi_risk_score"]) == 9.6 and float(hn["flood_risk_score"]) == 15.0 and hn["fire_risk_score"] == 3
    assert m["fact_natural_disasters"].first()["disaster_name_en"] == "Tropical Storm/Typhoon"
    assert {r["city"] for r in m["dim_station"].collect()} == {"Hà Nội", "Hải Phòng"}
    written = models.write_marts(m, str(tmp_path / "gold"))
    assert "fact_air_measurements" in written and "fact_weather_observations" not in written
    assert spark.read.parquet(str(tmp_path / "gold" / "dim_time")).count() == 1096


def test_declared_model_tests(spark, tmp_path):
    from airshed import rules

    m = models.build_models(spark, _bronze(spark), settle=models.written_to(str(tmp_path / "models")))
    res = {(r["table_name"], r["rule"], r["column"]): r["failed"] for r in models.test_models(m).collect()}
    present = {(t[0]) for t in rules.MODEL_TESTS if t[0] in m}
    assert {k[0] for k in res} == present
    assert res[("dim_time", "unique", "date_key")] == 0
    assert res[("stg_air_quality", "not_null", "station_id")] == 0
    # The disaster row's published_at parsed, so no NULL date keys
    assert res[("fact_natural_disasters", "not_null", "date_key")] == 0
    assert sum(res.values()) == 0
    models.test_models(m, stop_on_failure=True)


def test_bronze_silver_gold_jobs(spark, tmp_path):
    raw = spark.createDataFrame([
        ("S1", "A", "aqi", "120", "Hà Nội", "x", "2024-04-12 10:00:00"),
        ("S2", "B", "aqi", "80", "Hà Nội", "x", "2024-04-13 10:00:00"),
        (None, None, None, None, "Hà Nội", "x", "2024-04-13 10:00:00")],
        "station_code string, station_name string, pollutant string, measurement_value string, "
        "city_name string, source_name string, extracted_at string")
    silver, goldp = str(tmp_path / "silver"), str(tmp_path / "gold")
    assert gold.run_bronze_to_silver(raw, silver) == {"read": 3, "written": 2}
    assert os.path.isdir(os.path.join(silver, "year=2024", "month=4", "day=12"))
    assert gold.run_silver_to_gold(spark, silver, goldp) == {"daily": 2, "monthly": 1}
    m = spark.read.parquet(f"{goldp}/monthly_risk_index").first()
    assert (m["avg_monthly_aqi"], m["risk_index_pct"], m["total_station_days"], m["risk_tier"]) == \
        (100.0, 50.0, 2, "High")


def test_sized_session(spark):
    from airshed.session import input_bytes, sized_session

    path = "/root/testdata/sf0.01/lineitem.parquet"
    assert input_bytes(spark, path) > 0
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert int(sized_session(spark, path, target_bytes=10_000).conf.get(key)) > 4
    assert int(sized_session(spark, path).conf.get(key)) == spark.sparkContext.defaultParallelism
    assert spark.conf.get(key) == before


def test_feed_csv_catalog_and_sql(spark, tmp_path):
    empty = tmp_path / "fire.csv"
    empty.write_text("latitude,longitude\n")
    with pytest.raises(readers.EmptyFeedError):
        readers.read_feed_csv(spark, str(empty))
    full = tmp_path / "fire2.csv"
    full.write_text("latitude,longitude,bright_ti4,scan,track,acq_date,acq_time,satellite,instrument,"
                    "confidence,version,bright_ti5,frp,daynight\n10.1,106.1,300,0.4,0.4,2024-04-12,45,N,VIIRS,n,2,"
                    "290,1.2,D\n")
    assert readers.read_feed_csv(spark, str(full)).first()["acq_time"] == "45"
    assert "default" in readers.list_schemas(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    out = readers.sql_over(spark, "select l.v, r.id from lake l join wh r on l.id = r.id",
                           {"lake": df, "wh": df.select("id")})
    assert out.count() == 2
    view = sinks.materialize_view(df, "tmp_models_view")
    assert readers.table_exists(spark, "tmp_models_view") and view.count() == 2


def test_publish_keyed_batch(spark, tmp_path):
    df = spark.createDataFrame([(12, "pm25", 4.5)], "location_id bigint, parameter string, value double")
    V.publish(df, fmt="json", path=str(tmp_path / "out"))
    got = spark.read.json(str(tmp_path / "out")).first()
    assert got["key"] == "12_pm25" and '"value":4.5' in got["value"]
