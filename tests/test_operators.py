"""Nested documents, HTML pages, change fold, fallback, quality rules, sinks."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from airshed.operators import changes, fallback, html, nested, quality
from airshed.sources import readers, sinks
from conftest import rows


def test_flatten_latest_sensor_lookup_and_datetime_shapes(spark):
    doc = {"location": {"id": 7, "name": "St", "city": "Hanoi",
                        "coordinates": {"latitude": 21.0, "longitude": 105.8},
                        "sensors": [{"id": 1, "parameter": {"name": "PM25", "units": "µg/m³"}},
                                    {"id": 2, "parameter": {"name": "rh", "units": "%"}}]},
           "latest": {"results": [{"sensorsId": 1, "value": 12.5, "datetime": "2024-04-12T03:00:00Z"},
                                  {"sensorsId": 1, "value": 13.5, "datetime": {"utc": "2024-04-12T04:00:00Z"}},
                                  {"sensorsId": 2, "value": 80.0, "datetime": "x"},
                                  {"sensorsId": 9, "value": 1.0, "datetime": "x"}]}}
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    got = rows(nested.flatten_latest(df), "location_id", "city", "parameter", "value", "unit", "last_updated")
    assert got == [(7, "Hanoi", "pm25", 12.5, "µg/m³", "2024-04-12T03:00:00Z"),
                   (7, "Hanoi", "pm25", 13.5, "µg/m³", "2024-04-12T04:00:00Z")]
    doc["location"]["locality"] = None        # present but null: stays null, no fallback to city
    doc["location"].pop("name")
    df2 = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    assert rows(nested.flatten_latest(df2), "location_name", "city")[0] == ("Unknown", None)


def test_flatten_parameters_defaults_only_for_missing_keys(spark):
    doc = {"id": 3, "name": None, "coordinates": {"latitude": 16.0},
           "parameters": [{"parameter": "pm10", "lastValue": 40.0, "unit": "ppm", "lastUpdated": "t1"},
                          {"lastValue": None}]}
    df = spark.createDataFrame([(json.dumps(doc),), ('{"id": 4, "parameters": []}',), ('{"id": 5}',)], "doc string")
    got = rows(nested.flatten_parameters(df, produced_at=F.lit("now")),
               "location_id", "location_name", "city", "latitude", "longitude", "parameter", "value", "unit",
               "date_utc", "date_local", "country", "source")
    # JSON null name stays NULL; missing city/longitude/parameter/unit/time take the defaults
    assert got == [(3, None, "Unknown", 16.0, 0.0, "pm10", 40.0, "ppm", "t1", "t1", "VN", "openaq"),
                   (3, None, "Unknown", 16.0, 0.0, "unknown", None, "µg/m³", "now", "now", "VN", "openaq")]


def test_flatten_arrays_short_array_and_list_shape(spark):
    one = {"hourly": {"time": ["t0", "t1", "t2"], "temperature_2m": [30.0, 31.0], "rh": [70, 71, 72, 73]}}
    two = {"hourly": {"time": ["u0", None], "temperature_2m": [1.0, 2.0], "rh": []}}
    df = spark.createDataFrame([("HN", json.dumps(one)), ("DN", json.dumps(two))], "city string, doc string") \
        .withColumn("h", F.from_json("doc", "struct<hourly: struct<time: array<string>, "
                                            "temperature_2m: array<double>, rh: array<int>>>")["hourly"])
    got = rows(nested.flatten_arrays(df, "h", "time", ["temperature_2m", "rh"], keep=["city"]))
    assert got == [("HN", "t0", 30.0, 70), ("HN", "t1", 31.0, 71), ("HN", "t2", None, 72),
                   ("DN", "u0", 1.0, None), ("DN", None, 2.0, None)]
    shapes = spark.createDataFrame([('{"a": 1}',), (' [{"a": 1}, {"a": 2}]',)], "doc string")
    lists = shapes.select(F.from_json(nested.as_list(F.col("doc")), "array<struct<a: int>>").alias("l"))
    assert [[x["a"] for x in r["l"]] for r in lists.collect()] == [[1], [1, 2]]


def test_flatten_elements_nodes_only(spark):
    doc = {"elements": [{"type": "node", "id": 1, "lat": 21.0, "lon": 105.8, "tags": {"amenity": "hospital"}},
                        {"type": "way", "id": 2, "lat": 21.1, "lon": 105.9, "tags": {"name": "W"}},
                        {"type": "node", "id": 3, "lat": 21.2, "lon": 105.7},
                        {"type": "node", "id": 4, "lat": 21.3, "lon": 105.6, "tags": {"name": None}}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "doc string")
    got = rows(nested.flatten_elements(df))
    assert got == [(1, 21.0, 105.8, "hospital", "Unknown"), (3, 21.2, 105.7, None, "Unknown"),
                   (4, 21.3, 105.6, None, None)]


def test_zip_by_position_stops_at_shorter(spark):
    left = spark.createDataFrame([(1, ["a", "b", "c"])], "k int, xs array<string>")
    right = spark.createDataFrame([(1, [10, 20])], "k int, ys array<int>")
    got = sorted(rows(nested.zip_by_position(left, "xs", right, "ys", "k")))
    assert got == [(1, 0, "a", 10), (1, 1, "b", 20)]


TABLE_PAGE = """<html><body><table class="table table-striped"><thead><tr><th>Trạm</th><th>AQI</th>
<th>Mức</th><th>Giờ</th></tr></thead><tbody>
<tr><td>Hà Nội - Hoàn Kiếm</td><td>152</td><td>Xấu</td><td>08:00 14/04/2026</td></tr>
<tr><td>Đà Nẵng</td><td>45.5</td><td>Tốt</td></tr>
<tr><td>HCM Q1</td><td>N/A</td><td>Trung &amp; bình</td><td>08:00 14/04/2026</td></tr>
</tbody></table></body></html>"""

PLAIN_TABLE_PAGE = "<table><tr><td>Cần Thơ</td><td>88</td><td>Trung bình</td><td>09:00 14/04/2026</td></tr></table>"

LIST_PAGE = """<div class="news-list">
<div class="item"><h3><a href="/canh-bao/1">Tin bão số 3</a></h3><div class="summary">Bão mạnh</div>
<span class="date">10:00 01/05/2026</span></div>
<div class="item"><h3><a href="https://other.vn/x">Lũ quét</a></h3><div class="summary"></div></div>
<div class="item"><div class="summary">Chỉ có tóm tắt</div></div>
<div class="item"><p>trống</p></div>
</div>"""


def test_html_tables_tbody_rows_of_all_striped_tables(spark):
    two = ('<table class="table-striped"><thead><tr><td>Head</td><td>1</td><td>x</td><td>y</td></tr></thead>'
           '<tbody><tr><td>A</td><td>1</td><td>c</td><td>t</td></tr></tbody></table>'
           '<table class="x table-striped"><tbody><tr><td>B</td><td>2</td><td>c</td><td>t</td></tr></tbody></table>'
           '<table class="not-table-striped-x"><tbody><tr><td>C</td><td>3</td><td>c</td><td>t</td></tr></tbody></table>')
    pages = spark.createDataFrame([(1, "u", two)], "page_id long, url string, html string")
    assert [r[0] for r in html.html_tables(pages).select("station_name").collect()] == ["A", "B"]


def test_html_tables_selector_header_short_and_numeric(spark):
    pages = spark.createDataFrame([(1, "https://cem.gov.vn/", TABLE_PAGE), (2, "https://cem.gov.vn/b", PLAIN_TABLE_PAGE)],
                                  "page_id long, url string, html string")
    got = rows(html.html_tables(pages), "page_id", "station_name", "aqi_value", "category", "published_time")
    assert got == [(1, "Hà Nội - Hoàn Kiếm", 152.0, "Xấu", "08:00 14/04/2026"),
                   (1, "HCM Q1", None, "Trung & bình", "08:00 14/04/2026"),
                   (2, "Cần Thơ", 88.0, "Trung bình", "09:00 14/04/2026")]


def test_html_items_list_layout_and_fallback(spark):
    fallback_page = '<div class="latest-news"><a href="/b">Tin B</a><div class="summary">S</div></div><p>x</p>'
    pages = spark.createDataFrame([(1, "https://nchmf.gov.vn/tin", LIST_PAGE), (3, "https://nchmf.gov.vn/", fallback_page),
                                   (2, "http://x.org/p?q=1", '<ul><li><a href="/a">A</a></li><li>no link</li></ul>')],
                                  "page_id long, url string, html string")
    got = rows(html.html_items(pages), "page_id", "title", "summary", "publish_date", "detail_url")
    assert got == [(1, "Tin bão số 3", "Bão mạnh", "10:00 01/05/2026", "https://nchmf.gov.vn/canh-bao/1"),
                   (1, "Lũ quét", "", "", "https://other.vn/x"),
                   (1, "N/A", "Chỉ có tóm tắt", "", ""),
                   (3, "Tin B", "S", "", "https://nchmf.gov.vn/b")]        # class-regex fallback; page 2: none
    lis = rows(html.html_items(pages.filter("page_id = 2"), item_tag="li", fallback=""), "title", "detail_url")
    assert lis == [("A", "http://x.org/a")]
    fixed = rows(html.html_items(pages.filter("page_id = 1"), base_url="https://nchmf.gov.vn"), "detail_url")
    assert fixed[0] == ("https://nchmf.gov.vn/canh-bao/1",)


def test_apply_changes_latest_state(spark):
    df = spark.createDataFrame([(1, "c", 1, "a"), (1, "u", 2, "b"), (2, "c", 1, "x"), (2, "d", 2, "x"),
                                (3, "d", 1, "y"), (3, "c", 2, "z")], "id int, op string, seq int, v string")
    got = sorted(rows(changes.apply_changes(df, ["id"], ["seq"], op_col="op")))
    assert got == [(1, 2, "b"), (3, 2, "z")]


def test_with_fallback_ttl(spark):
    hist = spark.createDataFrame([
        ("air", "2024-01-01 10:00:00", 1), ("air", "2024-01-01 12:00:00", 2),
        ("fire", "2024-01-01 09:00:00", 3), ("fire", "2024-01-01 11:00:00", 4),
        ("flood", "2024-01-01 01:00:00", 5)], "src string, b string, id int") \
        .withColumn("batch", F.col("b").cast("timestamp")).drop("b")
    out = fallback.with_fallback(hist, "src", "batch", "2024-01-01 12:00:00", ttl="6 HOURS")
    got = sorted(rows(out, "src", "id", "is_fallback"))
    assert got == [("air", 2, False), ("fire", 4, True)]          # flood too old
    out2 = fallback.with_fallback(hist, "src", "batch", "2024-01-01 12:00:00")
    assert sorted(rows(out2, "src", "id"))[-1] == ("flood", 5)    # no TTL: unlimited


def test_quality_rules_and_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 10.0), (2, None, 600.0), (2, "x", -1.0), (None, "a", None)],
                               "id int, code string, aqi double")
    rules_ = [quality.Rule("not_null", "id"), quality.Rule("not_null", "code"), quality.Rule("unique", "id"),
              quality.Rule("accepted_values", "code", values=("a", "b")), quality.aqi_range_rule("aqi"),
              quality.Rule("accepted_range", "aqi", min_value=0)]
    got = {(r["rule"], r["column"]): r["failed"] for r in quality.run_rules(df, rules_).collect()}
    assert got == {("not_null", "id"): 1, ("not_null", "code"): 1, ("unique", "id"): 2,
                   ("accepted_values", "code"): 1, ("accepted_range", "aqi"): 1}
    assert quality.failing_rows(df, quality.aqi_range_rule("aqi")).count() == 2
    assert quality.failing_rows(df, quality.Rule("unique", "id")).count() == 2


def test_seeds_and_csv_round_trip(spark, tmp_path):
    cities = readers.seed_frame(spark, "vietnam_cities")
    assert cities.count() == 63
    path = readers.write_seed_csv(spark, "vietnam_rivers", str(tmp_path / "rivers"))
    back = readers.read_csv_table(spark, path, readers.SEED_SCHEMAS["vietnam_rivers"])
    assert back.count() == 12 and back.filter("monitoring_point = 'Huế'").count() == 1
    assert readers.date_spine(spark, "2024-01-01", "2027-01-01").count() == 1096


def test_land_run_log_and_freshness(spark, tmp_path):
    run = datetime(2024, 4, 5, 6, 7, 8)
    lake, log, text = str(tmp_path / "lake"), str(tmp_path / "log"), str(tmp_path / "text")
    df = spark.createDataFrame([(1, "a", float("nan")), (2, "b", 1.5)], "id int, val string, x double")
    entry = sinks.land(df, "air_quality", run, "daily", lake, log, text).first()
    assert (entry["row_count"], entry["status"]) == (2, "SUCCESS")
    assert entry["object_path"].endswith("air_quality/year=2024/month=04/day=05/run=20240405060708")
    # a retried run replaces its own files; another run of the day is added
    sinks.land(df, "air_quality", run, "daily", lake, log)
    assert spark.read.parquet(f"{lake}/air_quality").count() == 2
    sinks.land(df, "air_quality", datetime(2024, 4, 5, 9, 0, 0), "daily", lake, log)
    assert spark.read.parquet(f"{lake}/air_quality").count() == 4
    landed = spark.read.parquet(f"{lake}/air_quality")
    assert landed.count() == 4 and "_run_mode" in landed.columns
    assert dict(spark.read.parquet(f"{text}/air_quality").dtypes)["x"] == "string"
    assert spark.read.parquet(f"{text}/air_quality").filter("id = '1'").first()["x"] is None   # NaN -> NULL
    empty = sinks.land(df.limit(0), "fire", run, "daily", lake, log).first()
    assert (empty["row_count"], empty["status"]) == (0, "EMPTY")
    logs = spark.read.parquet(log)
    assert logs.count() == 3      # the retry replaced its row
    assert sinks.assert_fresh(logs, "2024-04-06 06:00:00") == 2
    try:
        sinks.assert_fresh(logs, "2024-04-07 12:00:00")
        raise AssertionError("expected stale")
    except RuntimeError:
        pass


def test_replace_table_partitions_in_one_call(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1, 1, "a"), (2024, 2, 3, "b")], "year int, month int, day int, v string")
    path = str(tmp_path / "gold")
    sinks.replace_table(df, path, ["year", "month", "day"])
    sinks.replace_table(df.filter("v = 'a'"), path, ["year", "month", "day"])
    back = spark.read.parquet(path)
    assert back.count() == 1 and set(back.columns) == {"v", "year", "month", "day"}
    assert (tmp_path / "gold" / "year=2024" / "month=1" / "day=1").exists()


def test_strip_tags_joins_stripped_text_nodes(spark):
    df = spark.createDataFrame([("<td>Hà <b>Nội</b></td>",), ("<p>  a  b </p>",), ("x &amp; <i> y </i>",)], "h string")
    assert [r[0] for r in df.select(html.strip_tags(F.col("h"))).collect()] == ["HàNội", "a  b", "x &y"]
