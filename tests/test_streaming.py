"""Message validation (batch and stream), dual-sink routing, stream change fold (FIXTURES F7, F11)."""

import json
import os

from pyspark.sql import functions as F

from airshed.operators.aggregates import status_counts
from airshed.streaming import changes as stream_changes
from airshed.streaming import validator as V

GOOD = {"location_id": 12, "location_name": "St", "city": "Hà Nội", "latitude": 21.0, "longitude": 105.8,
        "parameter": "pm25", "value": 45.2, "date_utc": "2024-04-12T03:00:00Z"}


def msg(**kw):
    m = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            m.pop(k)
        else:
            m[k] = v
    return json.dumps(m, ensure_ascii=False)


CASES = [
    (msg(), None),
    (msg(location_id=...), "missing:location_id"),
    (msg(location_id=None), "type:location_id"),
    (msg(location_id="12"), "type:location_id"),
    ('{"location_id": 1.0, "location_name": "a"}', "type:location_id"),
    (msg(location_id=True), "type:location_id"),
    (msg(city=...), "missing:city"),
    (msg(latitude="21"), "type:latitude"),
    (msg(longitude=True), "type:longitude"),
    (msg(value=...), "missing:value"),
    (msg(date_utc=5), "type:date_utc"),
    (msg(parameter="nox"), "enum:parameter"),
    (msg(value=-0.1), "range:value"),
    (msg(value=0), None),
    (msg(latitude=8, longitude=102), None),
    (msg(latitude=24.0, longitude=110.0), None),
    (msg(latitude=7.99), "box"),
    (msg(longitude=110.01), "box"),
    ("not json", "malformed"),
    ("[1, 2]", "missing:location_id"),
    ('"text"', "malformed"),
    (None, "malformed"),
    # as in a dictionary: the last value of a repeated key, NaN is a number, integers of any size
    ('{"value": "x", ' + msg()[1:], None),
    (msg()[:-1] + ', "value": -1}', "range:value"),
    (msg(value=float("nan")), None),
    (msg(latitude=float("nan")), "box"),
    (msg(location_id=10**24), None),
    (msg(location_id=1.0), "type:location_id"),
]


def test_validate_reasons(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(CASES)], "i int, value string")
    got = {r["i"]: r["reason"] for r in V.validate(df).collect()}
    assert [got[i] for i in range(len(CASES))] == [r for _, r in CASES]


def _write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_route_dual_sink_and_resume(spark, tmp_path):
    src, valid, dlq, ckpt = (str(tmp_path / n) for n in ("in", "valid", "dlq", "ckpt"))
    _write_lines(src, "a.json", [m for m, _ in CASES[:10]])
    stream = V.read_stream(spark, "text", src)
    seen = []
    q = V.route(stream, valid, dlq, ckpt, on_batch=lambda b, s: seen.append((b, s["valid_count"], s["invalid_count"])))
    q.awaitTermination()
    assert seen == [(0, 1, 9)]    # first file: CASES[:10]
    assert q.lastProgress["observedMetrics"]["route_input"]["rows"] == 10
    assert spark.read.json(valid).count() == 1
    dead = spark.read.json(dlq)
    assert dead.count() == 9
    row = dead.filter("error_reason = 'missing:location_id'").first()
    assert row["source_topic"] == "raw-air-quality" and row["source_partition"].endswith("a.json")
    assert json.loads(row["original_message"])["city"] == "Hà Nội"
    # resume: only the new file is processed
    _write_lines(src, "b.json", [m for m, _ in CASES[10:] if m is not None])
    V.route(V.read_stream(spark, "text", src), valid, dlq, ckpt).awaitTermination()
    assert spark.read.json(valid).count() == 1 + 3 + 3
    assert spark.read.json(dlq).count() == 9 + 8 + 3
    ok = spark.read.json(valid).first()
    assert ok["_validation_status"] == "valid" and ok["_validated_at"]
    assert (ok["country"], ok["unit"], ok["source"]) == ("VN", "µg/m³", "openaq")   # contract defaults


def test_keyed_json_and_counts(spark):
    df = spark.createDataFrame([(m,) for m, _ in CASES], "value string")
    checked = V.validate(df)
    counts = {(r["status"], r["reason"]): r["n"] for r in V.reason_counts(checked).collect()}
    assert counts[("valid", "")] == 7 and counts[("invalid", "type:location_id")] == 5
    assert counts[("invalid", "missing:location_id")] == 2 and counts[("invalid", "malformed")] == 3
    keyed = V.keyed_json(checked.filter("status = 'valid'").select("message.*"))
    assert keyed.first()["key"] == "12_pm25"


def test_stream_change_fold(spark, tmp_path):
    src, state, ckpt = (str(tmp_path / n) for n in ("changes", "state", "ckpt"))
    schema = "id int, op string, seq int, v string"
    _write_lines(src, "1.json", [json.dumps(r) for r in [
        {"id": 1, "op": "r", "seq": 1, "v": "a"}, {"id": 2, "op": "c", "seq": 1, "v": "x"}]])
    stream = spark.readStream.schema(schema).json(src)
    stream_changes.fold_changes_stream(stream, ["id"], ["seq"], state, ckpt).awaitTermination()
    _write_lines(src, "2.json", [json.dumps(r) for r in [
        {"id": 1, "op": "u", "seq": 2, "v": "b"}, {"id": 2, "op": "d", "seq": 2, "v": "x"},
        {"id": 3, "op": "c", "seq": 1, "v": "z"}]])
    stream = spark.readStream.schema(schema).json(src)
    stream_changes.fold_changes_stream(stream, ["id"], ["seq"], state, ckpt).awaitTermination()
    live = sorted(tuple(r) for r in stream_changes.current_state(spark, state, ["id"], ["seq"]).collect())
    assert live == [(1, 2, "b"), (3, 1, "z")]


def test_fold_batch_replay_and_crash(spark, tmp_path):
    state = str(tmp_path / "state")
    schema = "id int, op string, seq int, v string"
    b0 = spark.createDataFrame([(1, "c", 1, "a"), (2, "c", 1, "x")], schema)
    b1 = spark.createDataFrame([(1, "u", 2, "b"), (2, "d", 2, "x")], schema)
    stream_changes.fold_batch(b0, 0, ["id"], ["seq"], state)
    stream_changes.fold_batch(b1, 1, ["id"], ["seq"], state)
    stream_changes.fold_batch(b1, 1, ["id"], ["seq"], state)          # replay of batch 1
    os.makedirs(tmp_path / "state" / "delta" / "batch_id=2")            # crashed batch: no _SUCCESS
    live = sorted(tuple(r) for r in stream_changes.current_state(spark, state, ["id"], ["seq"]).collect())
    assert live == [(1, 2, "b")]
    b2 = spark.createDataFrame([(3, "c", 1, "z")], schema)
    stream_changes.fold_batch(b2, 2, ["id"], ["seq"], state)            # the replay commits batch 2
    live = sorted(tuple(r) for r in stream_changes.current_state(spark, state, ["id"], ["seq"]).collect())
    assert live == [(1, 2, "b"), (3, 1, "z")]


def test_compaction_keeps_the_state_and_removes_layers(spark, tmp_path):
    state, schema = str(tmp_path / "state"), "id int, op string, seq int, v string"
    for n in range(7):
        rows = [(n % 3, "d" if n == 4 else "u", n, f"v{n}"), (10 + n, "c", n, "x")]
        stream_changes.fold_batch(spark.createDataFrame(rows, schema), n, ["id"], ["seq"], state, compact_every=3)
    late = spark.createDataFrame([(1, "u", 0, "old")], schema)      # an older change than the delete
    stream_changes.fold_batch(late, 7, ["id"], ["seq"], state, compact_every=3)
    live = sorted(tuple(r) for r in stream_changes.current_state(spark, state, ["id"], ["seq"]).collect())
    assert live == [(0, 6, "v6"), (2, 5, "v5")] + [(10 + n, n, "x") for n in range(7)]
    kept = sum(len(os.listdir(os.path.join(state, f))) for f in ("base", "delta"))
    assert kept <= 4


def test_compaction_rewrites_changed_buckets_only(spark, tmp_path):
    state, schema = str(tmp_path / "state"), "id int, op string, seq int, v string"
    fold = lambda rows, n: stream_changes.fold_batch(
        spark.createDataFrame(rows, schema), n, ["id"], ["seq"], state, compact_every=1, buckets=8)
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(os.path.join(state, "base"))
                       for f in fs if f.endswith(".parquet"))
    fold([(i, "c", 0, f"value {i} " * 20) for i in range(8_000)], 0)
    fold([(8_000, "c", 0, "x")], 1)                                   # two batches: the base
    whole, before = size(), {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(state, "base")) for f in fs if f.endswith(".parquet")}
    for n in range(2, 6):                                             # small changes of one key
        stream_changes.fold_batch(spark.createDataFrame([(7, "u", n, f"v{n}")], schema), n, ["id"], ["seq"], state, compact_every=99, buckets=8)
    read = stream_changes.compact(spark, state, ["id"], ["seq"], buckets=8)
    assert 0 < read < whole / 20 and before <= {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(state, "base")) for f in fs}
    assert os.listdir(os.path.join(state, "delta")) == []
    live = {r.id: r.v for r in stream_changes.current_state(spark, state, ["id"], ["seq"]).collect()}
    assert len(live) == 8_001 and live[7] == "v5" and live[8_000] == "x"
    # as many changes as there are rows: the layers become one again
    fold([(i, "u", 99, "new") for i in range(8_000)], 6)
    fold([(i, "u", 100, f"newer {i} " * 30) for i in range(8_000)], 7)
    layers = stream_changes._base(spark, state)[1]
    assert all(len(of) <= 2 for of in layers.values())
    assert {r.v.split()[0] for r in stream_changes.current_state(spark, state, ["id"], ["seq"]).collect()} == {"newer", "x"}


def test_batch_stats_are_the_status_counts(spark):
    for total, valid in ((0, 0), (1, 1), (3, 2), (8, 1), (2000, 1), (1000, 333), (10_000, 9_995)):
        df = spark.range(total).select(F.when(F.col("id") < valid, "valid").otherwise("invalid").alias("status"))
        want = status_counts(df).first().asDict()
        assert V.batch_stats(total, valid) == {**want, "valid_count": want["valid_count"] or 0, "invalid_count": want["invalid_count"] or 0}


def test_a_longer_feed_comes_in_larger_files(spark, tmp_path, monkeypatch):
    """Micro-batches of a fixed few rows would grow in number with the feed."""
    from airshed.plans import check_streams as C

    assert [C.rows_of_file(n) for n in (0, 150_000, 9_000_000, 10**9)] == [2_000, 2_000, 112_500, 250_000]
    monkeypatch.setattr(C, "FILES", 8)
    monkeypatch.setattr(C, "RECORDS", 10)
    files = {}
    for n in (80, 8_000):
        C.write_feed(spark.range(n, numPartitions=2), str(tmp_path / f"{n}"), "json")
        files[n] = len([f for f in os.listdir(tmp_path / f"{n}") if f.endswith(".json")])
        assert spark.read.json(str(tmp_path / f"{n}")).count() == n
    assert files == {80: 8, 8_000: 8}
