"""Stream validation and routing (ST1, ST2, S9, S15, S16, P11, P12, A10).

``validate`` is a pure DataFrame -> DataFrame rule chain, so the same code
runs on a batch table and on a Structured Streaming source. Messages are
parsed once into one variant per field; a field's JSON kind comes from
``schema_of_variant`` (missing key -> NULL, JSON null -> VOID), which keeps
"missing", "null" and "wrong type" apart without a Python worker. As for a
dictionary, the last value of a repeated key counts, NaN is a number and an
integer may be of any size.

``route`` writes valid rows and dead letters from one micro-batch: the
batch is persisted once, both outputs are written to folders named by the
batch id with overwrite, so a replayed batch (after a failure before the
checkpoint commit) rewrites the same files — effectively exactly-once.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airshed import rules
from airshed.operators.aggregates import observe_counts

MESSAGE_FIELDS = ("location_id bigint, location_name string, city string, country string, latitude double, "
                  "longitude double, parameter string, value double, unit string, date_utc string, "
                  "date_local string, source string, produced_at string")

_KIND_TEST = {
    # beyond 64 bits an integer is a decimal without fraction digits
    "int": lambda t: (t == "BIGINT") | t.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$"),
    "string": lambda t: t == "STRING",
    "number": lambda t: (t == "BIGINT") | (t == "DOUBLE") | (t == "FLOAT") | t.startswith("DECIMAL"),
}


_UNREADABLE = "_unreadable"


def parse_message(json_col: Column, fields: Sequence[str]) -> Column:
    """The top-level fields of a JSON object as variants; ``_unreadable``
    holds the text of anything else."""
    schema = ", ".join([*(f"{f}: variant" for f in fields), f"{_UNREADABLE}: string"])
    return F.from_json(json_col, f"struct<{schema}>", {"columnNameOfCorruptRecord": _UNREADABLE})


def validate(df: DataFrame, json_col: str = "value",
             required: Sequence[tuple[str, str]] = rules.REQUIRED_FIELDS,
             enum_field: str = "parameter", enum_values: Sequence[str] = rules.VALID_POLLUTANTS,
             value_field: str = "value", box=rules.VIETNAM_BOX) -> DataFrame:
    """Adds ``reason`` (NULL when valid), ``status`` (valid/invalid) and the
    typed message fields as struct ``message``. The first failing rule gives the reason:
    malformed, missing:<f>, type:<f>, enum:<f>, range:<f>, box."""
    fields = [f.split() for f in MESSAGE_FIELDS.split(", ")]
    names = list(dict.fromkeys([n for n, _ in fields] + [n for n, _ in required] + [enum_field, value_field]))
    text = F.col(json_col).cast("string")
    parsed = df.withColumn("_v", parse_message(text, names))
    # unparseable text or a bare scalar is malformed; an array has no keys,
    # so it fails on the first required field (as a membership test on a
    # list would)
    is_list = F.ltrim(text).startswith("[") & F.try_parse_json(text).isNotNull()
    reason = F.when(text.isNull() | (F.col(f"_v.{_UNREADABLE}").isNotNull() & ~is_list), F.lit("malformed"))
    for name, kind in required:
        t = F.schema_of_variant(F.col(f"_v.{name}"))
        reason = reason.when(t.isNull(), F.lit(f"missing:{name}"))
        reason = reason.when(~_KIND_TEST[kind](t), F.lit(f"type:{name}"))
    getv = lambda n, typ: F.try_variant_get(F.col(f"_v.{n}"), "$", typ)
    reason = reason.when(~getv(enum_field, "string").isin(list(enum_values)), F.lit(f"enum:{enum_field}"))
    reason = reason.when(getv(value_field, "double") < 0, F.lit(f"range:{value_field}"))
    lat, lon = getv("latitude", "double"), getv("longitude", "double")
    lat_lo, lat_hi, lon_lo, lon_hi = box
    reason = reason.when(~(lat.between(lat_lo, lat_hi) & lon.between(lon_lo, lon_hi)), F.lit("box"))
    typed = F.struct(*[getv(n, typ).alias(n) for n, typ in fields])
    out = parsed.select("*", reason.alias("reason"), typed.alias("message")).drop("_v")
    return out.withColumn("status", F.when(F.col("reason").isNull(), "valid").otherwise("invalid"))


def reason_counts(validated: DataFrame) -> DataFrame:
    """A10: rows per status and reason."""
    return validated.groupBy("status", F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


def dlq_envelope(invalid: DataFrame, json_col: str, rejected_at: Column, topic: Column,
                 partition: Column, offset: Column) -> DataFrame:
    """Dead-letter record around the original message."""
    return invalid.select(
        F.col(json_col).cast("string").alias("original_message"),
        F.col("reason").alias("error_reason"), rejected_at.cast("string").alias("rejected_at"),
        topic.alias("source_topic"), partition.alias("source_partition"), offset.alias("source_offset"))


def valid_output(valid: DataFrame, validated_at: Column,
                 defaults: dict[str, str] = rules.MESSAGE_DEFAULTS) -> DataFrame:
    """P11 + ST6: valid message with the contract's defaults for optional
    fields (country, unit, source) and validation metadata."""
    out = valid.select("message.*")
    out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items() if k in out.columns})
    return out.select("*", validated_at.cast("string").alias("_validated_at"),
                      F.lit("valid").alias("_validation_status"))


def keyed_json(df: DataFrame, key_cols: Sequence[str] = ("location_id", "parameter")) -> DataFrame:
    """(key, value) records for a keyed stream sink; key ``id_param``."""
    return df.select(F.concat_ws("_", *[F.col(c).cast("string") for c in key_cols]).alias("key"),
                     F.to_json(F.struct(*df.columns)).alias("value"))


def publish(df: DataFrame, fmt: str = "kafka", checkpoint: str | None = None,
            key_cols: Sequence[str] = ("location_id", "parameter"), **opts):
    """Write messages as keyed JSON records. A streaming frame starts a
    query (checkpointed, so a restart resumes); a batch frame is written
    once. ``fmt='kafka'`` needs the Kafka connector on the classpath;
    ``json``/``parquet`` folders work everywhere."""
    out = keyed_json(df, key_cols)
    if df.isStreaming:
        w = out.writeStream.format(fmt).options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    out.write.format(fmt).options(**opts).mode("append").save()
    return None


def read_stream(spark: SparkSession, fmt: str, path: str | None = None, schema: str | None = None,
                **opts) -> DataFrame:
    """Stream source; Kafka with ``startingOffsets=earliest`` or a file
    folder (tests, replays)."""
    reader = spark.readStream.format(fmt).options(**opts)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def batch_stats(total: int, valid: int) -> dict:
    """The counts of ``status_counts``, from observed ones."""
    rate = (2000 * valid + total) // (2 * total) / 10 if total else None
    return {"valid_count": valid, "invalid_count": total - valid, "total_count": total, "pass_rate_pct": rate}


def _log_stats(batch_id: int, stats: dict) -> None:
    logging.getLogger("airshed.stream").info(
        "batch %d: %d valid, %d invalid (%.1f%% pass rate)", batch_id, stats["valid_count"],
        stats["invalid_count"], stats["pass_rate_pct"] or 0.0)


def route(stream: DataFrame, valid_path: str, dlq_path: str, checkpoint: str,
          json_col: str = "value", topic: str | Column = "raw-air-quality",
          position: tuple[Column, Column] | None = None,
          trigger: dict | None = None, fmt: str = "json",
          on_batch: Callable[[int, dict], None] | None = _log_stats,
          parallelism: int | None = None) -> StreamingQuery:
    """T-24: validate a stream and write valid rows / dead letters.

    ``position`` gives (partition, offset) columns of the source (Kafka:
    ``partition``, ``offset``; ``topic`` may be the ``topic`` column); for
    files the file path and -1 are used. ``parallelism`` deals each
    micro-batch to that many tasks, for a source with fewer partitions than
    the cluster has cores. Progress (ST5/A10): the input row count of every micro-batch is an
    observed metric in ``StreamingQueryProgress.observedMetrics``, and
    ``on_batch(batch_id, stats)`` receives the valid/invalid counts and
    pass rate, observed on the write of the valid rows: no job of their own.
    """
    part, off = position or (F.col("_metadata.file_path"), F.lit(-1).cast("long"))
    src_topic = F.lit(topic) if isinstance(topic, str) else topic
    enriched = (stream.select("*", part.cast("string").alias("_src_partition"),
                              off.cast("long").alias("_src_offset"), src_topic.alias("_src_topic"))
                      .observe("route_input", F.count(F.lit(1)).alias("rows")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.repartition(parallelism) if parallelism else batch
        checked = validate(rows, json_col).persist()
        try:
            now = F.current_timestamp()
            counted, seen = observe_counts(checked, "route", valid=F.count_if(F.col("status") == "valid"))
            valid_output(counted.filter(F.col("status") == "valid"), now) \
                .write.mode("overwrite").format(fmt).save(f"{valid_path}/batch_id={batch_id}")
            dlq_envelope(checked.filter(F.col("status") == "invalid"), json_col, now, F.col("_src_topic"),
                         F.col("_src_partition"), F.col("_src_offset")) \
                .write.mode("overwrite").format(fmt).save(f"{dlq_path}/batch_id={batch_id}")
            if on_batch is not None:
                on_batch(batch_id, batch_stats(seen.get["rows"], seen.get["valid"]))
        finally:
            checked.unpersist()

    writer = enriched.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
