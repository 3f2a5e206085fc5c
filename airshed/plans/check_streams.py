"""Check queries Q42-Q43: the streaming jobs end to end.

Each query writes its input (derived from the driver tables) as files
under the checkpoint folder, runs the Structured Streaming job over that
folder with ``availableNow`` (several micro-batches), and reads the sinks
back. The oracles are the batch twins' SQL: a stream must give the same
result as the batch computation over the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.plans.check_nested import LON, MESSAGE_SQL, OP_OF_STATUS, Q31, messages
from airshed.plans.check_staging import map_lit, ntz, table
from airshed.session import scratch_path
from airshed.streaming import changes as stream_changes
from airshed.streaming.validator import MESSAGE_FIELDS, read_stream, route

# Rows of a file and files of a micro-batch, for several micro-batches. What a
# micro-batch costs beside its rows (planning, commits, listings) does not
# shrink with it, so a feed of many rows comes in larger files, FILES of them,
# up to LARGEST rows a file: beyond that their number grows again.
FILES_PER_BATCH, RECORDS = "4", 2_000
FILES, LARGEST = 80, 250_000


def rows_of_file(rows: int) -> int:
    return min(max(RECORDS, -(-rows // FILES)), LARGEST)


def write_feed(feed: DataFrame, path: str, fmt: str) -> None:
    """The rows as the files that a stream reads; they are counted first
    (for a table of files: from their footers)."""
    feed.write.mode("overwrite").option("maxRecordsPerFile", rows_of_file(feed.count())).format(fmt).save(path)


def q42_stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, valid, dlq, ckpt = (scratch_path(spark, n) for n in ("msgs", "valid", "dlq", "route-ckpt"))
    write_feed(messages(spark, sf_dir).select("value"), src, "text")
    stream = read_stream(spark, "text", src, maxFilesPerTrigger=FILES_PER_BATCH)
    route(stream, valid, dlq, ckpt).awaitTermination()
    # rows of both sinks: message fields with the contract's defaults, the
    # validation metadata, the dead letters' envelope (times: present or not)
    ok = spark.read.schema(f"{MESSAGE_FIELDS}, _validated_at string, _validation_status string").json(valid)
    bad = spark.read.schema("original_message string, error_reason string, rejected_at string, source_topic string, "
                            "source_partition string, source_offset bigint").json(dlq)
    good = ok.select(
        F.col("_validation_status").alias("status"), F.lit("").alias("reason"), "location_id", "location_name", "city",
        "country", "latitude", "longitude", "parameter", "value", "unit", "source",
        ntz(F.col("date_utc").cast("timestamp_ntz")).alias("date_utc"), F.col("_validated_at").isNotNull().alias("stamped"),
        F.lit(None).cast("string").alias("topic"), F.lit(None).cast("string").alias("message"))
    dead = bad.select(
        F.lit("invalid").alias("status"), F.col("error_reason").alias("reason"),
        (F.col("rejected_at").isNotNull() & F.col("source_partition").isNotNull() & (F.col("source_offset") == -1)).alias("stamped"),
        F.col("source_topic").alias("topic"), F.col("original_message").alias("message"))
    return good.unionByName(dead, allowMissingColumns=True)


def q43_stream_change_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, state, ckpt = (scratch_path(spark, n) for n in ("changes", "state", "fold-ckpt"))
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate",
        F.element_at(map_lit(OP_OF_STATUS), F.col("o_orderstatus")).alias("op"))
    write_feed(rows, src, "json")
    schema = "o_custkey long, o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz, op string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).json(src)
    stream_changes.fold_changes_stream(stream, ["o_custkey"], ["o_orderdate", "o_orderkey"], state, ckpt,
                                       op_col="op").awaitTermination()
    live = stream_changes.current_state(spark, state, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                        op_col="op")
    return live.select("o_custkey", "o_orderkey", "o_totalprice", ntz("o_orderdate").alias("o_orderdate"))


QUERIES = {"q42_stream_route": q42_stream_route, "q43_stream_change_fold": q43_stream_change_fold}
Q42 = f"""
with e as ({MESSAGE_SQL})
select case when reason is null then 'valid' else 'invalid' end as status, coalesce(reason, '') as reason,
       case when reason is null then user_id end as location_id, case when reason is null then 'Station ' || user_id end as location_name,
       case when reason is null then 'Hà Nội' end as city, case when reason is null then 'VN' end as country,
       case when reason is null then lat end as latitude, case when reason is null then {LON} end as longitude,
       case when reason is null then param end as parameter, case when reason is null then v end as value,
       case when reason is null then 'µg/m³' end as unit, case when reason is null then 'openaq' end as source,
       case when reason is null then ts end as date_utc, true as stamped,
       case when reason is not null then 'raw-air-quality' end as topic,
       case when reason is not null then case when fault = 'json_list' then '[1, 2]'
         when fault = 'malformed_text' then '{{"location_id": ' || user_id
         else '{{' || case fault when 'no_location_id' then '' when 'float_id' then '"location_id":' || cast(user_id as double) || ','
                               when 'bool_id' then '"location_id":true,' else '"location_id":' || user_id || ',' end
              || '"location_name":"Station ' || user_id || '","city":' || case fault when 'null_city' then 'null' else '"Hà Nội"' end
              || ',"latitude":' || lat || ',"longitude":{LON},"parameter":"' || param || '","value":'
              || case fault when 'text_value' then '"' || v || '"' else cast(v as varchar) end
              || ',"unit":"µg/m³","date_utc":"' || ts || '"}}' end end as message
from e
"""
ORACLE = {"q42_stream_route": Q42, "q43_stream_change_fold": Q31}
