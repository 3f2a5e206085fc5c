"""Sources: file/table/JDBC scans, inline rule tables, date spines, seeds.

Schemas are always explicit (no inference pass over the data). Parquet
scans push filters and column pruning into the reader; JDBC reads are
split on a numeric column when bounds are given.
"""

from __future__ import annotations

import csv
import io
from datetime import date
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SEED_SCHEMAS: dict[str, str] = {
    "vietnam_cities": "city_code string, city_name string, latitude double, longitude double, region string",
    "vietnam_rivers": ("river_id string, river_name string, monitoring_point string, latitude double, "
                       "longitude double, basin string"),
    "pollutant_standards": (
        "pollutant_code string, pollutant_name string, unit string, who_guideline_24h double, "
        "qcvn_standard_24h double, who_guideline_annual double, qcvn_standard_annual double, "
        "aqi_breakpoint_good double, aqi_breakpoint_moderate double, aqi_breakpoint_unhealthy_sg double, "
        "aqi_breakpoint_unhealthy double, aqi_breakpoint_very_unhealthy double, aqi_breakpoint_hazardous double"),
}


def read_source(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
                fmt: str = "parquet", **opts) -> DataFrame:
    """Scan files (or a catalog table when ``fmt='table'``) with an explicit
    schema; several paths are read as one relation (U2)."""
    if fmt == "table":
        return spark.table(path if isinstance(path, str) else path[0])
    reader = spark.read.format(fmt).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str, **opts) -> DataFrame:
    """CSV with a header row and a declared schema (seed tables)."""
    return read_source(spark, path, schema, fmt="csv", header="true", mode="PERMISSIVE", **opts)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_col: str | None = None,
              bounds: tuple[int, int] | None = None, parts: int = 8, **props) -> DataFrame:
    """JDBC scan; with ``partition_col`` and ``bounds`` the read is split
    into ``parts`` parallel range queries instead of one connection."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_col and bounds:
        reader = (reader.option("partitionColumn", partition_col)
                        .option("lowerBound", str(bounds[0]))
                        .option("upperBound", str(bounds[1]))
                        .option("numPartitions", str(parts)))
    for k, v in props.items():
        reader = reader.option(k, v)
    return reader.load()


def _struct_type(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def inline_table(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    """A fixed rule table (VALUES list) as a DataFrame.

    Built from JVM literals (``inline(array(struct(...)))`` over a one-row
    range), so it is a local relation: no Python worker is started on the
    executors to hand over a few rows, and the optimizer sees its size.
    """
    st = _struct_type(schema)
    rows = list(rows)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, st.fields)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def date_spine(spark: SparkSession, start: str, end_exclusive: str, col_name: str = "date_day") -> DataFrame:
    """Days in [start, end_exclusive), generated in parallel by ``range``."""
    n = (date.fromisoformat(end_exclusive) - date.fromisoformat(start)).days
    return spark.range(0, max(n, 0)).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(col_name))


def date_spine_from(bounds: DataFrame, start_col: str, end_col: str, col_name: str = "date_day") -> DataFrame:
    """Days between two date columns of a (one-row) bounds frame, end
    exclusive; the size is the calendar span, not the data size."""
    return bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"),
                                              F.date_sub(F.col(end_col).cast("date"), 1),
                                              F.expr("INTERVAL 1 DAY"))).alias(col_name))


def seed_rows(name: str) -> list[dict[str, str]]:
    """Rows of a packaged seed file (fixed, small)."""
    text = resources.files("airshed.resources.seeds").joinpath(f"{name}.csv").read_text(encoding="utf-8")
    return list(csv.DictReader(io.StringIO(text)))


def seed_frame(spark: SparkSession, name: str) -> DataFrame:
    """A packaged seed as a DataFrame (built on the driver from a file of a
    few dozen rows, so it needs no shared storage)."""
    fields = [f.split() for f in SEED_SCHEMAS[name].split(", ")]
    text_df = inline_table(spark, [tuple(r.values()) for r in seed_rows(name)],
                           ", ".join(f"{n} string" for n, _ in fields))
    # CSV semantics: an empty cell is NULL; typed cells are cast.
    return text_df.select([F.nullif(F.col(n), F.lit("")).try_cast(t).alias(n) for n, t in fields])


def write_seed_csv(spark: SparkSession, name: str, path: str) -> str:
    """Write a packaged seed as a header CSV to shared storage (so a
    cluster can scan it with ``read_csv_table``)."""
    seed_frame(spark, name).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path


# Raw fire-detection feed columns (all text, as landed).
FIRE_CSV_SCHEMA = ("latitude string, longitude string, bright_ti4 string, scan string, track string, "
                   "acq_date string, acq_time string, satellite string, instrument string, confidence string, "
                   "version string, bright_ti5 string, frp string, daynight string")


class EmptyFeedError(RuntimeError):
    """A feed that must not be empty returned no rows."""


def read_feed_csv(spark: SparkSession, path: str, schema: str = FIRE_CSV_SCHEMA,
                  require_rows: bool = True) -> DataFrame:
    """A CSV feed with a header. An empty feed is an error (the caller
    then serves the last good batch, S22) rather than an empty landing."""
    df = read_csv_table(spark, path, schema)
    if require_rows and df.isEmpty():
        raise EmptyFeedError(f"feed at {path} returned no rows")
    return df


def table_exists(spark: SparkSession, name: str, schema: str | None = None) -> bool:
    """Catalog probe."""
    return spark.catalog.tableExists(name, schema) if schema else spark.catalog.tableExists(name)


def list_schemas(spark: SparkSession) -> list[str]:
    """S21 + O1: database names, ordered by name (catalog metadata, not data)."""
    return sorted(db.name for db in spark.catalog.listDatabases())


def sql_over(spark: SparkSession, query: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One SQL query over frames from different sources (lake files,
    warehouse tables, JDBC), each registered as a temporary view."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def read_partitioned(spark: SparkSession, path: str, partition_cols=("year", "month", "day"),
                     fmt: str = "parquet") -> DataFrame:
    """Read a ``col=value`` partitioned folder keeping the partition values
    as text (``month=02`` stays '02'; type inference would make it 2)."""
    from pyspark.sql.types import StringType, StructField

    inferred = spark.read.format(fmt).load(path).schema
    fields = [StructField(f.name, StringType(), True) if f.name in partition_cols else f for f in inferred.fields]
    return spark.read.format(fmt).schema(StructType(fields)).load(path)
