"""Smaller operators: observed counts,
status counts, quality gate, multi-path reads, catalog-table sinks."""

import pytest
from pyspark.sql import functions as F

from airshed.operators import aggregates as A
from airshed.operators import quality as Q
from airshed.sources import readers, sinks
from conftest import rows


def test_observe_and_status_counts(spark):
    df = spark.createDataFrame([("valid",), ("invalid",), ("valid",), ("valid",)], "status string")
    observed, obs = A.observe_counts(df, "check", invalid=F.sum(F.when(F.col("status") == "invalid", 1).otherwise(0)))
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 4, "invalid": 1}
    r = A.status_counts(df).first()
    assert (r["valid_count"], r["invalid_count"], r["total_count"], r["pass_rate_pct"]) == (3, 1, 4, 75.0)


def test_assert_rules_stops_on_failure(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    Q.assert_rules(Q.run_rules(df.filter("id is not null"), [Q.Rule("not_null", "id")]))
    with pytest.raises(AssertionError):
        Q.assert_rules(Q.run_rules(df, [Q.Rule("not_null", "id")]))


def test_multi_path_read_and_catalog_sinks(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    spark.range(3, 5).write.parquet(b)
    assert readers.read_source(spark, [a, b], "id long").count() == 5
    df = spark.createDataFrame([(2024, 1, "x"), (2024, 2, "y")], "year int, month int, v string")
    sinks.replace_table(df, "gold_monthly_test", ["year", "month"], catalog_table=True)
    sinks.replace_table(df.limit(1), "gold_monthly_test", ["year", "month"], catalog_table=True)
    assert spark.table("gold_monthly_test").count() == 1
    t = sinks.materialize_table(df, "mart_test", partition_cols=["year"])
    assert t.count() == 2 and readers.table_exists(spark, "mart_test")
