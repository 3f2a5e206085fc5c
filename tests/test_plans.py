"""Plan properties that keep the jobs scalable (checked on the optimised
physical plan, nothing executed): no Python evaluation, no cartesian or
nested-loop joins, large tables never broadcast unless an aggregate bounds
them first, partial aggregation before shuffles, pruned scans."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
FACT_TABLES = ("events", "lineitem", "orders", "documents", "pages")
# queries that write or run streams when called (checked by the oracle tests instead)
SIDE_EFFECTS = {"q01_seed_csv_join", "q40_land_batch", "q42_stream_route", "q43_stream_change_fold",
                "q46_lake_jobs", "q51_keyed_json", "q52_csv_feed", "q53_batches_in_box", "q54_landing_log",
                "q55_atomic_replace", "q56_landed_batches", "q57_stream_resume"}
# queries over raw pages: read by the page scanner
SCANNED = {"q28_html_items", "q44_list_pages", "q45_table_pages"}
NAMES = sorted(n for n in E.queries() if n[0] == "q" and n not in SIDE_EFFECTS)


def plan_of(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def subtrees(plan, marker):
    """Text of each subtree rooted at a line containing ``marker``."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if marker in line:
            depth = line.index(marker)
            body = [line]
            for nxt in lines[i + 1:]:
                stripped = re.sub(r"^[\s:|+-]*", "", nxt)
                pos = len(nxt) - len(stripped)
                if pos <= depth:
                    break
                body.append(nxt)
            out.append("\n".join(body))
    return out


@pytest.mark.parametrize("name", NAMES)
def test_plan_properties(spark, name):
    plan = plan_of(spark, name)
    # only the page scanner is Python: Arrow batches, once a page
    allowed = r"(?!)" if name not in SCANNED else r"ArrowEvalPython"
    assert not re.search(r"BatchEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", plan)
    assert len(re.findall("ArrowEvalPython", plan)) == len(re.findall(allowed, plan)) <= 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for sub in subtrees(plan, "BroadcastExchange"):
        scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet", sub)
        if any(t in FACT_TABLES for t in scans):
            assert "HashAggregate" in sub, f"{name}: a large table is broadcast without a bounding aggregate"
    for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan):
        assert scan.count(",") < 12, f"{name}: scan reads too many columns: {scan}"


@pytest.mark.parametrize("name", ["q10_daily_aqi_city", "q14_daily_stats", "q18_daily_summary",
                                  "q31_change_fold", "q32_quality_rules", "q15_daily_mode"])
def test_partial_aggregation_before_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert re.search(r"partial_(avg|count|max|min|sum|max_by|mode)", plan), name


def test_fixed_dimensions_are_broadcast(spark):
    plan = plan_of(spark, "q13_priority_dim_join")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_grown_tables_carry_no_broadcast_hint(spark):
    # customer grows with the data: the static plan joins it by shuffle, AQE may change that
    plan = plan_of(spark, "q04_stage_air_quality")
    assert not any("customer.parquet" in sub for sub in subtrees(plan, "BroadcastExchange"))
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize("name", NAMES)
def test_building_a_plan_starts_no_job(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", name)
    try:
        E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan()
        ids = sc.statusTracker().getJobIdsForGroup(f"plan-{name}")
    finally:
        sc._jsc.clearJobGroup()
    # reading a parquet footer is the one job a plan may need
    stages = [s for i in ids for s in sc.statusTracker().getJobInfo(i).stageIds]
    assert all("parquet at" in sc.statusTracker().getStageInfo(s).name for s in stages), name


def test_keyword_rules_stay_inside_codegen(spark):
    plan = plan_of(spark, "q22_keyword_rules")
    assert "transform(" not in plan and "SortMergeJoin" not in plan
    # the plan string marks the stages of whole-stage codegen with an asterisk
    assert re.search(r"\*\(1\) Project .*CASE WHEN", plan)


def test_fallback_reads_its_source_twice(spark):
    plan = plan_of(spark, "q29_snapshot_fallback")
    assert plan.count("FileScan parquet") == 2 and plan.count("SortMergeJoin") == 1


def test_positional_zip_has_no_join(spark):
    assert "Join" not in plan_of(spark, "q38_zip_positions")
