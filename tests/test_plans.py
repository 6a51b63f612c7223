"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
# queries that only build a plan; the others run jobs on the way
LAZY = [
    "word_count", "ngram_count_2", "prefix_word_count", "prefix_word_counters", "prefix_near_max",
    "two_level_count", "all_match_groups",
    "zero_filled_year_counts", "distinct_per_user_year", "exceeding_organizers",
    "low_participation_meetings", "slot_criticality", "slot_criticality_sql",
    "critical_slots_located", "critical_top5", "most_critical_per_station", "critical_kml",
    "label_rows", "classification_metrics", "confusion_matrix", "per_class_scores",
    "in_degree_top10", "motif_1hop",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("all_match_groups", {"l_orderkey", "l_returnflag"}),
        ("word_count", {"text"}),
        ("slot_criticality", {"user_id", "ts", "event_type", "value"}),
        ("confusion_matrix", {"quality", "toxic"}),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for schema in schemas:
        assert {field.split(":")[0] for field in schema.split(",") if field} <= columns


def test_years_reach_the_scan_and_lectures_come_first(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = plan_of(QUERIES["distinct_per_user_year"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01" in plan
    assert "LessThan(l_shipdate,2000-01-01" in plan
    semi, orders = plan.index("LeftSemi"), plan.index("Inner")
    assert orders < semi  # further down is earlier


def test_no_range_of_the_sorted_pairs_holds_most_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = QUERIES["basket_pair_count"](spark, SF_DIR)
        sizes = pairs.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(r[1] for r in sizes) < 0.6 * sum(r[1] for r in sizes)


def test_rows_are_ranked_only_for_a_top_k(spark):
    ranked = {"critical_top1", "critical_top5", "in_degree_top10"}
    for name in set(LAZY) - ranked:
        assert "TakeOrdered" not in plan_of(QUERIES[name](spark, SF_DIR)), name
