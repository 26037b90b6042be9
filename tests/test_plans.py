"""Plans that must hold at scale: pushed filters, few shuffles, no hot single task."""

import re

from pyspark.sql import functions as F

from tidemark.operators import expect_values as ev
from tidemark.operators import joins as j
from tidemark.operators import reshape as r
from tidemark.operators.suite import Check, run_checks
from tidemark.plans import quality
from tidemark.functions import rules

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_filters_and_columns_reach_the_scan(spark):
    failing = ev.expect_column_values_to_be_between(
        table(spark, "lineitem"), "l_quantity", 2, 49, "l_returnflag = 'A'"
    ).select("l_orderkey")
    text = plan(failing)
    assert "EqualTo(l_returnflag,A)" in text
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in scan.split(",")} == {"l_orderkey", "l_quantity", "l_returnflag"}
    assert "Exchange" not in text


def test_many_checks_read_the_table_once(spark):
    checks = [Check(f"c{i}", rules.outside("l_quantity", i)) for i in range(20)]
    assert plan(run_checks(table(spark, "lineitem"), checks)).count("FileScan") == 1


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    text = plan(r.deduplicate(table(spark, "events"), ["user_id"], [F.desc("ts"), "event_id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_differences_need_one_shuffle(spark):
    pairs = table(spark, "customer").select("c_nationkey", "c_mktsegment")
    text = plan(r.except_both_ways(pairs.where("c_nationkey < 5"), pairs.where("c_nationkey > 3")))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_keys_are_counted_before_a_reference_check(spark):
    text = plan(j.keys_without_match(table(spark, "lineitem"), "l_suppkey", table(spark, "supplier"), "s_suppkey"))
    assert "LeftAnti" in text and "partial_count" in text


def test_ungrouped_order_checks_do_not_sort_in_one_task(spark):
    failing = ev.expect_column_values_to_be_increasing(table(spark, "orders"), "o_totalprice", "o_orderkey")
    text = plan(failing)
    for line in text.splitlines():
        if "Window [lag(_value" in line:
            assert line.split("], [")[1].startswith("_slot")


def jobs_of(spark, group, action):
    """How many Spark jobs an action starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_lookups_run_nothing_while_they_are_built(spark):
    left, right = table(spark, "orders"), table(spark, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    joined, jobs = jobs_of(spark, "lookup", lambda: j.lookup_join(left, right, ["o_custkey"]))
    assert jobs == 0
    assert plan(joined).count("FileScan") == 2


def test_repeated_values_of_all_fields_take_one_aggregation(spark):
    rows = table(spark, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    repeated, jobs = jobs_of(spark, "repeated", lambda: quality.repeated_values(rows, rows.columns[1:], ["o_orderkey"]))
    assert jobs == 0
    text = plan(repeated)
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
