"""Shape of physical plans: what is pushed down, shuffled, broadcast and limited."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, initial_plan
from etlkit.operators import aggregates as A
from etlkit.operators import joins as J
from etlkit.operators import relational as R
from etlkit.operators import windows as W
from etlkit.plans.catalogue import QUERIES
from etlkit.runtime import estimate_holds, plan_bytes


def exchanges(plan):
    return len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", plan))


def test_filters_and_columns_reach_the_scan(spark, data):
    scan = QUERIES["scan_pruned"](spark, data)
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderdate), EqualTo(o_orderstatus,F), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    plan = initial_plan(QUERIES["early_projection"](spark, data))
    assert "GreaterThan(l_extendedprice,20000.0)" in plan and "l_tax" not in plan


def test_aggregation_combines_before_its_only_shuffle(spark, data):
    plan = initial_plan(QUERIES["group_summary"](spark, data))
    assert exchanges(plan) == 1 and "partial_sum" in plan
    plan = initial_plan(QUERIES["group_on_partition_key"](spark, data))
    assert exchanges(plan) == 1
    assert exchanges(plan) == 1


def test_profile_shuffles_hashes_not_rows(spark, table):
    from etlkit.operators.quality import profile

    plan = initial_plan(profile(table("documents")))
    hashed = [line for line in plan.splitlines() if "Exchange hashpartitioning(__h1" in line]
    assert hashed and "partial_count" in plan
    # What is grouped by hash before the shuffle is two hashes and a count; texts follow only for repeated hashes.
    before = [line for line in plan.splitlines() if "HashAggregate(keys=[__h1" in line]
    assert before and not any("text" in line for line in before)
    assert "LeftSemi" in plan


def test_top_k_keeps_k_rows_per_task(spark, data):
    plan = initial_plan(QUERIES["top_per_group"](spark, data))
    assert "Partial" in plan[plan.index("WindowGroupLimit"):] and plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in initial_plan(QUERIES["top_orders"](spark, data))


def test_block_windows_shuffle_the_detail_twice(spark, table):
    df = table("lineitem").select("l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = W.Ordering(["l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], [F.col("l_shipdate")])
    plan = executed_plan(W.moving(df, order, {"s": ("sum", "l_extendedprice", 3)}, block=1000))
    assert len(re.findall(r"Exchange hashpartitioning\(l_returnflag#\d+, __block", plan)) == 1
    # The others carry cells: one for the detail, the rest for their counts.
    assert plan.count("row_number() windowspecdefinition(__cell") >= 1
    # No detail row is windowed by the flag alone.
    assert not re.search(r"row_number\(\) windowspecdefinition\(l_returnflag", plan)


def test_group_stats_need_no_window(spark, data):
    assert "Window" not in initial_plan(QUERIES["group_stats_on_rows"](spark, data))
    assert "Window" not in initial_plan(QUERIES["duplicate_marks"](spark, data))


def test_interval_join_is_an_equi_join_on_time_slots(spark, data):
    plan = initial_plan(QUERIES["interval_join_inner"](spark, data))
    assert re.search(r"Join \[user_id#\d+L?, __slot", plan) and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "join_bucketed"))))
def test_no_cross_joins_and_no_python(spark, data, name):
    plan = initial_plan(QUERIES[name](spark, data))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CollectLimit"):
        assert word not in plan, word
    # A window over everything may only run on rows that are aggregated already: months, here.
    in_one_task = re.search(r"\bWindow [^\n]*\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)
    assert bool(in_one_task) == (name == "monthly_moving_average")


def test_semi_and_anti_joins(spark, data):
    assert "LeftSemi" in initial_plan(QUERIES["semi_join_exists"](spark, data))
    assert "LeftAnti" in initial_plan(QUERIES["anti_join"](spark, data))


def test_copartitioned_join_spreads_hot_keys(spark, table):
    one = (F.col("l_orderkey") - F.col("l_orderkey") + 1).alias("p_partkey")
    lines = table("lineitem").select(one, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    joined = J.copartitioned_join(lines, table("part").select("p_partkey", "p_name"), "p_partkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], n=8, rows_per_salt=500)
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == lines.count() and len(sizes) > 3 and max(sizes) < 0.6 * lines.count()


def test_copartitioned_join_reads_the_fact_twice(spark, table):
    joined = J.copartitioned_join(table("lineitem"), table("part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", ["l_orderkey", "l_linenumber"])
    assert initial_plan(joined).count("FileScan") == 2  # the sketch's own read of the key is a job of its own


def test_no_broadcast_by_an_estimate_that_does_not_hold(spark, table):
    few = spark.range(1000).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(100_000)))).select("k")
    long = spark.range(1000).select("id", F.repeat(F.lit("x"), 1_000_000).alias("v"))
    fact = table("lineitem").select(F.col("l_partkey").cast("int").alias("k"), F.col("l_partkey").alias("id"))
    assert plan_bytes(few) < 100_000 and not estimate_holds(few) and not estimate_holds(long)
    for joined in (J.join_dim(fact, few, "k"), J.join_dim(fact, long, "id"), J.join_with(fact, few, "k", "broadcast"),
                   J.join_auto(fact, few, "k", ["id"])):
        assert "BroadcastHashJoin" not in initial_plan(joined)
    assert estimate_holds(table("part").filter("p_size > 3").select("p_partkey", "p_name"))
    assert estimate_holds(table("part").groupBy("p_brand").agg(F.sum("p_size").alias("s")))
    assert not estimate_holds(table("part").groupBy("p_brand").agg(F.collect_list("p_name").alias("s")))


def test_two_level_totals_and_range_sort(spark, table):
    df = table("orders")
    assert "partial_sum" in initial_plan(A.preaggregate(df, ["o_orderdate"], {"y": F.year("o_orderdate")}, "o_totalprice"))
    assert "rangepartitioning" in initial_plan(R.range_sorted(df, "o_orderdate", 4))


def test_operator_set_totals_reads_each_table_once_a_use(spark, data):
    plan = initial_plan(QUERIES["operator_set_totals"](spark, data))
    assert plan.count("FileScan") == 3 and "stddev" not in plan


def test_time_frames_of_many_rows_are_put_together_of_pieces(spark, data):
    # A range frame of six hours sums up all its rows anew for each row.
    assert "-21600000000" not in initial_plan(QUERIES["time_range_frames"](spark, data))


def test_peers_are_looked_up_without_dealing_rows_by_group(spark, data):
    plan = executed_plan(QUERIES["first_and_last_of_peers"](spark, data))
    assert "BroadcastHashJoin" in plan and not exchanges(plan)


@pytest.mark.parametrize("name", ["first_and_last", "group_stats_on_rows"])
def test_few_groups_are_looked_up_without_dealing_rows_by_group(spark, data, name):
    plan = executed_plan(QUERIES[name](spark, data))
    assert "BroadcastHashJoin" in plan and not exchanges(plan)


def test_ranks_of_repeated_values_are_looked_up_without_a_shuffle_of_the_rows(spark, data):
    plan = executed_plan(QUERIES["rank_by_value_descending"](spark, data))
    assert "BroadcastHashJoin" in plan and not exchanges(plan)
