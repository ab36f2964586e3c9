"""Join operators on hot, NULL and clashing keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, rows
from etlkit.operators import joins as J
from etlkit.runtime import join_groups, plan_bytes


@pytest.fixture(scope="module")
def sides(spark):
    left = [(i, 7 if i % 3 == 0 else (None if i % 10 == 1 else i % 20)) for i in range(600)]
    right = [(k, f"r{k}-{c}") for k in range(15) for c in range(2 if k == 7 else 1)]
    return spark.createDataFrame(left, "id int, k int"), spark.createDataFrame(right, "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_hot_keys_changes_nothing(sides, how):
    left, right = sides
    ours = J.copartitioned_join(left, right, "k", ["id"], n=5, how=how, share=0.1, rows_per_salt=5)
    assert rows(ours.na.fill("-").na.fill(-1)) == rows(left.join(right, "k", how).select(ours.columns).na.fill("-").na.fill(-1))


def test_hot_keys_are_few(sides):
    hot = J.hot_keys(sides[0], "k", 0.1)
    assert list(hot) == [7]
    with pytest.raises(ValueError):
        J.hot_keys(sides[0], "k", 0)
    with pytest.raises(ValueError):
        J.copartitioned_join(*sides, "k", ["id"], how="full")


def test_broadcast_needs_a_small_side(sides):
    left, right = sides
    assert "BroadcastHashJoin" in executed_plan(J.join_dim(left, right, "k"))
    big = left.sparkSession.range(10_000_000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    assert plan_bytes(big) > 1024
    assert "SortMergeJoin" in J.join_with(left, big, "k", "broadcast", limit=1024)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="strategy"):
        J.join_with(left, right, "k", "shuffle_replicate_nl")
    assert "SortMergeJoin" in J.join_with(left, right, "k", "merge")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in J.join_with(left, right, "k", "shuffle_hash")._jdf.queryExecution().executedPlan().toString()


def test_star_join_refuses_clashing_names(sides):
    left, right = sides
    with pytest.raises(ValueError, match="rename"):
        J.star_join(left, [(right, "k"), (right.select("k", "name"), "k")])


def test_anti_and_semi(sides):
    left, right = sides
    kept = J.unmatched(left, right, "k").count()
    assert kept + J.matched(left, right, "k").count() == left.count()


def test_group_join_matches_nulls(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    g = a.groupBy("k").agg(F.sum("v").alias("s"))
    assert sorted(r.s for r in join_groups(a, g, ["k"]).collect()) == [1, 2]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("before,after", [(120, 120), (0, 60), (45, 0)])
def test_interval_join_against_brute_force(spark, how, before, after):
    rng, base = random.Random(before + after), dt.datetime(2024, 1, 1)
    make = lambda n: [(i, rng.choice([1, 1, 1, 2]), base + dt.timedelta(seconds=15 * rng.randrange(80))) for i in range(n)]
    a, b = make(40), make(40)
    left = spark.createDataFrame(a, "a int, k int, at timestamp_ntz")
    right = spark.createDataFrame(b, "b int, k int, bt timestamp_ntz")
    got = J.interval_join(left, right, "k", "at", "bt", before, after, how).select("a", F.coalesce("b", F.lit(-1)))
    expected = []
    for i, k, at in a:
        hits = [j for j, kk, bt in b if kk == k and -before <= (bt - at).total_seconds() <= after]
        expected += [(i, j) for j in hits] or ([(i, -1)] if how == "left" else [])
    assert rows(got) == sorted(expected)


def test_interval_join_checks_names(spark):
    df = spark.createDataFrame([(1, 2)], "k int, t int")
    with pytest.raises(ValueError, match="rename"):
        J.interval_join(df, df, "k", "t", "t", 1, 1)


def test_join_auto_picks_by_size(sides):
    left, right = sides
    expected = rows(left.join(right, "k").select("id", "name"))
    assert rows(J.join_auto(left, right, "k", ["id"]).select("id", "name")) == expected
    assert rows(J.join_auto(left, right, "k", ["id"], limit=0).select("id", "name")) == expected


def test_deviation_and_chain(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, v double")
    assert rows(J.deviation_from_group(df, "g", "v")) == [("a", 1.0, 2.0, 1.0), ("a", 3.0, 2.0, 1.0), ("b", 5.0, 5.0, 0.0)]
    chain = J.join_chain(df, (spark.createDataFrame([("a", 9)], "g string, n int"), "g"))
    assert chain.count() == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_bucketed_join_with_a_hot_key(spark, tmp_path, how):
    from conftest import initial_plan
    from etlkit.operators.joins import bucketed_join_split
    from etlkit.sinks.files import write_bucketed

    left = spark.range(5_000).select(F.when(F.col("id") % 5 > 0, 1).when(F.col("id") % 35 == 0, None).otherwise(F.col("id") % 50).cast("long").alias("k"), F.col("id").alias("row"))
    right = spark.range(0, 60, 2).unionByName(spark.createDataFrame([(1,)], "id long")).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    tables = [f"hot_{how}_{n}" for n in ("l", "r")]
    for name, df in zip(tables, (left, right)):
        write_bucketed(df, name, "k", 4, sort_by="k", path=f"{tmp_path}/{name}")
    got = bucketed_join_split(spark, *tables, "k", ["row"], how=how, rows_per_salt=500)
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", how).collect()))
    cold = initial_plan(got).split("Union")[1].split("__salt")[0]
    assert "SelectedBucketsCount: 4 out of 4" in initial_plan(got) and "Exchange hashpartitioning(k" not in cold.split("SortMergeJoin")[1]
    for name in tables:
        spark.sql(f"DROP TABLE {name}")
