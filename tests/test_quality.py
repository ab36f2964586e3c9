"""Profiles, cleaning, validation, history and skew on small frames."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from etlkit.operators import aggregates as A
from etlkit.operators import history as H
from etlkit.operators import layout as L
from etlkit.operators import quality as Q
from etlkit.operators import relational as R
from etlkit.operators import reshape as P

def as_of():
    return F.lit("2024-01-31").cast("date")
SCHEMA = "transaction_id string, customer_id string, product_id string, amount double, transaction_date date, channel string, status string"


@pytest.fixture()
def dirty(spark):
    d, late = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    return spark.createDataFrame([
        ("t1", "c1", "p1", 5.0, d, " web ", "done"), ("t1", "c1", "p1", 5.0, d, " web ", "done"),
        ("t2", None, "p1", None, late, "x", "y"), ("t3", "c1", None, 1.0, d, "x", "y"), ("t4", "c1", "p1", None, d, "x", "y"),
        ("t5", "c1", "p1", -1.0, late, "x", "y"), ("t6", "c1", "p1", 0.0, late, "x", "y"), ("t7", "c2", "p1", 0.0, d, None, "y"),
    ], SCHEMA)


def test_profile(dirty):
    got = {r.metric: (r.value, r.pct) for r in Q.profile(dirty, {"neg": F.col("amount") < 0}).collect()}
    assert got["total_records"] == (8, None) and got["total_columns"] == (7, None)
    assert got["duplicate_rows"] == (1, 12.5) and got["nulls.amount"] == (2, 25.0) and got["rule.neg"] == (1, 12.5)
    empty = {r.metric: (r.value, r.pct) for r in Q.profile(dirty.filter("false")).collect()}
    assert empty["total_records"] == (0, None) and empty["nulls.amount"] == (0, None)


def test_cleaning_first_failure_wins(dirty):
    out = Q.clean(dirty, Q.CLEANING_PLANS["staging_transactions"], as_of())
    assert [(r.reason, r.rows) for r in out.stats.orderBy("step").collect()] == [
        ("original", 8), ("duplicate", 1), ("null_customer_id", 1), ("null_product_id", 1), ("null_amount", 1),
        ("negative_amount", 1), ("future_transaction_date", 1), ("kept", 2)]
    kept = {r.transaction_id: r for r in out.rows.collect()}
    assert set(kept) == {"t1", "t7"} and kept["t1"].channel == "WEB" and kept["t1"].status == "DONE"


def test_cleaning_defaults_and_titles(spark):
    df = spark.createDataFrame([("1", "ann lee ", None, "on"), ("2", None, "e", "on")],
                               "customer_id string, customer_name string, email string, status string")
    out = Q.clean(df, Q.CLEANING_PLANS["staging_customers"], as_of()).rows.collect()
    assert [tuple(r) for r in out] == [("1", "Ann Lee", "no-email@unknown.com", "ON")]
    plain = Q.clean(df, Q.CleaningPlan(remove_duplicates=False), as_of())
    assert plain.rows.count() == 2 and {r.reason: r.rows for r in plain.stats.collect()} == {"original": 2, "duplicate": 0, "kept": 2}
    with pytest.raises(ValueError, match="missing"):
        Q.clean(df, Q.CleaningPlan(drop_nulls=("zz",)), as_of())


def test_dead_letters_and_repair(dirty):
    marked = Q.dead_letter(dirty)
    parts = Q.split_dead_letters(marked)
    assert {r.transaction_id: r.error_reason for r in parts["rejected"].collect()} == {
        "t2": "NULL_AMOUNT", "t4": "NULL_AMOUNT", "t5": "INVALID_AMOUNT", "t6": "INVALID_AMOUNT", "t7": "INVALID_AMOUNT"}
    assert parts["valid"].columns == dirty.columns and parts["valid"].count() == 3
    fixed = Q.repair_nulls(dirty, "customer_id", "amount", {"channel": "none"}).filter("transaction_id in ('t2', 't5', 't7')")
    assert rows(fixed.select("transaction_id", "name_cleaned", "amount_cleaned", "channel")) == [
        ("t2", "UNKNOWN", 0.0, "x"), ("t5", "c1", 0.0, "x"), ("t7", "c2", 0.0, "none")]


def test_validate_outliers_duplicates(spark):
    df = spark.createDataFrame([(i, "g", float(i)) for i in range(1, 12)] + [(99, "g", 1000.0), (100, None, None)], "id int, g string, v double")
    out = {r.id: r for r in Q.iqr_outliers(df, "v").collect()}
    assert out[99].is_outlier and out[99].capped < 30 and not out[5].is_outlier and out[100].is_outlier is None
    assert {r.id for r in Q.iqr_outliers_by_group(df, "g", "v").filter("is_outlier").collect()} == {99}
    codes = Q.validate(df, {"NO_GROUP": F.col("g").isNull(), "BIG": F.col("v") > 500}).filter("not is_valid")
    assert {r.id: r.validation_errors for r in codes.collect()} == {99: ["BIG"], 100: ["NO_GROUP"]}
    dup = Q.mark_duplicates(spark.createDataFrame([(None,), (None,), ("x",)], "k string"), ["k"])
    assert sorted((str(r.k), r.duplicate_count, r.is_duplicate) for r in dup.collect()) == [("None", 2, True), ("None", 2, True), ("x", 1, False)]
    with pytest.raises(ValueError):
        Q.validate(df, {})


def test_orphans_and_conversion(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a",), ("b",)], "key string")
    assert rows(Q.orphans(fact, dim, "k", "key").select("id")) == [(2,)]
    out = Q.try_convert(spark.createDataFrame([("1", "x"), ("y", "2024-01-01")], "n string, d string"), {"n": "int", "d": "date"})
    assert [r.failed_columns for r in out.orderBy("n").collect()] == [["d"], ["n"]]


def test_upsert_rejects_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(H.upsert(target, spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string"), "k")) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(PySparkException, match="duplicate source key"):
        H.upsert(target, spark.createDataFrame([(2, "B"), (2, "C")], "k int, v string"), "k").collect()


def test_history(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 5, "b"), (1, 9, "c"), (2, 7, None)], "k int, t int, v string")
    assert rows(H.as_of(log, "k", "t", F.lit(6))) == [(1, 5, "b")]
    assert {r.k: r.v for r in H.as_of(log, "k", "t", F.lit(100)).collect()} == {1: "c", 2: None}
    wider = H.append_columns(log, spark.createDataFrame([(3, True)], "k int, flag boolean"))
    assert wider.columns == ["k", "t", "v", "flag"] and wider.count() == 5
    assert H.evolve(log, {"k": "key"}, {"n": F.lit(1)}).columns == ["key", "t", "v", "n"]


def test_skew_and_layout(spark):
    df = spark.createDataFrame([("hot" if i % 10 else f"k{i}", i) for i in range(1000)], "k string, v int")
    r = L.key_skew(df, "k").first()
    assert (r.groups, r.max_size, r.min_size, r.level) == (101, 900, 1, "high")
    assert L.key_skew(df, "k", levels=((2, "low"), (200, "medium")), worst="extreme").first().level == "medium"
    assert sum(r.rows for r in L.partition_sizes(df.repartition(6)).collect()) == 1000
    b = L.balance(df.repartition(5)).first()
    assert (b.partitions, b.total_rows, b.health, b.recommended_partitions) == (5, 1000, "excellent", 1)
    sizes = L.bucket_sizes(df, ["k"], 4).collect()
    assert sum(x.rows for x in sizes) == 1000 and {x.verdict for x in sizes} == {"warning"}
    v = L.partition_value_sizes(df, ["k"]).first()
    assert (v.partitions, v.largest, v.small_partitions, v.too_fine) == (101, 900, 101, True)
    assert L.resize(df.repartition(8), 2, 8).rdd.getNumPartitions() == 2
    assert L.resize(df, 16, 8).rdd.getNumPartitions() == 16
    dated = spark.createDataFrame([(dt.datetime(2024, m, 1),) for m in range(1, 13)], "ts timestamp_ntz")
    assert L.layout_by_month(dated, "ts", 4).rdd.getNumPartitions() == 4
    e = L.estimate_bytes(df).first()
    assert (e.rows, e.bytes_per_row, e.estimated_bytes) == (1000, 24, 24000) and e.plan_bytes > 0


def test_aggregates_on_hot_keys(spark):
    df = spark.createDataFrame([(("hot" if i % 3 == 0 else f"k{i % 7}"), i, float(i % 11)) for i in range(500)], "k string, id int, v double")
    salted = A.salted_agg(df, "k", "v", ["id"], salts=5)
    plain = df.groupBy("k").agg(F.sum("v"), F.count("v"), F.min("v"), F.max("v"), F.avg("v"))
    assert rows(salted) == rows(plain)
    est = A.estimate_total(df, "k", "v", ["id"], 1.0)
    assert rows(est) == rows(df.groupBy("k").agg(F.sum("v")))
    q = A.quantiles(df, "v", [0.0, 1.0]).collect()
    assert {r.quantile: r.value for r in q} == {0.0: 0.0, 1.0: 10.0}
    with pytest.raises(ValueError):
        A.summarise(df, "k", {})
    with pytest.raises(ValueError):
        A.by_period(df, "id", "fortnight", {"n": F.count("*")})


def test_gaps_do_not_shift_year_over_year(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 5), 10.0), (dt.date(2024, 1, 5), 15.0), (dt.date(2024, 3, 5), 7.0)], "d date, v double")
    assert rows(A.yoy(df, "d", "v").select("period", "yoy_growth").na.fill(-1.0)) == [
        (dt.date(2023, 1, 1), -1.0), (dt.date(2024, 1, 1), 50.0), (dt.date(2024, 3, 1), -1.0)]


def test_rollup_tells_null_keys_from_subtotals(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", "x", 2.0)], "r string, c string, v double")
    out = {(r.r, r.c, r.level): r.t for r in A.rollup_summary(df, ["r", "c"], {"t": F.sum("v")}).collect()}
    assert out == {("a", None, 0): 1.0, ("a", "x", 0): 2.0, ("a", None, 1): 3.0, (None, None, 3): 3.0}


def test_relational_and_reshape(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], "xyz"[i % 3], float(i)) for i in range(12)], "id int, g string, h string, v double")
    assert rows(R.slice_by_range(df, "id", 3, 5).select("id")) == [(3,), (4,)]
    assert rows(R.top_keys(df, "h", 2)) == [("x", 4), ("y", 4)]
    assert R.top_k_per_group(df, "g", [F.desc("v")], 1).select("id").orderBy("id").collect()[0].id == 10
    assert R.sample(df, 0.5, 1).count() <= 12 and R.range_sorted(df, "v", 3).rdd.getNumPartitions() == 3
    d = R.describe(df, ["v"]).first()
    assert (d.column, d["count"], d.mean, d.min, d.max) == ("v", 12, 5.5, 0.0, 11.0)
    wide = P.pivot_sum(df, "g", "h", "v", ["x", "y", "q"])
    assert wide.columns == ["g", "x", "y", "q"]
    assert P.unpivot(wide, "g", ["x", "y", "q"], "h", "v").count() == 4
    assert rows(P.crosstab(df, "g", "h", ["x", "q"])) == [("a", 2, 0), ("b", 2, 0)]
    alerts = R.union_alerts(spark.createDataFrame([(1, 60000.0)], "id int, amount double"), spark.createDataFrame([(2, 60.0), (3, 1.0)], "id int, fraud_score double"))
    assert {r.id: r.alert_severity for r in alerts.collect()} == {1: "CRITICAL", 2: "HIGH", 3: "MEDIUM"}


def test_profile_tells_rows_apart_by_null_marks(spark):
    rows = [(None, "a", 1), ("a", None, 1), ("a", None, 1), (None, None, None), (None, None, None), (None, None, None), ("x", "y", 2)]
    got = {r.metric: r.value for r in Q.profile(spark.createDataFrame(rows, "p string, q string, n int")).collect()}
    assert got["duplicate_rows"] == 3 and got["total_records"] == 7 and got["nulls.p"] == 4 and got["nulls.q"] == 5


def test_profile_compares_rows_of_equal_hashes(spark, monkeypatch):
    # With a hash that is the same for all rows, only the full comparison tells them apart.
    monkeypatch.setattr(Q.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    got = {r.metric: r.value for r in Q.profile(spark.createDataFrame([(1,), (2,), (2,), (3,)], "n int")).collect()}
    assert got["duplicate_rows"] == 1
