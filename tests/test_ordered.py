"""Cell and block windows against plain Spark windows, with hot groups, ties and NULL keys."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from etlkit.operators import aggregates as A
from etlkit.operators import windows as W

KEY = st.sampled_from(["hot", "hot", "hot", "cold", None])
ROW = st.tuples(KEY, st.integers(0, 12), st.one_of(st.none(), st.integers(-50, 50)))
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, sample):
    data = [(k, t, i, None if v is None else float(v)) for i, (k, t, v) in enumerate(sample)]
    return spark.createDataFrame(data, "k string, t int, id int, v double")


def ordering(levels=None):
    return W.Ordering(["k"], ["t", "id"], levels or [F.expr("t div 4"), F.col("t"), F.expr("id div 3")])


@FEW
@given(st.lists(ROW, min_size=1, max_size=60))
def test_moving_and_lag_match_plain_windows(spark, sample):
    df = frame(spark, sample)
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.withColumns({
        "s": F.sum("v").over(w.rowsBetween(-3, 0)), "m": F.max("v").over(w.rowsBetween(-1, 0)),
    })
    ours = W.moving(df, ordering(), {"s": ("sum", "v", 4), "m": ("max", "v", 2)}, block=4)
    assert rows(ours.select("id", "s", "m").na.fill(999.0)) == rows(plain.select("id", "s", "m").na.fill(999.0))
    plain = df.select("id", F.lag("v").over(w), F.lead("v").over(w), F.lag("v", 2).over(w)).na.fill(999.0)
    ours = W.deltas(df, ordering(), "v", block=3).select("id", "prev_value", "next_value", "prev_2_value").na.fill(999.0)
    assert rows(ours) == rows(plain)


@FEW
@given(st.lists(ROW, min_size=1, max_size=60))
def test_rankings_match_plain_windows(spark, sample):
    df = frame(spark, sample)
    w, full = Window.partitionBy("k").orderBy("t"), Window.partitionBy("k").orderBy("t", "id")
    plain = df.select(
        "id", F.row_number().over(full), F.rank().over(w), F.dense_rank().over(w), F.percent_rank().over(w),
        F.cume_dist().over(w), F.ntile(4).over(full),
    )
    ours = W.rankings(df, "k", "t", ["id"], coarse=[F.expr("t div 5")], fine=[F.expr("id div 2")])
    names = ["id", "row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile"]
    assert rows(ours.select(names)) == rows(plain)


@FEW
@given(st.lists(ROW, min_size=1, max_size=60))
def test_running_matches_plain_windows(spark, sample):
    df = frame(spark, sample)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("id", F.sum("v").over(w), F.count("v").over(w), F.max("v").over(w)).na.fill(999.0)
    ours = W.running(df, ordering(), "v").select("id", "running_total", "running_count", "running_max").na.fill(999.0)
    assert rows(ours) == rows(plain)


@FEW
@given(st.lists(ROW, min_size=1, max_size=60))
def test_exact_percentiles_and_pages(spark, sample):
    df = frame(spark, sample)
    ours = A.exact_percentiles(df, "k", "v", [0.0, 0.3, 1.0], [F.floor(F.col("v") / 10)])
    plain = df.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.0), F.lit(0.3), F.lit(1.0))).alias("p")).select(
        "k", F.posexplode_outer("p")
    ).filter(F.col("col").isNotNull())
    key = lambda r: (str(r[0]), r[1])
    a = sorted(((r.k, r.p, round(r.value, 9)) for r in ours.collect()), key=key)
    b = sorted(((r.k, [0.0, 0.3, 1.0][r.pos], round(r.col, 9)) for r in plain.collect()), key=key)
    assert a == b
    pages = A.collect(df, "k", "v", [F.floor(F.col("v") / 20)], page=3).collect()
    for k in {s[0] for s in sample}:
        mine = [v for p in sorted((p for p in pages if p.k == k), key=lambda p: p.page) for v in p["values"]]
        assert mine == sorted(float(v) for kk, _, v in sample if kk == k and v is not None)
    assert all(len(p["values"]) <= 3 for p in pages)


def test_descending_rank(spark):
    df = frame(spark, [("hot", t, 1) for t in (1, 1, 2, 3)])
    out = W.rankings(df, "k", "t", ["id"], coarse=[F.expr("t div 2")], descending=True).select("t", "rank", "dense_rank").distinct()
    assert rows(out) == [(1, 3, 3), (2, 2, 2), (3, 1, 1)]


def test_block_must_hold_the_frame(spark):
    with pytest.raises(ValueError, match="block"):
        W.moving(frame(spark, [("hot", 1, 1)]), ordering(), {"s": ("sum", "v", 9)}, block=4)
    with pytest.raises(ValueError, match="missing columns"):
        W.deltas(frame(spark, [("hot", 1, 1)]), ordering(), "nope")


def test_time_range_frame(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:10:00", 2.0), (1, "2024-01-01 00:10:01", 4.0),
         (1, "2024-01-01 00:20:00", 8.0), (2, "2024-01-01 00:20:00", 16.0)], "k int, ts string, v double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = W.moving_range(df, "k", "ts", 600, {"s": F.sum("v")}).select("k", "s")
    assert rows(out) == [(1, 1.0), (1, 3.0), (1, 6.0), (1, 14.0), (2, 16.0)]


def test_group_stats_with_null_keys(spark):
    df = frame(spark, [(None, 1, 1), (None, 2, 3), ("hot", 1, 5)])
    out = W.with_group_stats(df, "k", {"total": F.sum("v")}).select("id", "total")
    assert rows(out) == [(0, 4.0), (1, 4.0), (2, 5.0)]
    z = {r.id: r.z_score for r in W.zscore(frame(spark, [("a", 1, 1), ("a", 1, 1), ("b", 1, 7)]), "k", "v").collect()}
    assert z == {0: None, 1: None, 2: None}


def test_first_last_rejects_unknown_frame(spark):
    with pytest.raises(ValueError, match="frame"):
        W.first_last(frame(spark, [("a", 1, 1)]), "k", ["t", "id"], "v", frame="rows")


def _skewed(spark):
    rows = [("hot" if i % 5 else f"k{i % 3}", None if i % 97 == 0 else 1_700_000_000 + (i * 7919) % 40_000, None if i % 13 == 0 else float(i % 101)) for i in range(4_000)]
    frame = spark.createDataFrame(rows, "k string, at long, v double")
    return frame.withColumn("ts", F.timestamp_seconds("at")).withColumn("id", F.monotonically_increasing_id())


@pytest.mark.parametrize("limit", [100_000, 200, 1])
def test_split_range_frames_equal_the_window(spark, limit):
    frames = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
    df = _skewed(spark).cache()
    got = W.moving_range_split(df, "k", "ts", 9_000, frames, rows=limit)
    want = W.moving_range(df, "k", "ts", 9_000, {"s": F.sum("v"), "n": F.count("v"), "lo": F.min("v"), "hi": F.max("v"), "m": F.avg("v")})
    assert got.columns == [*df.columns, *frames]
    a = {r.id: r for r in got.collect()}
    b = {r.id: r for r in want.collect()}
    assert set(a) == set(b) and len(a) == 4_000
    for i, r in a.items():
        assert (r.n, r.lo, r.hi) == (b[i].n, b[i].lo, b[i].hi)
        assert r.s == pytest.approx(b[i].s) and r.m == pytest.approx(b[i].m)


def test_cells_hold_no_more_rows_than_asked(spark):
    df = _skewed(spark).filter("ts IS NOT NULL")
    length = W.cell_seconds(df, "k", "ts", 9_000, 200)
    most = df.groupBy("k", F.floor(F.unix_micros("ts") / (length * 1e6))).count().agg(F.max("count")).first()[0]
    longer = df.groupBy("k", F.floor(F.unix_micros("ts") / (2 * length * 1e6))).count().agg(F.max("count")).first()[0]
    assert most <= 200 < longer and length <= 9_000
