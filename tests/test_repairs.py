"""Rows with NULLs, repeated keys, numbers as list values, stale partitions and many micro-batches."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import harness
from conftest import rows
from etlkit.operators import aggregates as A
from etlkit.operators import history as H
from etlkit.operators import layout as L
from etlkit.operators import quality as Q
from etlkit.operators import relational as R
from etlkit.operators import windows as W
from etlkit.plans import curated
from etlkit.plans.catalogue import ORACLES, Tables, streams
from etlkit.runtime import _SCRATCH, clear_scratch, shared_dir
from etlkit.sinks import files as S
from etlkit.streaming import events as E
from etlkit.streaming import inputs as I
from etlkit.streaming import sinks

STREAMS = sorted(n for n in ORACLES if n.startswith("stream_"))


@pytest.fixture(scope="module")
def holes(spark, data, tmp_path_factory):
    """Events with NULL users, amounts and times, and the same as a DuckDB table."""
    path = f"{tmp_path_factory.mktemp('holes')}/events.parquet"
    hole = lambda c, k: F.when(F.col("event_id") % k != 0, F.col(c)).alias(c)
    spark.read.parquet(f"{data}/events.parquet").select("event_id", hole("user_id", 5), hole("ts", 7), "event_type", hole("value", 3)).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return spark.read.parquet(path), con


def test_exact_sliding_stats_keep_null_users_and_amounts(holes):
    events, con = holes
    got = E.sliding_stats(events, "ts", "event_type", "value", "1 hour", None, unique="user_id", exact=True)
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    got = got.withColumns(bounds | {c: F.round(c, 4) for c in ("total_amount", "avg_amount")})
    sql = """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
             round(sum(value), 4) AS total_amount, count(*) AS transaction_count, count(DISTINCT user_id) AS unique_values,
             round(avg(value), 4) AS avg_amount FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""
    compared = got.select("window_start", "window_end", "event_type", "total_amount", F.col("transaction_count"), "unique_values", "avg_amount").toArrow()
    assert not harness.compare(compared, con.sql(sql).to_arrow_table())


def test_range_frames_keep_null_times(holes):
    events, con = holes
    got = W.moving_range(events, "event_type", "ts", 3600, {"n": F.count(F.lit(1)), "total": F.sum("value")})
    sql = """SELECT *, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total FROM events
             WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"""
    assert not harness.compare(got.withColumn("total", F.round("total", 4)).toArrow(), con.sql(sql).to_arrow_table())


def test_upsert_guard_survives_pruning(spark):
    target = spark.createDataFrame([(1, 2, "a"), (2, 2, "b")], "k int, j int, v string")
    source = spark.createDataFrame([(1, 2, "x"), (1, 2, "y")], "k int, j int, v string")
    for read in (lambda d: d.count(), lambda d: d.select("v").collect(), lambda d: d.select("j").collect(), lambda d: d.agg(F.max("k")).collect()):
        with pytest.raises(Exception, match="duplicate source key"):
            read(H.upsert(target, source, ["k", "j"]))
    assert rows(H.upsert(target, source.limit(1), ["k", "j"]).select("k")) == [(1,), (2,)]


def test_collected_numbers_are_in_numeric_order(spark):
    df = spark.createDataFrame([("g", i) for i in range(12, 0, -1)] + [("g", -5), ("g", None)], "g string, v int")
    pages = A.collect(df, "g", "v", page=4).orderBy("page").collect()
    assert [v for p in pages for v in p["values"]] == [-5, *range(1, 13)] and max(len(p["values"]) for p in pages) == 4
    dates = df.select("g", F.date_add(F.lit("2020-01-01").cast("date"), F.col("v")).alias("v"))
    pages = A.collect(dates, "g", "v", page=5).orderBy("page").collect()
    flat = [v for p in pages for v in p["values"]]
    assert flat == sorted(flat) and len(flat) == 13


def test_exact_percentiles_of_repeated_values(spark):
    df = spark.createDataFrame([("a", v) for v in [1] * 50 + [2] * 49 + [100]] + [("b", 7), ("c", None)], "g string, v int")
    got = {(r.g, r.p): r.value for r in A.exact_percentiles(df, "g", "v", [0.0, 0.5, 0.99, 1.0], [F.col("v")]).collect()}
    assert got["a", 0.0] == 1 and got["a", 0.5] == 1.5 and abs(got["a", 0.99] - 2.98) < 1e-9 and got["a", 1.0] == 100 and got["b", 0.5] == 7
    assert not any(g == "c" for g, _ in got)
    assert A.exact_percentiles(df, "g", "v", [0.5], [F.col("v")])._jdf.queryExecution().executedPlan().toString().count("Window [sum") >= 1


def test_exact_outliers(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(100)] + [(100, 1000.0), (101, None)], "id int, v double")
    assert rows(Q.iqr_outliers(df, "v", exact=True).filter("is_outlier").select("id")) == [(100,)]


def test_full_load_drops_stale_months(spark, tmp_path):
    fact = spark.createDataFrame([(1, 2023, 1), (2, 2024, 2)], "id int, year int, month int")
    curated.load_table("fact_sales", fact, str(tmp_path))
    curated.load_table("fact_sales", fact.filter("year = 2024"), str(tmp_path))
    assert rows(spark.read.parquet(f"{tmp_path}/fact_sales").select("id")) == [(2,)]
    curated.load_table("fact_sales", fact.filter("year = 2023"), str(tmp_path), increment=True)
    assert rows(spark.read.parquet(f"{tmp_path}/fact_sales").select("id")) == [(1,), (2,)]


def test_slices_of_large_ids(spark):
    df = spark.createDataFrame([(2**60 + 1,), (2**60 - 1,), (-1,), (0,), (None,)], "id long")
    got = {r.id: r.slice for r in R.with_slice(df, "id", 2**30).collect()}
    assert got == {2**60 + 1: 2**30, 2**60 - 1: 2**30 - 1, -1: -1, 0: 0, None: None}


def test_file_sizes_are_met(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    S.write_sized(docs, f"{tmp_path}/d", target_mb=2)
    sizes = [f.stat().st_size for f in (tmp_path / "d").glob("part-*")]
    assert all(1 <= s / 2**20 <= 4 for s in sizes) and len(sizes) > 3


def test_measured_sizes(spark):
    df = spark.createDataFrame([(i, "x" * 1000, [1, 2]) for i in range(50)], "id long, t string, a array<int>")
    m = L.measured_bytes(df, fraction=1.0).first()
    assert m.rows == 50 and 1008 < m.bytes_per_row < 1040


def test_scratch_goes_on_request(spark):
    from pathlib import Path

    path = shared_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) >= 1 and not Path(path).exists()


@pytest.fixture(scope="module")
def many_files(spark, data, tmp_path_factory):
    """The events in 7 files: in order of time, and shuffled."""
    base = tmp_path_factory.mktemp("files")
    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartitionByRange(7, "ts").write.parquet(f"{base}/ordered/events.parquet")
    events.repartition(7, F.xxhash64("event_id")).write.parquet(f"{base}/shuffled/events.parquet")
    return base


@pytest.mark.parametrize("name", STREAMS)
@pytest.mark.parametrize("layout", ["ordered", "shuffled"])
def test_streams_are_whole_over_many_batches(spark, data, many_files, name, layout):
    t = Tables(spark, f"{many_files}/{layout}")
    t.stream_files = 2
    got = getattr(streams, name)(t).toArrow()
    assert not harness.compare(got, harness.connect(data).sql(ORACLES[name]).to_arrow_table())


def test_late_rows_are_an_error(spark, many_files):
    raw = I.file_source(spark, f"{many_files}/shuffled/events.parquet", spark.read.parquet(f"{many_files}/shuffled/events.parquet").schema, max_files=2)
    sdf = E.tumbling_stats(I.with_event_time(raw, "ts", "1 minute"), "ts", "event_type", "value")
    with pytest.raises(RuntimeError, match="later than the watermark"):
        sinks.run_to_table(sdf, "late", "update", ["window_start", "window_end", "event_type"])


@pytest.mark.parametrize("files", [None, 1])
def test_one_batch_of_input_takes_its_flush_along(spark, many_files, files):
    """Two batches, one for the rows and one that closes the state; with a limit of files the flush still comes last."""
    t = Tables(spark, f"{many_files}/ordered")
    t.stream_files = files and 4
    raw, flush = I.flushed_source(streams._raw(t), "ts", shared_dir(spark, "flush"))
    sdf = E.session_stats(I.with_event_time(raw, "ts", streams._delay(t)), "ts", "user_id", "value", "30 minutes")
    got = streams._written(t, sdf, "flushed", flush=flush)
    assert got.agg(F.sum("transaction_count")).first()[0] == t.events.count()
    base = next(f for f in reversed(_SCRATCH["folders"]) if "stream-flushed-" in f).removeprefix("file:")
    batches = [p for p in (Path(base) / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(batches) == 2 if files is None else len(batches) > 2
