"""Streams with a short watermark: nothing is lost, state stays small, repeats change nothing."""

import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import harness
from conftest import rows
from etlkit.plans.catalogue import ORACLES, QUERIES
from etlkit.streaming import events as E
from etlkit.streaming import late as L
from etlkit.streaming.inputs import file_source
from etlkit.streaming.sinks import commit_batch, committed_batches, start_committed_sink

SCHEMA = "k string, ts timestamp, value double"


def _events(spark, n=2_000):
    minute = F.col("id") % 1_000
    return spark.range(n).select((F.col("id") % 3).cast("string").alias("k"), F.timestamp_seconds(1_700_000_000 + minute * 60 + F.col("id") % 7).alias("ts"), (F.col("id") % 11).cast("double").alias("value"))


def _arriving(spark, slots=20):
    rows = _events(spark)
    minute = (F.unix_seconds("ts") - 1_700_000_000) / 60
    # Every thirtieth row comes hours late.
    slot = F.floor((minute + F.when(F.xxhash64("ts", "k") % 30 == 0, 400).otherwise(F.abs(F.xxhash64("ts") % 5))) / 1_420 * slots)
    path, steps = L.arrivals(spark, rows.withColumn("slot", slot.cast("int")), "slot", "late-test")
    return rows, file_source(spark, path, rows.schema), steps


def _parts(frame):
    return E.window_parts(frame, "ts", "k", "value", "5 minutes")


def test_state_is_bounded_by_the_delay_and_no_row_is_lost(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        batch, source, steps = _arriving(spark)
        run = L.run_with_late_rows(source, "ts", "10 minutes", _parts, "late-windows", "update", ["window_start", "window_end", "k"], steps)
        got = E.add_windows(run.emitted.unionByName(_parts(run.late)), "k")
        want = E.tumbling_stats(batch, "ts", "k", "value")
        assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(got.columns)))
        late = run.late.count()
        assert 0 < late < batch.count() / 2
        state = [r.state_rows for r in run.progress.collect()]
        windows = want.count()
        # A slot spans 71 minutes and the delay ten: three keys have some 50 open windows at most, of 600.
        assert len(state) > 10 and max(state) < windows / 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_late_row_bridges_closed_sessions(spark):
    at = lambda m: F.timestamp_seconds(F.lit(1_700_000_000 + 60 * m))
    one = lambda m, v: spark.range(1).select(F.lit("a").alias("k"), at(m).alias("ts"), F.lit(float(v)).alias("value"))
    whole = one(0, 1).unionByName(one(8, 2)).unionByName(one(500, 3)).unionByName(one(4, 4)).unionByName(one(495, 5))
    slots = F.when(F.col("value") <= 2, 0).when(F.col("value") == 3, 1).otherwise(2)
    path, steps = L.arrivals(spark, whole.withColumn("slot", slots), "slot", "bridge")
    sessions = lambda f: E.session_stats(f, "ts", "k", "value", "5 minutes")
    run = L.run_with_late_rows(file_source(spark, path, whole.schema), "ts", "10 minutes", sessions, "bridge", "append", steps=steps)
    assert [r.value for r in run.late.collect()] == [4.0]
    got = E.join_sessions(run.emitted.unionByName(sessions(run.late)), "k", "5 minutes")
    assert sorted((r.transaction_count, r.total_amount) for r in got.collect()) == [(2, 8.0), (3, 7.0)]
    assert rows(got) == rows(sessions(whole))


def test_nested_sessions_are_joined(spark):
    parts = spark.sql("""SELECT 'a' AS k, timestamp'2024-01-01 00:00:00' AS window_start, timestamp'2024-01-01 01:05:00' AS window_end, 1D AS total_amount, 5L AS transaction_count
        UNION ALL SELECT 'a', timestamp'2024-01-01 00:10:00', timestamp'2024-01-01 00:15:00', 1D, 1L
        UNION ALL SELECT 'a', timestamp'2024-01-01 01:04:00', timestamp'2024-01-01 01:09:00', 1D, 1L
        UNION ALL SELECT 'a', timestamp'2024-01-01 02:00:00', timestamp'2024-01-01 02:05:00', 1D, 1L""")
    got = E.join_sessions(parts, "k", "5 minutes").collect()
    assert sorted((r.transaction_count, str(r.window_end)[11:16]) for r in got) == [(1, "02:05"), (7, "01:09")]


def test_a_repeated_batch_is_left_out(spark, tmp_path):
    frame = spark.range(5)
    assert commit_batch(frame, 3, f"{tmp_path}/t") is True
    assert commit_batch(spark.range(9), 3, f"{tmp_path}/t") is False
    assert committed_batches(spark, f"{tmp_path}/t") == [3]
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_a_batch_repeated_after_a_failure_changes_nothing(spark, tmp_path):
    source, out, ckpt = (f"{tmp_path}/{n}" for n in ("in", "out", "ckpt"))
    now = {"availableNow": True}
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).select("id", (F.col("id") % 2).alias("p")).coalesce(1).write.mode("append").parquet(source)
        start_committed_sink(file_source(spark, source, "id long, p long"), out, ckpt, "p", trigger=now).awaitTermination()
    before = rows(spark.read.parquet(out).select("id"))
    # As if the driver had died between the sink's work and Spark's note of it.
    (tmp_path / "ckpt" / "commits" / "2").unlink()
    crc = tmp_path / "ckpt" / "commits" / ".2.crc"
    crc.unlink(missing_ok=True)
    start_committed_sink(file_source(spark, source, "id long, p long"), out, ckpt, "p", trigger=now).awaitTermination()
    assert rows(spark.read.parquet(out).select("id")) == before == [(k,) for k in range(30)]
    assert committed_batches(spark, out) == [0, 1, 2]
    shutil.rmtree(tmp_path / "ckpt", ignore_errors=True)


def test_run_needs_keys_for_update(spark):
    with pytest.raises(ValueError):
        L.run_with_late_rows(spark.range(1), "id", "1 minute", lambda f: f, "x", "update")


def test_sessions_split_over_stretches_equal_the_batch(spark, tmp_path):
    from etlkit.streaming.sessions import run_split_sessions

    # One user has events every few minutes for ten hours, some exactly a gap apart.
    minutes = [0, 5, 10, 14, 30, 35, 36, 58, 61, 66, 119, 120, 125, 131, 200, 355, 360, 365, 370, 600]
    data = [("hot", m, 1.0) for m in minutes for _ in range(40)] + [("cold", m, 2.0) for m in (3, 59, 62, 64)] + [(None, 7, 1.0)]
    frame = spark.createDataFrame(data, "k string, m int, value double").select("k", F.timestamp_seconds(1_700_006_400 + F.col("m") * 60).alias("ts"), "value")
    frame.repartition(5).write.parquet(f"{tmp_path}/in")
    source = file_source(spark, f"{tmp_path}/in", frame.schema, max_files=2)
    got = run_split_sessions(source, "ts", "k", "value", 300, 3600, "11 hours", "test")
    want = E.session_stats(frame, "ts", "k", "value", "5 minutes")
    key = lambda f: sorted(str(tuple(r)) for r in f.select(*sorted(f.columns)).collect())
    assert key(got) == key(want) and got.filter("k = 'hot'").count() == 8


def test_arrivals_are_taken_to_the_nearest_second(spark, tmp_path):
    # Slots of 2,000 seconds. Event 40 comes 21,600 seconds after its time: at 21,999.6 it belongs to the slot that begins
    # at 22,000, after event 100; cut down to 21,999 it came with event 100 and was on time.
    seconds = {20: 0.0, 40: 399.6, 100: 20_500.0, 60: 39_999.0}
    events = spark.createDataFrame(list(seconds.items()), "event_id long, s double").select(
        "event_id", F.timestamp_micros((1_704_067_200_000_000 + F.col("s") * 1_000_000).cast("long")).cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("long").alias("user_id"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    got = QUERIES["late_rows_aside"](spark, str(tmp_path)).toArrow()
    assert harness.compare(got, con.sql(ORACLES["late_rows_aside"]).to_arrow_table()) == []
    assert got["event_id"].to_pylist() == [40]
