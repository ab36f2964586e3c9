"""Streams over small files: late rows, repeats, outer joins, sinks, progress."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from etlkit.operators.joins import interval_join
from etlkit.streaming import events as E
from etlkit.streaming import inputs as I
from etlkit.streaming import sinks as S
from etlkit.streaming.progress import progress_frame, progress_row

SCHEMA = "id int, customer_id string, amount double, category string, ts timestamp_ntz"
NOW = {"availableNow": True}


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=minute, seconds=second)


def files(spark, path, *batches):
    """One file per batch, in order of modification time."""
    import os
    import time

    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/b{i}")
        os.makedirs(f"{path}/all", exist_ok=True)
        part = next(f for f in os.listdir(f"{path}/b{i}") if f.startswith("part-"))
        target = f"{path}/all/{i}.parquet"
        os.link(f"{path}/b{i}/{part}", target)
        os.utime(target, (time.time() + i, time.time() + i))
    return f"{path}/all"


def stream(spark, path, delay="10 minutes"):
    schema = spark.createDataFrame([], SCHEMA).schema
    return I.with_event_time(I.file_source(spark, path, schema, max_files=1), "ts", delay)


@pytest.fixture()
def late_input(spark, tmp_path):
    """Row 4 comes two batches after the watermark passed its window."""
    return files(
        spark, str(tmp_path),
        [(1, "a", 10.0, "x", at(0)), (2, "b", 20.0, "x", at(1)), (3, "a", 5.0, "y", at(30))],
        [(5, "c", 1.0, "x", at(31))],
        [(4, "a", 99.0, "x", at(2))],
        [(6, "c", 1.0, "x", at(90))],
    )


@pytest.fixture()
def steady_input(spark, tmp_path):
    return files(
        spark, str(tmp_path),
        [(1, "a", 10.0, "x", at(0)), (2, "b", 20.0, "x", at(1)), (3, "a", 5.0, "y", at(30))],
        [(4, "a", 99.0, "x", at(2)), (5, "c", 1.0, "x", at(31))],
        [(6, "c", 1.0, "x", at(90))],
    )


def totals(df):
    return sorted((r.window_start.minute, r.category, r.total_amount) for r in df.collect())


def test_late_rows_do_not_reach_closed_windows(spark, late_input):
    out = S.run_to_table(E.tumbling_stats(stream(spark, late_input), "ts", "category", "amount"), "late", allow_late=True)
    assert totals(out) == [(0, "x", 30.0), (30, "x", 1.0), (30, "y", 5.0)]


def test_update_mode_keeps_the_latest_version(spark, steady_input):
    sdf = E.tumbling_stats(stream(spark, steady_input, "3 hours"), "ts", "category", "amount")
    out = S.run_to_table(sdf, "upd", "update", ["window_start", "window_end", "category"])
    assert totals(out) == [(0, "x", 129.0), (30, "x", 1.0), (30, "x", 1.0), (30, "y", 5.0)]
    assert totals(S.run_to_table(sdf, "cmp", "complete")) == totals(out)
    with pytest.raises(ValueError):
        S.run_to_table(sdf, "bad", "update")


def test_exact_distinct_on_a_stream(spark, steady_input):
    """Two aggregations in one stream count distinct customers exactly, as the batch does."""
    sdf = E.sliding_stats(stream(spark, steady_input, "20 minutes"), "ts", "category", "amount", "5 minutes", None, "customer_id", True)
    got = S.run_to_table(sdf, "exact")
    batch = E.sliding_stats(
        spark.read.parquet(steady_input).filter("id <> 6"), "ts", "category", "amount", "5 minutes", None, "customer_id", True)
    pick = ["category", "total_amount", "transaction_count", "unique_values"]
    assert set(rows(got.select(pick))) <= set(rows(batch.select(pick))) and got.count() > 0
    assert ("x", 129.0, 3, 2) in rows(got.select(pick))
    approx = E.sliding_stats(spark.read.parquet(steady_input), "ts", "category", "amount", unique="customer_id")
    assert approx.count() > 0


def test_repeats_are_dropped(spark, tmp_path):
    path = files(spark, str(tmp_path), [(1, "a", 1.0, "x", at(0)), (1, "a", 1.0, "x", at(0))], [(1, "a", 1.0, "x", at(1)), (2, "a", 1.0, "x", at(2))])
    assert rows(S.run_to_table(E.dedup_stream(stream(spark, path), "id").select("id"), "dedup")) == [(1,), (2,)]
    assert E.dedup_stream(spark.read.parquet(path), "id").count() == 2


def test_outer_interval_join(spark, tmp_path):
    left = files(spark, f"{tmp_path}/l", [(1, "a", 1.0, "x", at(0)), (2, "b", 1.0, "x", at(1))], [(3, "z", 1.0, "x", at(300))], [(4, "z", 1.0, "x", at(301))])
    right = files(spark, f"{tmp_path}/r", [(11, "a", 2.0, "x", at(1, 30))], [(12, "q", 2.0, "x", at(300))], [(13, "q", 2.0, "x", at(301))])
    a = stream(spark, left, "5 minutes").select("customer_id", "id", "ts")
    b = stream(spark, right, "5 minutes").select("customer_id", F.col("id").alias("other"), F.col("ts").alias("other_ts"))
    joined = interval_join(a, b, "customer_id", "ts", "other_ts", 120, 120, "left").select("id", F.coalesce("other", F.lit(-1)))
    got = rows(S.run_to_table(joined, "outer"))
    assert (1, 11) in got and (2, -1) in got and len([g for g in got if g[0] in (1, 2)]) == 2


def test_sessions_batch_equals_stream(spark, tmp_path):
    path = files(spark, str(tmp_path), [(1, "a", 1.0, "x", at(58)), (2, "a", 2.0, "x", at(63)), (3, "a", 4.0, "x", at(69)), (4, "b", 8.0, "x", at(0))])
    stream_out = S.run_to_table(E.session_stats(stream(spark, path), "ts", "customer_id", "amount"), "sess", "complete")
    batch = E.session_stats(spark.read.parquet(path), "ts", "customer_id", "amount")
    assert rows(stream_out) == rows(batch)
    assert [(r.customer_id, r.total_amount) for r in batch.orderBy("window_start").collect()] == [("b", 8.0), ("a", 3.0), ("a", 4.0)]


def test_split_late_and_alerts(spark, tmp_path):
    path = files(spark, str(tmp_path), [(1, "a", 20000.0, "x", at(0)), (2, "a", 5.0, "x", at(4)), (3, "b", 7.0, "x", at(20))])
    df = spark.read.parquet(path)
    out = E.split_late(df, "ts", "category", "amount", length="1 hour", as_of=F.lit("2024-01-01 10:19:00"))
    assert rows(out.select("on_time_amount", "late_amount")) == [(12.0, 20000.0)]
    alert = E.high_value_alerts(df).collect()
    assert [(a.id, a.alert_type, a.risk_score) for a in alert] == [(1, "HIGH_VALUE", 20.0)]
    fraud = E.fraud_scores(df, "ts", "customer_id", "amount", min_total=10_000, min_score=10)
    assert [round(r.fraud_score, 3) for r in fraud.collect()] == [14.3]
    assert rows(E.safe_amounts(spark.createDataFrame([(None,), (-1.0,), (2.0,)], "amount double"), "amount", F.lit(1)).select("amount_validated")) == [(0.0,), (0.0,), (2.0,)]


def test_sinks_triggers_and_progress(spark, steady_input, tmp_path):
    name = "seen_" + uuid.uuid4().hex[:8]
    q = S.start_debug_sink(stream(spark, steady_input).coalesce(4), "memory", name, trigger=NOW)
    q.awaitTermination()
    assert spark.table(name).count() == 6
    progress = progress_frame(q).orderBy("batch_id").collect()
    assert sum(p.input_rows for p in progress) == 6 and all(not p.large_state for p in progress)
    S.start_debug_sink(stream(spark, steady_input).limit(1), "console", trigger={"once": True}).awaitTermination()
    written = []
    q = S.start_batch_sink(stream(spark, steady_input), lambda df, i: written.append((i, df.count())), f"{tmp_path}/ck", trigger=NOW)
    q.awaitTermination()
    assert [w[0] for w in written] == [0, 1, 2] and sum(w[1] for w in written) == 6
    q = S.start_file_sink(stream(spark, steady_input), f"{tmp_path}/out", f"{tmp_path}/ck2", ["category"], trigger=NOW)
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").filter("category = 'y'").count() == 1
    for bad in ({"hourly": 1}, {"once": True, "availableNow": True}):
        with pytest.raises(ValueError):
            S.with_trigger(stream(spark, steady_input).writeStream, bad)
    with pytest.raises(ValueError):
        S.start_debug_sink(stream(spark, steady_input), "paper")


def test_progress_flags():
    row = progress_row({"batchId": 3, "inputRowsPerSecond": 13.0, "processedRowsPerSecond": 10.0, "numInputRows": 5,
                        "stateOperators": [{"numRowsTotal": 900_000}, {"numRowsTotal": 200_000}], "sources": [{"description": "f"}]})
    assert row[0] == 3 and row[6] == 1_100_000 and row[-2:] == (True, True)
    assert progress_row({"batchId": 0})[-2:] == (False, False)


def test_kafka_options_and_values(spark):
    o = I.kafka_options("h:1", "t", maxOffsetsPerTrigger=5)
    assert (o["subscribe"], o["startingOffsets"], o["maxOffsetsPerTrigger"], o["failOnDataLoss"]) == ("t", "earliest", "5", "true")
    lossy = I.kafka_options("h:1", "t", I.KAFKA_LATEST_LOSSY)
    assert (lossy["startingOffsets"], lossy["failOnDataLoss"]) == ("latest", "false")
    assert S.kafka_sink_options("h:1", "t", "/c") == {"kafka.bootstrap.servers": "h:1", "topic": "t", "checkpointLocation": "/c"}
    assert rows(S.to_kafka_value(spark.createDataFrame([(1, "x")], "a int, b string"))) == [('{"a":1,"b":"x"}',)]
    with pytest.raises(ValueError):
        I.file_source(spark, "x", spark.range(1).schema, max_files=1, max_bytes="1g")
