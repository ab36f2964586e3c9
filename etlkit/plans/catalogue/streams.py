"""Event-time operators, as batches and as streams over the same table with the same expected rows.

A stream reads the whole table, writes what it emits below the shared folder and is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.joins import interval_join
from etlkit.plans.catalogue.registry import query
from etlkit.plans.catalogue.relational import _INTERVAL_SQL, _two_event_sides
from etlkit.runtime import shared_dir
from etlkit.streaming import events as E
from etlkit.streaming import late as L
from etlkit.streaming.inputs import file_source, flushed_source, with_event_time
from etlkit.streaming.sessions import run_split_sessions
from etlkit.streaming.sinks import run_to_table, start_file_sink

_SLIDES_SQL = """
    SELECT s AS window_start, s + INTERVAL 5 MINUTE AS window_end, event_type, round(sum(value), 4) AS total_amount,
           count(*) AS transaction_count, round(avg(value), 4) AS avg_amount {unique}
    FROM (SELECT *, unnest([date_trunc('minute', ts) - to_minutes(i) FOR i IN range(5)]) AS s FROM events)
    GROUP BY 1, 2, 3
"""
_TUMBLE_SQL = """
    SELECT s AS window_start, s + INTERVAL 5 MINUTE AS window_end, event_type, round(sum(value), 4) AS total_amount,
           count(*) AS transaction_count, round(avg(value), 4) AS avg_amount
    FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS s FROM events) GROUP BY 1, 2, 3
"""
_SESSIONS_SQL = """
    SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, user_id, round(sum(value), 4) AS total_amount,
           count(*) AS transaction_count
    FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END
               AS starts FROM events))
    GROUP BY user_id, session
"""
_ALERTS_SQL = """
    SELECT event_id, user_id, value, 'HIGH_VALUE' AS alert_type, value / 1000 AS risk_score FROM events WHERE value > 200
"""
_FRAUD_SQL = """
    SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, user_id, round(total, 4) AS total_amount,
           n AS transaction_count, round(n * 0.3 + total / 1000 * 0.7, 6) AS fraud_score
    FROM (SELECT date_trunc('hour', ts) AS s, user_id, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2)
    WHERE (n > 2 OR total > 300) AND n * 0.3 + total / 1000 * 0.7 > 0.4
"""
_LATE_SQL = """
    SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, event_type,
           round(sum(value) FILTER (ts >= TIMESTAMP '2024-01-15 12:30:00'), 4) AS on_time_amount,
           round(sum(value) FILTER (ts < TIMESTAMP '2024-01-15 12:30:00'), 4) AS late_amount
    FROM (SELECT *, date_trunc('hour', ts) AS s FROM events) GROUP BY 1, 2, 3
"""
_LATE_NOW = "2024-01-15 12:45:00"


def _delay(t):
    """A watermark delay that no event of the table can exceed, in whatever order its files come."""
    first, last = t.events.agg(F.unix_seconds(F.min("ts").cast("timestamp")), F.unix_seconds(F.max("ts").cast("timestamp"))).first()
    return f"{(last or 0) - (first or 0) + 1} seconds"


def _raw(t):
    """The events table as a stream, whether stored as one file or a folder."""
    return file_source(t.spark, t.file("events") + "*", t.events.schema, max_files=t.stream_files)


def _stream(t):
    return with_event_time(_raw(t), "ts", _delay(t))


def _written(t, sdf, label, mode="append", keys=(), flush=None):
    return run_to_table(sdf, label, mode, keys, flush, one_batch=t.stream_files is None)


def _shape(df, digits):
    """Window bounds as plain timestamps, sums rounded."""
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return df.withColumns(bounds | {c: F.round(c, d) for c, d in digits.items()})


_TOTALS = {"total_amount": 4, "avg_amount": 4}
_WINDOW = ["window_start", "window_end"]


@query(_SLIDES_SQL.format(unique=", count(DISTINCT user_id) AS unique_values"))
def sliding_window_stats(t):
    return _shape(E.sliding_stats(t.events, "ts", "event_type", "value", unique="user_id", exact=True), _TOTALS)


@query(_SLIDES_SQL.format(unique=""))
def stream_sliding_window_stats(t):
    sdf = E.sliding_stats(_stream(t), "ts", "event_type", "value")
    return _shape(_written(t, sdf, "sliding", "update", [*_WINDOW, "event_type"]), _TOTALS)


@query(_TUMBLE_SQL)
def tumbling_window_stats(t):
    return _shape(E.tumbling_stats(t.events, "ts", "event_type", "value"), _TOTALS)


@query(_TUMBLE_SQL)
def stream_tumbling_window_stats(t):
    sdf = E.tumbling_stats(_stream(t), "ts", "event_type", "value")
    return _shape(_written(t, sdf, "tumbling", "update", [*_WINDOW, "event_type"]), _TOTALS)


@query(_SESSIONS_SQL)
def session_window_stats(t):
    return _shape(E.session_stats(t.events, "ts", "user_id", "value", "30 minutes"), {"total_amount": 4})


@query(_SESSIONS_SQL)
def stream_session_window_stats(t):
    """A closed session is written once and leaves the state; the last ones close by the flush."""
    raw, flush = flushed_source(_raw(t), "ts", shared_dir(t.spark, "flush"))
    sdf = E.session_stats(with_event_time(raw, "ts", _delay(t)), "ts", "user_id", "value", "30 minutes")
    return _shape(_written(t, sdf, "sessions", flush=flush), {"total_amount": 4})


@query(_ALERTS_SQL)
def value_alerts(t):
    out = E.high_value_alerts(t.events, "value", 200, as_of=F.col("ts"))
    return out.select("event_id", "user_id", "value", "alert_type", "risk_score")


@query(_ALERTS_SQL)
def stream_value_alerts(t):
    out = E.high_value_alerts(_stream(t), "value", 200)
    return _written(t, out.select("event_id", "user_id", "value", "alert_type", "risk_score"), "alerts")


_FRAUD = {"total_amount": 4, "fraud_score": 6}


@query(_FRAUD_SQL)
def fraud_windows(t):
    return _shape(E.fraud_scores(t.events, "ts", "user_id", "value", "1 hour", 2, 300, 0.4), _FRAUD)


@query(_FRAUD_SQL)
def stream_fraud_windows(t):
    sdf = E.fraud_scores(_stream(t), "ts", "user_id", "value", "1 hour", 2, 300, 0.4)
    return _shape(_written(t, sdf, "fraud", "update", [*_WINDOW, "user_id"]), _FRAUD)


@query("""
    SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, user_id, n AS transaction_count, kinds AS unique_values,
           round(n * 0.3 + total / 1000 * 0.4 + kinds * 0.3, 6) AS fraud_score
    FROM (SELECT date_trunc('hour', ts) AS s, user_id, count(*) AS n, sum(value) AS total, count(DISTINCT event_type) AS kinds
          FROM events GROUP BY 1, 2) WHERE n * 0.3 + total / 1000 * 0.4 + kinds * 0.3 > 1
""")
def fraud_windows_with_diversity(t):
    out = E.diverse_fraud_scores(t.events, "ts", "user_id", "value", "event_type", "1 hour", 1)
    return _shape(out, {"fraud_score": 6}).drop("total_amount", "avg_amount")


@query(_LATE_SQL)
def late_and_on_time(t):
    out = E.split_late(t.events, "ts", "event_type", "value", length="1 hour", as_of=F.lit(_LATE_NOW))
    return _shape(out, {"on_time_amount": 4, "late_amount": 4})


@query(_LATE_SQL)
def stream_late_and_on_time(t):
    sdf = E.split_late(_stream(t), "ts", "event_type", "value", length="1 hour", as_of=F.lit(_LATE_NOW))
    out = _written(t, sdf, "late", "update", [*_WINDOW, "event_type"])
    return _shape(out, {"on_time_amount": 4, "late_amount": 4})


@query("SELECT event_id, user_id, value FROM events")
def stream_deduplicated(t):
    """Every third event arrives twice in the stream and leaves once."""
    twice = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sdf = _stream(t).withColumn("copy", F.explode(twice)).drop("copy")
    return _written(t, E.dedup_stream(sdf, "event_id").select("event_id", "user_id", "value"), "dedup")


@query("""
    WITH kinds AS (SELECT event_type, count(*) AS type_rows, round(avg(value), 4) AS type_avg FROM events GROUP BY 1)
    SELECT event_id, event_type, value, type_rows, type_avg FROM events JOIN kinds USING (event_type)
""")
def stream_enriched(t):
    kinds = t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("type_rows"), F.round(F.avg("value"), 4).alias("type_avg")
    )
    return _written(t, E.enrich(_stream(t).select("event_id", "event_type", "value"), kinds, "event_type"), "enriched")


def _stream_sides(t):
    """Two streams over the events, each with its own watermark so that both sides' state is bounded."""
    left, _ = _two_event_sides(_stream(t))
    _, right = _two_event_sides(_raw(t))
    return left, with_event_time(right, "other_ts", _delay(t))


@query(_INTERVAL_SQL.format(how=""))
def stream_interval_join(t):
    left, right = _stream_sides(t)
    out = interval_join(left, right, "user_id", "ts", "other_ts", 120, 120)
    return _written(t, out.drop("ts", "other_ts"), "interval")


@query(_INTERVAL_SQL.format(how="LEFT"))
def stream_interval_join_left(t):
    """Rows without a match appear once the watermark has passed; the flush lets it pass the last ones."""
    sides, flushes = [], []
    for k in (0, 1):
        raw, flush = flushed_source(_raw(t), "ts", shared_dir(t.spark, "flush"))
        side = _two_event_sides(raw)[k]
        sides.append(with_event_time(side, ("ts", "other_ts")[k], _delay(t)))
        flushes.append(flush)
    out = interval_join(*sides, "user_id", "ts", "other_ts", 120, 120, "left")
    return _written(t, out.drop("ts", "other_ts"), "interval-left", flush=lambda: [flush() for flush in flushes])


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_file_sink(t):
    """File source to a partitioned file sink and back."""
    base = shared_dir(t.spark, "stream-files")
    start_file_sink(_raw(t), f"{base}/rows", f"{base}/checkpoint", "event_type", trigger={"availableNow": True}).awaitTermination()
    return t.spark.read.schema(t.events.schema).parquet(f"{base}/rows")


@query("""
    SELECT event_id, CASE WHEN event_id % 10 = 0 OR value < 10 THEN 0.0 ELSE value END AS amount_validated,
           ts AS processed_timestamp FROM events
""")
def safe_event_amounts(t):
    """Every tenth amount is missing and small ones are made negative before the repair."""
    amount = F.when(F.col("event_id") % 10 == 0, F.lit(None)).when(F.col("value") < 10, -1.0).otherwise(F.col("value"))
    rows = t.events.select("event_id", "ts", amount.alias("amount"))
    return E.safe_amounts(rows, "amount", as_of=F.col("ts")).select("event_id", "amount_validated", "processed_timestamp")


# Arrival of events in twenty slots: up to 19 minutes after their time, every fortieth six hours more.
_SLOTS = 20
_ARRIVAL_MINUTES = "(event_id * 7 % 20 + CASE WHEN event_id % 40 = 0 THEN 360 ELSE 0 END)"


def _arriving(t, label, max_files=None):
    """The events as a stream that they come to slot by slot, and the steps that bring the slots."""
    # To the nearest second, halves to the even one.
    arrival = F.rint(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("long") + F.expr(_ARRIVAL_MINUTES) * 60
    known = t.events.agg(F.min(arrival).alias("first"), (F.max(arrival) - F.min(arrival) + 1).alias("span"))
    first, span = known.first()
    slot = F.expr("0") if first is None else F.floor((arrival - first) * _SLOTS / span)
    path, steps = L.arrivals(t.spark, t.events.withColumn("slot", slot.cast("int")), "slot", label)
    return file_source(t.spark, path, t.events.schema, max_files=max_files), steps


def _late_run(t, label, delay, stateful, mode="update", keys=()):
    source, steps = _arriving(t, label, max_files=4)
    # All slots are there at once; files are taken a few at a time in whatever order they are listed.
    list(steps())
    return L.run_with_late_rows(source, "ts", delay, stateful, label, mode, keys)


def _late_windows(t, label, delay, by, length, slide=None):
    parts = lambda rows: E.window_parts(rows, "ts", by, "value", length, slide)
    run = _late_run(t, label, delay, parts, keys=[*_WINDOW, by])
    return E.add_windows(run.emitted.unionByName(parts(run.late)), by)


@query(_TUMBLE_SQL)
def late_tumbling_windows(t):
    """Five-minute windows with a ten-minute watermark; late rows are added to closed windows."""
    return _shape(_late_windows(t, "late-tumbling", "10 minutes", "event_type", "5 minutes"), _TOTALS)


@query(_SLIDES_SQL.format(unique=""))
def late_sliding_windows(t):
    return _shape(_late_windows(t, "late-sliding", "10 minutes", "event_type", "5 minutes", "1 minute"), _TOTALS)


@query(_FRAUD_SQL)
def late_fraud_windows(t):
    windows = _late_windows(t, "late-fraud", "5 minutes", "user_id", "1 hour").drop("avg_amount")
    return _shape(E.score_windows(windows, 2, 300, 0.4), _FRAUD)


@query(_SESSIONS_SQL)
def late_session_windows(t):
    """Sessions with a fifteen-minute watermark; late rows join or bridge closed sessions."""
    sessions = lambda rows: E.session_stats(rows, "ts", "user_id", "value", "30 minutes")
    run = _late_run(t, "late-sessions", "15 minutes", sessions, "append")
    return _shape(E.join_sessions(run.emitted.unionByName(sessions(run.late)), "user_id", "30 minutes"), {"total_amount": 4})


@query(f"""
    WITH arrived AS (SELECT *, epoch(ts)::BIGINT + {_ARRIVAL_MINUTES} * 60 AS came FROM events),
    slots AS (SELECT *, ((came - min(came) OVER ()) * {_SLOTS} / (max(came) OVER () - min(came) OVER () + 1))::DOUBLE AS place FROM arrived),
    marks AS (SELECT floor(place) AS slot, max(ts) AS latest FROM slots GROUP BY 1),
    before AS (SELECT slot, max(latest) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM marks)
    SELECT event_id, user_id, ts FROM slots JOIN before ON slot = floor(place) WHERE ts < mark - INTERVAL 10 MINUTE
""")
def late_rows_aside(t):
    """The rows that a ten-minute watermark leaves behind when the slots come one after the other."""
    source, steps = _arriving(t, "late-rows")
    folder = shared_dir(t.spark, "late-rows")
    for _ in steps():
        L.start_divert(source, "ts", "10 minutes", folder, {"availableNow": True}).awaitTermination()
    return L.late_rows(t.spark, folder, t.events.schema).select("event_id", "user_id", "ts")


@query(_SESSIONS_SQL)
def stream_split_sessions(t):
    """Sessions per user and two hours, joined over the borders by a second stateful query."""
    out = run_split_sessions(_raw(t), "ts", "user_id", "value", 1800, 7200, _delay(t), "split")
    return _shape(out, {"total_amount": 4})
