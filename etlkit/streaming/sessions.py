"""Streaming sessions whose state is spread over stretches of time.

One key's open sessions are one group of state in a plain session window. Here a first query makes
sessions per key and stretch of time, so that a busy key has many groups, and a second one joins
sessions that touch over a border. Its state holds a row per key and piece, never an event.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import names, require, shared_dir
from etlkit.streaming.inputs import file_source, flushed_source, with_event_time
from etlkit.streaming.sinks import rows_dropped, start_file_sink


def session_pieces(sdf: DataFrame, ts: str, key: str | Sequence[str], amount: str, gap: str, stretch_seconds: int) -> DataFrame:
    """Sessions of each key within each stretch of time."""
    key = names(key)
    require(sdf, ts, *key, amount)
    stretch = F.floor(F.unix_seconds(ts) / stretch_seconds).alias("__stretch")
    out = sdf.groupBy(F.session_window(ts, gap).alias("window"), *key, stretch).agg(
        F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *key, "total_amount", "transaction_count")


def joined_pieces(pieces: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Sessions of pieces: a piece opens a session as long as itself, and pieces that touch are one."""
    key = names(key)
    length = F.concat((F.unix_micros("window_end") - F.unix_micros("window_start")).cast("string"), F.lit(" microseconds"))
    out = pieces.groupBy(F.session_window("window_start", length).alias("window"), *key).agg(
        F.sum("total_amount").alias("total_amount"), F.sum("transaction_count").alias("transaction_count"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *key, "total_amount", "transaction_count")


def run_split_sessions(
    source: DataFrame, ts: str, key: str | Sequence[str], amount: str, gap_seconds: int, stretch_seconds: int, delay: str, label: str,
) -> DataFrame:
    """Sessions of all available input, by two chained queries; rows later than ``delay`` are an error.

    A piece is written after the watermark has passed its end, and starts at most a stretch and a gap
    before that, which is the delay of the second query. That one reads whole batches of the first.
    """
    spark = source.sparkSession
    base = shared_dir(spark, f"sessions-{label}")

    def finished(out: DataFrame, name: str, flush: Callable[[], None]) -> None:
        for last in (False, True):
            query = start_file_sink(out, f"{base}/{name}", f"{base}/{name}-checkpoint", trigger={"availableNow": True})
            query.awaitTermination()
            if rows_dropped(query):
                raise RuntimeError("rows came later than the watermark allows; give the stream a longer delay")
            if not last:
                flush()

    raw, flush = flushed_source(source, ts, f"{base}/flush-rows")
    pieces = session_pieces(with_event_time(raw, ts, delay), ts, key, amount, f"{gap_seconds} seconds", stretch_seconds)
    finished(pieces, "pieces", flush)
    # The folder is a sink's own, so a reader sees the files of a batch together.
    read, flush = flushed_source(file_source(spark, f"{base}/pieces", pieces.schema), "window_start", f"{base}/flush-pieces")
    whole = joined_pieces(with_event_time(read, "window_start", f"{gap_seconds + stretch_seconds} seconds"), key)
    finished(whole, "sessions", flush)
    return spark.read.schema(whole.schema).parquet(f"{base}/sessions")
