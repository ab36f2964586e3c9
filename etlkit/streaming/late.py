"""Streams with a short watermark that lose no row.

Rows behind the watermark would be dropped by a stateful step. Here a first query splits arriving
rows by the watermark that the rows of earlier batches set: rows on time go on to the stateful query,
whose state is bounded by the delay, and late rows to a side table. A late row is older than the
latest time of an earlier batch by more than the delay. The stateful query takes whole batches of the first,
so its watermark never passes a row that was on time there. Closed windows and the
windows of late rows are put together when they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from etlkit.runtime import names, require, shared_dir
from etlkit.streaming.inputs import file_source, flushed_source, with_event_time
from etlkit.streaming.progress import progress_frame
from etlkit.streaming.sinks import commit_batch, committed_batches, latest_versions, start_batch_sink, start_file_sink

_MARK = "mark timestamp"


class LateRun(NamedTuple):
    """What a finished run wrote: rows of the stateful query, late rows, and the progress of the stateful query."""

    emitted: DataFrame
    late: DataFrame
    progress: DataFrame


def _mark_before(spark: SparkSession, folder: str, batch_id: int):
    """The latest event time of all batches before one, or None."""
    known = committed_batches(spark, folder)
    if not any(k < batch_id for k in known):
        return None
    last = max(k for k in known if k < batch_id)
    return spark.read.schema(_MARK).parquet(f"{folder}/batch={last}").first()["mark"]


def start_divert(source: DataFrame, ts: str, delay: str, folder: str, trigger: dict | None = None) -> StreamingQuery:
    """Split a stream without a watermark into ``rows/batch=n/late=0`` and ``late=1`` below ``folder``.

    A batch is committed once whatever is repeated after a failure. Rows without a time are on time.
    """
    require(source, ts)
    spark = source.sparkSession

    def split(batch: DataFrame, batch_id: int) -> None:
        before = _mark_before(spark, f"{folder}/marks", batch_id)
        at = F.col(ts).cast("timestamp")
        late = F.lit(False) if before is None else F.coalesce(at < F.lit(before) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        commit_batch(batch.withColumn("late", late.cast("int")), batch_id, f"{folder}/rows", ["late"])
        # The mark is taken from what was committed, so that a repeat gives the same.
        rows = spark.read.schema(source.schema).parquet(f"{folder}/rows/batch={batch_id}")
        mark = F.max(F.col(ts).cast("timestamp"))
        mark = mark if before is None else F.greatest(mark, F.lit(before))
        commit_batch(rows.agg(mark.alias("mark")), batch_id, f"{folder}/marks")

    return start_batch_sink(source, split, f"{folder}/divert-checkpoint", "append", trigger)


def _make_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)


def on_time_source(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Stream of the rows on time. It must not be capped by files: a trigger takes whole batches."""
    _make_folder(spark, f"{folder}/rows")
    return file_source(spark, f"{folder}/rows/batch=*/late=0", schema)


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField("late", T.IntegerType())])).option("basePath", f"{folder}/rows").parquet(
        f"{folder}/rows/batch=*").filter("late = 1").select(*schema.names)


def run_with_late_rows(
    source: DataFrame, ts: str, delay: str, stateful: Callable[[DataFrame], DataFrame], label: str, mode: str = "update",
    keys: str | Sequence[str] = (), steps: Callable[[], object] | None = None,
) -> LateRun:
    """Run a stateful query over all available input with a watermark of ``delay``; late rows are kept aside.

    ``stateful`` maps the watermarked stream to the result. Update mode gives the latest version of each of
    ``keys``; append mode gives closed windows, the last ones by a flush. Both queries run at
    once. ``steps``, a generator function, is called first and run to its end instead, the
    stateful query catching up after each step, for input that arrives bit by bit.
    """
    keys, spark = names(keys), source.sparkSession
    if mode not in ("update", "append") or mode == "update" and not keys:
        raise ValueError("mode is 'append', or 'update' with keys")
    folder = shared_dir(spark, f"stream-{label}")
    raw, flush = on_time_source(spark, folder, source.schema), None
    if mode == "append":
        raw, flush = flushed_source(raw, ts, f"{folder}/flush")
    out = stateful(with_event_time(raw, ts, delay))
    if mode == "append":
        query = start_file_sink(out, f"{folder}/out", f"{folder}/checkpoint")
    else:
        query = start_batch_sink(out, lambda batch, batch_id: _replace(batch, f"{folder}/out/batch={batch_id}"), f"{folder}/checkpoint", "update")
    try:
        for _ in steps() if steps else (None,):
            start_divert(source, ts, delay, folder, {"availableNow": True}).awaitTermination()
            query.processAllAvailable()
        if flush:
            flush()
            query.processAllAvailable()
        progress = progress_frame(query)
    finally:
        query.stop()
    if mode == "append":
        emitted = spark.read.schema(out.schema).parquet(f"{folder}/out")
    else:
        emitted = latest_versions(spark.read.schema(T.StructType([*out.schema, T.StructField("batch", T.LongType())])).parquet(f"{folder}/out"), keys, out.columns)
    return LateRun(emitted, late_rows(spark, folder, source.schema), progress)


def _replace(batch: DataFrame, path: str) -> None:
    batch.write.mode("overwrite").parquet(path)


def arrivals(spark: SparkSession, rows: DataFrame, slot: str, label: str) -> tuple[str, Callable[[], object]]:
    """A folder that rows come to slot by slot, and a generator function whose steps bring one slot each.

    The rows are written once, by slot; a step moves a folder, so that files appear at once.
    """
    base = shared_dir(spark, f"arrivals-{label}")
    rows.write.partitionBy(slot).parquet(f"{base}/waiting")
    _make_folder(spark, f"{base}/arrived")
    here = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/waiting")
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())

    def steps():
        found = sorted((s.getPath().getName() for s in fs.listStatus(here) if s.isDirectory()), key=lambda n: int(n.split("=")[1]))
        for name in found:
            fs.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/waiting/{name}"), spark._jvm.org.apache.hadoop.fs.Path(f"{base}/arrived/{name}"))
            yield name

    return f"{base}/arrived/*", steps
