"""Streaming sinks. Every durable sink takes its checkpoint folder explicitly."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from etlkit.runtime import names, shared_dir

TRIGGERS = ("processingTime", "availableNow", "once", "continuous")
MODES = ("append", "update", "complete")


def with_trigger(writer: DataStreamWriter, trigger: Mapping[str, object] | None) -> DataStreamWriter:
    """``{"processingTime": "30 seconds"}``, ``{"availableNow": True}``, ``{"continuous": "1 second"}``."""
    if not trigger:
        return writer
    if len(trigger) != 1 or next(iter(trigger)) not in TRIGGERS:
        raise ValueError(f"trigger must be one of {TRIGGERS}")
    return writer.trigger(**trigger)


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


def start_file_sink(
    sdf: DataFrame, path: str, ckpt: str, by: str | Sequence[str] = (), fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append to files, partitioned on request; exactly once by the sink's own log."""
    writer = sdf.writeStream.format(fmt).option("path", path).option("checkpointLocation", ckpt)
    if by:
        writer = writer.partitionBy(*names(by))
    return with_trigger(writer.outputMode("append"), trigger).start()


def to_kafka_value(sdf: DataFrame) -> DataFrame:
    """Whole rows as JSON in one column named ``value``."""
    return sdf.select(F.to_json(F.struct("*")).alias("value"))


def kafka_sink_options(servers: str, topic: str, ckpt: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": ckpt}


def start_kafka_sink(
    sdf: DataFrame, servers: str, topic: str, ckpt: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Rows as JSON messages. Needs Spark's Kafka package on the class path."""
    writer = to_kafka_value(sdf).writeStream.format("kafka").options(**kafka_sink_options(servers, topic, ckpt))
    return with_trigger(writer.outputMode("append"), trigger).start()


def start_debug_sink(
    sdf: DataFrame, kind: str, name: str | None = None, mode: str = "append", rows: int = 20,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Console or in-memory table, for looking at small streams."""
    if kind == "memory":
        if not name:
            raise ValueError("a memory sink needs a table name")
        writer = sdf.writeStream.format("memory").queryName(name)
    elif kind == "console":
        writer = sdf.writeStream.format("console").option("truncate", False).option("numRows", rows)
    else:
        raise ValueError("kind must be 'console' or 'memory'")
    return with_trigger(writer.outputMode(_mode(mode)), trigger).start()


def start_batch_sink(
    sdf: DataFrame, write: Callable[[DataFrame, int], None], ckpt: str, mode: str = "append",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Call ``write(batch, batch_id)`` per batch. A batch may be repeated after a failure, so
    ``write`` must replace what it wrote for the same id before, or use ``commit_batch``."""
    writer = sdf.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    return with_trigger(writer.outputMode(_mode(mode)), trigger).start()


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that ``commit_batch`` has put below ``path``."""
    at, fs = _path(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removeprefix("batch=")) for n in found if n.startswith("batch="))


def commit_batch(batch: DataFrame, batch_id: int, path: str, by: str | Sequence[str] = ()) -> bool:
    """Put a batch in ``path/batch=<id>`` once; False if the batch is there already.

    Rows are staged beside the table and moved there in one step, which records the batch's number by
    the folder's name. A failure before that step leaves nothing that readers see (names with an
    underscore are hidden); a repeat after it changes nothing. Of two attempts at once the second
    move fails and is taken back. The folder's file system must move folders in one step.
    """
    spark = batch.sparkSession
    target, fs = _path(spark, f"{path}/batch={batch_id}")
    if fs.exists(target):
        return False
    staged, _ = _path(spark, f"{path}/_staged/{batch_id}-{uuid.uuid4().hex}")
    writer = batch.write
    (writer.partitionBy(*names(by)) if by else writer).parquet(staged.toString())
    jvm = spark._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    try:
        context.rename(staged, target, plain)
    except Py4JJavaError:
        if not fs.exists(target):
            raise
        fs.delete(staged, True)
        return False
    return True


def start_committed_sink(
    sdf: DataFrame, path: str, ckpt: str, by: str | Sequence[str] = (), mode: str = "append",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """A sink per batch that leaves every batch once, also when Spark repeats it after a failure."""
    return start_batch_sink(sdf, lambda batch, batch_id: commit_batch(batch, batch_id, path, by) and None, ckpt, mode, trigger)


def latest_versions(versions: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row of the last ``batch`` for each key."""
    rest = [c for c in columns if c not in keys]
    latest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__row"))
    return latest.select(*keys, "__row.*").select(*columns)


def rows_dropped(query: StreamingQuery) -> int:
    """Rows that a finished query left out because they came later than the watermark allows.

    Spark remembers a bounded number of batches; a run of more than these cannot be vouched for.
    """
    seen = query.recentProgress
    if seen and seen[-1]["batchId"] - seen[0]["batchId"] > len({p["batchId"] for p in seen}) - 1 or len(seen) >= int(
        SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    ):
        raise RuntimeError("batches are missing from the progress; raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in seen for op in p.get("stateOperators", []))


def run_to_table(
    sdf: DataFrame, label: str, mode: str = "append", keys: Sequence[str] = (), flush: Callable[[], None] | None = None,
    allow_late: bool = False, one_batch: bool = False,
) -> DataFrame:
    """Process all available input and return the written result as a batch frame.

    Append mode uses the file sink. Otherwise each batch replaces its own folder: in update mode
    the latest version of every key is read back, in complete mode the last folder. Nothing passes
    through the driver. ``flush`` is called when all input is processed and adds a row so late that
    every open window closes; the query then goes on to emit what was open. With ``one_batch`` the source has no limit, so one
    batch takes all input: the row is added before it, as no row is late in the first batch, and the state is read and written
    twice in place of four times. Rows dropped as late are
    an error unless ``allow_late`` asks for them to be left out.
    """
    spark = sdf.sparkSession
    base = shared_dir(spark, f"stream-{label}")
    out, ckpt = f"{base}/rows", f"{base}/checkpoint"
    now = {"availableNow": True}
    if _mode(mode) == "update" and not keys:
        raise ValueError("update mode needs keys")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def run() -> StreamingQuery:
        query = start_file_sink(sdf, out, ckpt, trigger=now) if mode == "append" else start_batch_sink(sdf, replace, ckpt, mode, now)
        query.awaitTermination()
        dropped = rows_dropped(query)
        if dropped and not allow_late:
            raise RuntimeError(f"{dropped} rows came later than the watermark allows; give the stream a longer delay")
        return query

    if flush and one_batch:
        flush()
    query = run()
    if flush and not one_batch:
        flush()
        query = run()
    if mode == "append":
        return spark.read.schema(sdf.schema).parquet(out)
    if mode == "complete":
        last = query.lastProgress["batchId"]
        return spark.read.schema(sdf.schema).parquet(f"{out}/batch={last}")
    return latest_versions(spark.read.parquet(out), keys, sdf.columns)
