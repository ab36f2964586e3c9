"""Progress of a running query as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("input_rate", T.DoubleType()),
    T.StructField("processing_rate", T.DoubleType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("sources", T.ArrayType(T.StructType([
        T.StructField("description", T.StringType()),
        T.StructField("start_offset", T.StringType()),
        T.StructField("end_offset", T.StringType()),
    ]))),
    T.StructField("falling_behind", T.BooleanType()),
    T.StructField("large_state", T.BooleanType()),
])


def progress_row(p: dict, lag: float = 1.2, state_limit: int = 1_000_000) -> tuple:
    """One batch's figures, flagged when input outruns processing or state grows large."""
    arrived = float(p.get("inputRowsPerSecond") or 0.0)
    done = float(p.get("processedRowsPerSecond") or 0.0)
    state = sum(int(op.get("numRowsTotal", 0)) for op in p.get("stateOperators", []))
    sources = [
        (str(s.get("description")), str(s.get("startOffset")), str(s.get("endOffset")))
        for s in p.get("sources", [])
    ]
    return (
        int(p["batchId"]), p.get("timestamp"), int(p.get("numInputRows", 0)), arrived, done,
        int(p.get("batchDuration", 0)), state, sources, arrived > done * lag, state > state_limit,
    )


def progress_frame(query: StreamingQuery, lag: float = 1.2, state_limit: int = 1_000_000) -> DataFrame:
    """The batches Spark still remembers (a bounded number), oldest first."""
    rows = [progress_row(p, lag, state_limit) for p in query.recentProgress]
    return SparkSession.active().createDataFrame(rows, SCHEMA)
