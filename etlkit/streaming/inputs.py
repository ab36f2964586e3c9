"""Streaming sources and event time."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.runtime import require

# The payload of a transaction message.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_time", T.StringType()),
    T.StructField("category", T.StringType()),
])
# A preset that starts at new records and passes over lost ones. Ask for it by name.
KAFKA_LATEST_LOSSY = {
    "startingOffsets": "latest",
    "maxOffsetsPerTrigger": "100000",
    "kafka.consumer.session.timeout.ms": "30000",
    "kafka.consumer.heartbeat.interval.ms": "10000",
    "failOnDataLoss": "false",
}


# All records from the first on; a lost offset is an error.
KAFKA_COMPLETE = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def kafka_options(servers: str, topics: str, preset: Mapping[str, str] = KAFKA_COMPLETE, **overrides: str) -> dict[str, str]:
    base = {"kafka.bootstrap.servers": servers, "subscribe": topics}
    return base | dict(preset) | {k: str(v) for k, v in overrides.items()}


def kafka_source(spark: SparkSession, servers: str, topics: str, preset: Mapping[str, str] = KAFKA_COMPLETE, **overrides: str) -> DataFrame:
    """Subscribe to topics. Needs Spark's Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, preset, **overrides)).load()


def file_source(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None,
    max_bytes: str | None = None, fmt: str = "parquet", **options: str,
) -> DataFrame:
    """Stream of new files. ``cleanSource`` and ``latestFirst`` are source options too."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("cap batches by files or by bytes, not both")
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def flushed_source(source: DataFrame, ts: str, folder: str) -> tuple[DataFrame, Callable[[], None]]:
    """A stream with a second, empty source, and a call that puts one row of the year 9000 in it.

    That row, null but for its time, moves the watermark past everything that came before, so that a
    stream that has ended can emit its open windows. Its own window never closes.
    """
    spark = source.sparkSession
    spark.createDataFrame([], source.schema).write.parquet(folder)
    last = [F.lit("9000-01-01 00:00:00").cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema]

    def flush() -> None:
        spark.range(1).select(*last).write.mode("append").parquet(folder)

    return source.unionByName(file_source(spark, folder, source.schema)), flush


def parse_envelope(df: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Key and JSON value of messages to typed columns, next to topic, partition, offset, timestamp."""
    require(df, "key", "value", "topic", "partition", "offset", "timestamp")
    parsed = F.from_json(F.col("value").cast("string"), schema).alias("parsed")
    return df.select(
        F.col("key").cast("string").alias("key"), "topic", "partition", "offset", "timestamp", parsed
    ).select("key", "topic", "partition", "offset", "timestamp", "parsed.*")


def with_event_time(sdf: DataFrame, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Event time as TIMESTAMP with a watermark; rows later than ``delay`` are dropped from state."""
    require(sdf, ts)
    return sdf.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
