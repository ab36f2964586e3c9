"""Partition layout and skew measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.functions.dates import with_date_parts
from etlkit.runtime import names, plan_bytes, require

# Skew ratios that separate the levels, and the names and advice of the levels.
SKEW_LEVELS = ((1.5, "none"), (2.5, "mild"), (5.0, "moderate"))
SKEW_WORST = "high"
SKEW_ADVICE = {
    "none": "excellent distribution",
    "mild": "monitor",
    "moderate": "consider salting",
    "high": "salt or repartition",
}
HEALTH_LEVELS = ((1.5, "excellent"), (2.5, "good"), (5.0, "warning"))
HEALTH_WORST = "critical"
# Bytes per field used for size estimates.
FIELD_BYTES = {"int": 4, "bigint": 8, "double": 8, "string": 20, "timestamp": 8, "timestamp_ntz": 8, "boolean": 1}


def level_of(ratio: Column, levels: Sequence[tuple[float, str]], worst: str) -> Column:
    """Name of the first level whose bound lies above ``ratio``."""
    ladder = F
    for bound, label in levels:
        ladder = ladder.when(ratio < bound, F.lit(label))
    return ladder.otherwise(F.lit(worst))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def balance(df: DataFrame, rows_per_partition: int = 100_000) -> DataFrame:
    """One row: partitions, sizes, balance score, skew, health and a recommended partition count."""
    sizes = partition_sizes(df).agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("total_rows"),
        F.min("rows").alias("min_rows"), F.max("rows").alias("max_rows"), F.avg("rows").alias("avg_rows"),
    )
    skew = F.try_divide("max_rows", "avg_rows")
    return sizes.withColumns({
        "balance_score": F.round(F.try_divide(F.col("min_rows") * 100.0, F.col("max_rows")), 2),
        "skew_ratio": F.round(skew, 4),
        "health": level_of(skew, HEALTH_LEVELS, HEALTH_WORST),
        "recommended_partitions": F.greatest(F.lit(1), F.expr(f"total_rows div {rows_per_partition}")),
    })


def key_skew(
    df: DataFrame, column: str | Sequence[str], levels: Sequence[tuple[float, str]] = SKEW_LEVELS,
    worst: str = SKEW_WORST,
) -> DataFrame:
    """One row on group sizes: extremes, average, spread, max/avg ratio, level and advice."""
    require(df, *names(column))
    sizes = df.groupBy(*names(column)).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("groups"), F.min("n").alias("min_size"), F.max("n").alias("max_size"),
        F.avg("n").alias("avg_size"), F.stddev("n").alias("stddev_size"),
    )
    ratio = F.try_divide("max_size", "avg_size")
    level = level_of(ratio, levels, worst)
    advice = F.coalesce(*[F.when(level == name, F.lit(text)) for name, text in SKEW_ADVICE.items()])
    return sizes.withColumns({
        "skew_ratio": ratio,
        "variation": F.try_divide("stddev_size", "avg_size"),
        "level": level,
        "advice": advice,
    })


def bucket_sizes(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Rows per bucket as Spark's own bucketing would place them, with the skew verdict."""
    require(df, *columns)
    sizes = df.groupBy(F.pmod(F.hash(*columns), F.lit(n)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    # At most n buckets, so this join is small whatever the table holds.
    stats = sizes.agg(F.struct(F.max("rows").alias("hi"), F.avg("rows").alias("mean"))).scalar()
    ratio = stats["hi"] / stats["mean"]
    return sizes.withColumns({
        "skew_ratio": ratio,
        "verdict": F.when(ratio > 2, "warning").when(ratio > 1.5, "caution").otherwise("good"),
    })


def partition_value_sizes(df: DataFrame, columns: Sequence[str], small: int = 1000) -> DataFrame:
    """One row on a planned partitioning: number, sizes and share of small partitions."""
    require(df, *columns)
    sizes = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("partitions"), F.min("n").alias("smallest"), F.max("n").alias("largest"),
        F.avg("n").alias("avg_rows"), F.count_if(F.col("n") < small).alias("small_partitions"),
    )
    share = F.try_divide(F.col("small_partitions") * 1.0, F.col("partitions"))
    return sizes.withColumns({"small_share": share, "too_fine": share > 0.3})


def resize(df: DataFrame, target: int, current: int | None = None) -> DataFrame:
    """Fewer partitions by coalescing, more by a shuffle. AQE rebalancing when nothing is known."""
    if target < 1:
        raise ValueError("target must be at least 1")
    if current is None:
        return df.hint("rebalance")
    return df.coalesce(target) if target <= current else df.repartition(target)


def layout_by_month(df: DataFrame, ts: str, n: int | None = None) -> DataFrame:
    """Date parts added and rows partitioned by (year, month)."""
    dated = with_date_parts(df, ts)
    return dated.repartition(n, "year", "month") if n else dated.repartition("year", "month")


def estimate_bytes(df: DataFrame) -> DataFrame:
    """One row: rows x declared field widths, beside the optimizer's own estimate."""
    width = sum(FIELD_BYTES.get(field.dataType.simpleString(), 20) for field in df.schema.fields)
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumns({
        "bytes_per_row": F.lit(width).cast("long"),
        "estimated_bytes": F.col("rows") * width,
        "plan_bytes": F.lit(plan_bytes(df)).cast("long"),
    })


def measured_bytes(df: DataFrame, fraction: float = 0.01, seed: int = 1) -> DataFrame:
    """One row: rows x the average length of sampled rows, for texts and nested values of any length.

    The sample is read once beside the count; a row's length is that of its values, not of its files.
    """
    def length(field: T.StructField) -> Column:
        kind, column = field.dataType.simpleString(), F.col(f"`{field.name}`")
        if kind in FIELD_BYTES and kind != "string":
            return F.lit(FIELD_BYTES[kind])
        text = column if kind in ("string", "binary") else F.to_json(F.struct(column))
        return F.coalesce(F.octet_length(text), F.lit(0))

    size = sum((length(f) for f in df.schema.fields), F.lit(0)).cast("long")
    sampled = df.sample(False, fraction, seed) if fraction < 1 else df
    mean = sampled.agg(F.avg(size).alias("m")).scalar()
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumns({"bytes_per_row": F.round(mean, 2), "estimated_bytes": F.round(F.col("rows") * mean).cast("long")})
