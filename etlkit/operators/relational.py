"""Samples, slices, summaries, set operations, sorting and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.functions.values import hash_below, tier
from etlkit.runtime import names, require


def sample(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, key: str | Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """Keep a fixed share of keys, with all their rows."""
    require(df, *names(key))
    return df.filter(hash_below([F.col(c) for c in names(key)], fraction, seed))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max, one row per column, from one pass over the table."""
    require(df, *columns)
    stats = {"count": F.count, "mean": F.avg, "stddev": F.stddev, "min": F.min, "max": F.max}
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            *[fn(F.col(c).cast("double")).cast("bigint" if s == "count" else "double").alias(s)
              for s, fn in stats.items()],
        )
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def slice_by_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column < high``; the bounds reach the scan as filters."""
    require(df, column)
    return df.filter((F.col(column) >= F.lit(low)) & (F.col(column) < F.lit(high)))


def with_slice(df: DataFrame, column: str, width: int, name: str = "slice") -> DataFrame:
    """Number of the id range that each row falls in, to work on all slices at once."""
    require(df, column)
    return df.withColumn(name, F.expr(f"(CAST(`{column}` AS BIGINT) - pmod(CAST(`{column}` AS BIGINT), {int(width)}L)) div {int(width)}L"))


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_alerts(
    high_value: DataFrame, fraud: DataFrame, amount: str = "amount", score: str = "fraud_score",
    critical: float = 50_000, high: float = 50,
) -> DataFrame:
    """Both alert kinds in one frame, missing columns NULL, with a severity tier."""
    both = high_value.unionByName(fraud, allowMissingColumns=True)
    require(both, amount, score)
    return both.withColumn(
        "alert_severity",
        F.when(F.col(amount) > critical, "CRITICAL").when(F.col(score) > high, "HIGH").otherwise("MEDIUM"),
    )


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per group. Spark keeps k rows per group in each task before the shuffle."""
    require(df, *names(by))
    rank = F.row_number().over(Window.partitionBy(*names(by)).orderBy(*order))
    return df.withColumn("rank_in_group", rank).filter(F.col("rank_in_group") <= k)


def top_keys(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n most frequent values with their counts; equal counts are ordered by value."""
    require(df, column)
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), F.asc(column)).limit(n)


def range_sorted(df: DataFrame, columns: str | Sequence[str], n: int) -> DataFrame:
    """Range-partitioned and sorted inside each partition: ordered across files."""
    columns = names(columns)
    require(df, *columns)
    return df.repartitionByRange(n, *columns).sortWithinPartitions(*columns)


def with_tier(df: DataFrame, column: str, steps, default: str, name: str) -> DataFrame:
    require(df, column)
    return df.withColumn(name, tier(F.col(column), steps, default))
