"""Event-time operators. Each takes a batch or a streaming frame and gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.runtime import BROADCAST_LIMIT, names, require
from etlkit.operators.joins import join_dim


def _ends(df: DataFrame, window: str = "window") -> DataFrame:
    """Window bounds as plain columns."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *rest
    )


def sliding_stats(
    sdf: DataFrame, ts: str, by: str | Sequence[str], amount: str, length: str = "5 minutes",
    slide: str | None = "1 minute", unique: str | None = None, exact: bool = False,
) -> DataFrame:
    """Sum, count, average and, for ``unique``, distinct values per window and key.

    Streams cannot run a distinct aggregate. Their distinct count is a fixed-size sketch, or with
    ``exact=True`` a second aggregation over (window, key, value), which needs append mode.
    """
    by = names(by)
    require(sdf, ts, *by, amount)
    at = F.window(F.col(ts).cast("timestamp") if not sdf.isStreaming else ts, length, slide)
    totals = [F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("transaction_count")]
    if unique and exact:
        # One row per value and window first: no task or state row ever holds a set of values.
        # Rows without a value stay in the totals and are no value of their own.
        fine = sdf.groupBy(at.alias("window"), *by, F.col(unique).alias("__unique")).agg(*totals, F.count(amount).alias("__amounts"))
        coarse = fine.groupBy("window", *by).agg(
            F.sum("total_amount").alias("total_amount"),
            F.sum("transaction_count").alias("transaction_count"),
            F.count("__unique").alias("unique_values"),
            F.sum("__amounts").alias("__amounts"),
        )
        return _ends(coarse.withColumn("avg_amount", F.try_divide("total_amount", "__amounts")).drop("__amounts"))
    extra = [F.approx_count_distinct(unique).alias("unique_values")] if unique else []
    out = sdf.groupBy(at.alias("window"), *by).agg(*totals, F.avg(amount).alias("avg_amount"), *extra)
    return _ends(out)


def tumbling_stats(
    sdf: DataFrame, ts: str, by: str | Sequence[str], amount: str, length: str = "5 minutes"
) -> DataFrame:
    return sliding_stats(sdf, ts, by, amount, length, None)


def session_stats(
    sdf: DataFrame, ts: str, key: str | Sequence[str], amount: str, gap: str = "5 minutes",
    stretch: str = "1 hour",
) -> DataFrame:
    """Sessions per key that end after ``gap`` without an event.

    Streams use Spark's session window. A batch is cut into stretches of time first, so that a
    busy key is worked on by many tasks: sessions inside each stretch, then sessions that touch
    over a border are put together. A key has at most one piece per ``gap`` and stretch.
    """
    key = names(key)
    require(sdf, ts, *key, amount)
    totals = [F.sum("total_amount").alias("total_amount"), F.sum("transaction_count").alias("transaction_count")]
    if sdf.isStreaming:
        out = sdf.groupBy(F.session_window(ts, gap).alias("window"), *key).agg(
            F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("transaction_count")
        )
        return _ends(out)
    length = F.expr(f"INTERVAL {gap}")
    rows = sdf.filter(F.col(ts).isNotNull()).select(
        *key, F.col(ts).cast("timestamp").alias("__at"), F.col(amount).alias("__amount")
    ).withColumn("__stretch", F.window("__at", stretch)["start"])
    pieces = _numbered_sessions(rows, [*key, "__stretch"], F.col("__at"), F.col("__at"), length).groupBy(
        *key, "__stretch", "__session"
    ).agg(
        F.min("__at").alias("__first"), F.max("__at").alias("__last"),
        F.sum("__amount").alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"),
    ).drop("__stretch", "__session")
    whole = _numbered_sessions(pieces, key, F.col("__first"), F.col("__last"), length).groupBy(*key, "__session").agg(
        F.min("__first").alias("window_start"), (F.max("__last") + length).alias("window_end"), *totals
    )
    return whole.select("window_start", "window_end", *key, "total_amount", "transaction_count")


def window_parts(
    sdf: DataFrame, ts: str, by: str | Sequence[str], amount: str, length: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """Totals per window and key that can be added up: sum, rows, rows with an amount."""
    by = names(by)
    require(sdf, ts, *by, amount)
    at = F.window(F.col(ts).cast("timestamp") if not sdf.isStreaming else ts, length, slide)
    return _ends(sdf.groupBy(at.alias("window"), *by).agg(
        F.sum(amount).alias("total_amount"), F.count(F.lit(1)).alias("transaction_count"), F.count(amount).alias("amounts")))


def add_windows(parts: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Windows from parts of several runs, one row per window and key, with the average amount."""
    whole = parts.groupBy("window_start", "window_end", *names(by)).agg(
        *[F.sum(c).alias(c) for c in ("total_amount", "transaction_count", "amounts")])
    return whole.withColumn("avg_amount", F.try_divide("total_amount", "amounts")).drop("amounts")


def join_sessions(parts: DataFrame, key: str | Sequence[str], gap: str = "5 minutes") -> DataFrame:
    """Sessions from parts of several runs: parts of a key that follow within ``gap`` become one."""
    key, length = names(key), F.expr(f"INTERVAL {gap}")
    pieces = parts.withColumn("__last", F.col("window_end") - length)
    whole = _numbered_sessions(pieces, key, F.col("window_start"), F.max("__last").over(_before(key)), length, running=True)
    whole = whole.groupBy(*key, "__session").agg(
        F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"),
        F.sum("total_amount").alias("total_amount"), F.sum("transaction_count").alias("transaction_count"))
    return whole.select("window_start", "window_end", *key, "total_amount", "transaction_count")


def _before(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("window_start").rowsBetween(Window.unboundedPreceding, -1)


def _numbered_sessions(rows: DataFrame, keys: Sequence[str], first: Column, last: Column, gap: Column, running: bool = False) -> DataFrame:
    """Number rows per key so that rows which follow each other within ``gap`` share a number.

    With ``running``, ``last`` is already the latest end of all rows before.
    """
    order = Window.partitionBy(*keys).orderBy(first)
    starts = F.when(first <= (last if running else F.lag(last).over(order)) + gap, 0).otherwise(1)
    return rows.withColumn("__starts", starts).withColumn(
        "__session", F.sum("__starts").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("__starts")


def high_value_alerts(
    sdf: DataFrame, amount: str = "amount", limit: float = 10_000, as_of: Column | None = None
) -> DataFrame:
    """Rows above ``limit`` with an alert type, a risk score and the time of the alert."""
    require(sdf, amount)
    return sdf.filter(F.col(amount) > limit).withColumns({
        "alert_type": F.lit("HIGH_VALUE"),
        "alert_timestamp": F.current_timestamp() if as_of is None else as_of,
        "risk_score": F.col(amount) / 1000,
    })


def fraud_scores(
    sdf: DataFrame, ts: str, customer: str, amount: str, length: str = "1 minute",
    min_count: int = 10, min_total: float = 50_000, min_score: float = 20,
) -> DataFrame:
    """Busy or expensive customer windows, scored by 0.3 x count + 0.7 x total / 1000."""
    return score_windows(tumbling_stats(sdf, ts, customer, amount, length).drop("avg_amount"), min_count, min_total, min_score)


def score_windows(windows: DataFrame, min_count: int = 10, min_total: float = 50_000, min_score: float = 20) -> DataFrame:
    """The windows of ``fraud_scores`` among finished totals."""
    score = F.col("transaction_count") * 0.3 + F.col("total_amount") / 1000 * 0.7
    return (
        windows.filter((F.col("transaction_count") > min_count) | (F.col("total_amount") > min_total))
        .withColumn("fraud_score", score).filter(F.col("fraud_score") > min_score)
    )


def diverse_fraud_scores(
    df: DataFrame, ts: str, customer: str, amount: str, category: str, length: str = "1 minute",
    min_score: float = 20,
) -> DataFrame:
    """Variant with category diversity: 0.3 x count + 0.4 x total / 1000 + 0.3 x categories."""
    windows = sliding_stats(df, ts, customer, amount, length, None, unique=category, exact=True)
    score = (
        F.col("transaction_count") * 0.3 + F.col("total_amount") / 1000 * 0.4 + F.col("unique_values") * 0.3
    )
    return windows.withColumn("fraud_score", score).filter(F.col("fraud_score") > min_score)


def split_late(
    sdf: DataFrame, ts: str, by: str | Sequence[str], amount: str, delay: str = "15 minutes",
    length: str = "5 minutes", as_of: Column | None = None,
) -> DataFrame:
    """Window sums of on-time and of late rows, relative to ``as_of`` (streams: now)."""
    by = names(by)
    require(sdf, ts, *by, amount)
    event = F.col(ts).cast("timestamp") if not sdf.isStreaming else F.col(ts)
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    on_time = event >= now - F.expr(f"INTERVAL {delay}")
    out = sdf.groupBy(F.window(event, length).alias("window"), *by).agg(
        F.sum(F.when(on_time, F.col(amount))).alias("on_time_amount"),
        F.sum(F.when(~on_time, F.col(amount))).alias("late_amount"),
    )
    return _ends(out)


def dedup_stream(sdf: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Drop repeats that arrive within the watermark delay; state is bounded by it."""
    require(sdf, *names(keys))
    return sdf.dropDuplicatesWithinWatermark(names(keys)) if sdf.isStreaming else sdf.dropDuplicates(names(keys))


def safe_amounts(sdf: DataFrame, amount: str, as_of: Column | None = None) -> DataFrame:
    """Processing time, and the amount with NULL and negative values set to 0."""
    require(sdf, amount)
    return sdf.withColumns({
        "processed_timestamp": F.current_timestamp() if as_of is None else as_of,
        "amount_validated": F.when(F.col(amount).isNull() | (F.col(amount) < 0), 0.0).otherwise(F.col(amount)),
    })


def enrich(sdf: DataFrame, dim: DataFrame, on: str | Sequence[str], limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Look up a static table for each row of a stream or batch."""
    return join_dim(sdf, dim, on, "inner", limit)
