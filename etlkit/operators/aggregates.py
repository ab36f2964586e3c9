"""Grouped aggregation. Map-side combine does the heavy lifting; nothing gathers a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.functions.values import hash_below, salt
from etlkit.operators.ordered import CELL, Ordering, search_tree
from etlkit.runtime import join_groups, names, require

Aggs = Mapping[str, Column]


def _named(aggs: Aggs) -> list[Column]:
    if not aggs:
        raise ValueError("at least one aggregate is needed")
    return [column.alias(name) for name, column in aggs.items()]


def summarise(df: DataFrame, by: str | Sequence[str], aggs: Aggs) -> DataFrame:
    """One row per group; one row in all when ``by`` is empty."""
    require(df, *names(by))
    return df.groupBy(*names(by)).agg(*_named(aggs))


def rollup_summary(df: DataFrame, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """Subtotals along a hierarchy. ``level`` tells a subtotal from a group whose key is NULL."""
    require(df, *keys)
    return df.rollup(*keys).agg(*_named(aggs), F.grouping_id().cast("int").alias("level"))


def cube_summary(df: DataFrame, keys: Sequence[str], aggs: Aggs) -> DataFrame:
    """Subtotals for every combination of keys; all-NULL aggregates are left out."""
    require(df, *keys)
    first = next(iter(aggs))
    out = df.cube(*keys).agg(*_named(aggs), F.grouping_id().cast("int").alias("level"))
    return out.filter(F.col(first).isNotNull())


def salted_agg(
    df: DataFrame, key: str, value: str, row_id: Sequence[str], salts: int = 32
) -> DataFrame:
    """sum, count, avg, min and max per key in two steps, first per (key, salt)."""
    require(df, key, value, *row_id)
    parts = df.withColumn("__salt", salt([F.col(c) for c in row_id], salts)).groupBy(key, "__salt").agg(
        F.sum(value).alias("__sum"), F.count(value).alias("__count"),
        F.min(value).alias("__min"), F.max(value).alias("__max"),
    )
    return parts.groupBy(key).agg(
        F.sum("__sum").alias("total"), F.sum("__count").alias("rows"),
        F.min("__min").alias("low"), F.max("__max").alias("high"),
    ).withColumn("mean", F.try_divide("total", "rows"))


def value_levels(df: DataFrame, column: str, parts: int = 256) -> list[Column]:
    """Levels that do not decrease along a column: quantile ranges of numbers and times, longer and longer prefixes of text.

    The ``parts - 1`` quantiles are the only values read back.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return [F.substring(column, 1, n) for n in (4, 12, 32)]
    if isinstance(kind, T.BooleanType):
        return [F.col(column).cast("int")]
    if isinstance(kind, T.DateType):
        value = F.unix_date(column).cast("double")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    elif isinstance(kind, T.NumericType):
        value = F.col(column).cast("double")
    else:
        raise ValueError(f"name the levels of {column!r}: {kind.simpleString()} values have no ranges")
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.percentile_approx(value, shares, 10 * parts)).first()[0]
    bounds = sorted(set(bounds or []))
    return [search_tree(value, bounds, 0, len(bounds))]


def collect(
    df: DataFrame, by: str | Sequence[str], column: str, ordering_levels: Sequence[Column] = (),
    distinct: bool = False, page: int = 100_000,
) -> DataFrame:
    """All values of a group in sorted order, as numbered pages of at most ``page`` values.

    Together the pages are the whole (or distinct) list; a group that fits one page is one row.
    Equal values are counted before the shuffle and repeated inside their page only.
    """
    by = names(by)
    require(df, *by, column)
    counts = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(
        (F.lit(1).cast("long") if distinct else F.count(F.lit(1))).alias("__n")
    )
    levels = ordering_levels or value_levels(df, column)
    ordering = Ordering(by, [column], levels)
    base = ordering.with_cell(counts)
    before = ordering.prefixes(ordering.cells(base, {"__before": F.sum("__n")}), {"__before": F.sum})
    in_cell = ordering.in_cell().rowsBetween(Window.unboundedPreceding, -1)
    rows = ordering.attach(base.withColumn("__inside", F.sum("__n").over(in_cell)), before).withColumn(
        "__start", F.coalesce(F.col("__before"), F.lit(0)) + F.coalesce(F.col("__inside"), F.lit(0))
    )
    # A value repeated n times covers positions start .. start + n - 1, possibly over many pages.
    first, last = F.expr(f"__start div {page}"), F.expr(f"(__start + __n - 1) div {page}")
    pages = rows.withColumn("page", F.explode(F.sequence(first, last))).withColumn(
        "__take",
        F.least(F.col("__start") + F.col("__n"), (F.col("page") + 1) * page)
        - F.greatest(F.col("__start"), F.col("page") * page),
    )
    runs = pages.groupBy(*by, "page").agg(F.sort_array(F.collect_list(
        F.struct(F.col(column).alias("v"), F.col("__take").cast("int").alias("n"))
    )).alias("__runs"))
    repeated = F.flatten(F.transform("__runs", lambda r: F.array_repeat(r["v"], r["n"])))
    return runs.select(*by, "page", repeated.alias("values"))


def moments(df: DataFrame, by: str | Sequence[str], column: str) -> DataFrame:
    """Sample stddev and variance, population skewness and excess kurtosis."""
    return summarise(df, by, {
        "stddev": F.stddev(column), "variance": F.variance(column),
        "skewness": F.skewness(column), "kurtosis": F.kurtosis(column),
    })


def percentiles(
    df: DataFrame, by: str | Sequence[str], column: str, ps: Mapping[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Approximate percentiles: actual values whose rank is within n / accuracy of the target."""
    return summarise(df, by, {
        name: F.percentile_approx(column, p, accuracy) for name, p in ps.items()
    })


def quantiles(df: DataFrame, column: str, ps: Sequence[float], error: float = 0.0001) -> DataFrame:
    """Approximate quantiles of one column at a chosen relative error, one row per quantile."""
    require(df, column)
    made = df.agg(F.percentile_approx(column, list(ps), round(1 / error)).alias("v"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in ps]).alias("p"), F.col("v").alias("v"))
    return made.select(F.explode(pairs).alias("q")).select(
        F.col("q.p").alias("quantile"), F.col("q.v").alias("value")
    )


def exact_percentiles(
    df: DataFrame, by: str | Sequence[str], column: str, ps: Sequence[float], levels: Sequence[Column]
) -> DataFrame:
    """Interpolated percentiles without holding a group's values in one place.

    Rows are counted per cell of ``levels``, which shows the cells that hold the wanted ranks. In
    those cells alone equal values are counted before the shuffle and the counts summed along the
    values. No row of ``df`` is sorted, and a value that repeats is one row however often it does.
    """
    by = names(by)
    require(df, *by, column)
    ordering = Ordering(by, [column], levels)
    base = ordering.with_cell(df.filter(F.col(column).isNotNull())).select(CELL, column)
    cells = ordering.cells(base, {"__before": F.count(F.lit(1))})
    totals = cells.groupBy(*by).agg(F.sum("__before").alias("__all"))
    keys = [*by, *ordering.level_names]
    per_cell = join_groups(cells.withColumnRenamed("__before", "__rows"), ordering.prefixes(cells, {"__before": F.sum}), keys)
    per_cell = join_groups(per_cell, totals, by).withColumn("__before", F.coalesce("__before", F.lit(0)))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("__all") - 1)).alias("rank")) for p in ps])

    def hits(start: Column, rows: Column) -> Column:
        held = lambda k: (k >= start) & (k < start + rows)
        return F.filter(wanted, lambda w: held(F.floor(w["rank"])) | held(F.ceil(w["rank"])))

    needed = per_cell.filter(F.size(hits(F.col("__before"), F.col("__rows"))) > 0).select(*keys, "__before", "__all")
    counts = ordering.attach(base, needed, "inner").groupBy(CELL, column, "__before", "__all").agg(F.count(F.lit(1)).alias("__n"))
    earlier = ordering.in_cell().rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumn("__start", F.col("__before") + F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    found = rows.select(
        *[F.col(f"{CELL}.{k}").alias(k) for k in by], F.col(column).cast("double").alias("__value"),
        F.explode(hits(F.col("__start"), F.col("__n"))).alias("__hit"))
    low, high = F.min("__value"), F.max("__value")
    part = F.max(F.col("__hit.rank") - F.floor("__hit.rank"))
    return found.groupBy(*by, F.col("__hit.p").alias("p")).agg((low + (high - low) * part).alias("value"))


def approx_profile(df: DataFrame, by: str | Sequence[str], key: str, value: str) -> DataFrame:
    """Approximate distinct keys and approximate median, from fixed-size sketches."""
    return summarise(df, by, {
        "approx_distinct": F.approx_count_distinct(key), "approx_median": F.percentile_approx(value, 0.5),
    })


def estimate_total(
    df: DataFrame, by: str | Sequence[str], value: str, key: Sequence[str], fraction: float = 0.1
) -> DataFrame:
    """Totals estimated from a fixed sample of keys."""
    require(df, *key)
    kept = df.filter(hash_below([F.col(c) for c in key], fraction))
    return summarise(kept, by, {"estimated_total": F.sum(value) / fraction})


def preaggregate(
    df: DataFrame, fine: Sequence[str], coarse: Mapping[str, Column], value: str
) -> DataFrame:
    """Sum at a fine grain, then sum those sums by expressions over the fine keys."""
    require(df, *fine, value)
    small = df.groupBy(*fine).agg(F.sum(value).alias("__part"))
    return small.groupBy(*[c.alias(n) for n, c in coarse.items()]).agg(F.sum("__part").alias("total"))


def by_period(df: DataFrame, ts: str, unit: str, aggs: Aggs, by: Sequence[str] = ()) -> DataFrame:
    """Aggregates per day, week (Monday start), month, quarter or year."""
    units = ("day", "week", "month", "quarter", "year")
    if unit not in units:
        raise ValueError(f"unit must be one of {units}")
    require(df, ts, *by)
    start = F.to_date(F.col(ts)) if unit == "day" else F.trunc(F.to_date(F.col(ts)), unit)
    return df.groupBy(start.alias("period"), *by).agg(*_named(aggs))


def by_calendar_week(df: DataFrame, ts: str, aggs: Aggs) -> DataFrame:
    """Per calendar year and ISO week number, a pairing that joins early and late weeks of a year."""
    require(df, ts)
    return df.groupBy(F.year(ts).alias("year"), F.weekofyear(ts).alias("week")).agg(*_named(aggs))


def monthly_trend(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Monthly sums, their three-month moving average and the distance from it in percent.

    The ordered window runs over the months, not over the rows.
    """
    months = by_period(df, ts, "month", {"monthly_total": F.sum(value)})
    recent = Window.orderBy("period").rowsBetween(-2, Window.currentRow)
    return months.withColumn("moving_avg_3", F.avg("monthly_total").over(recent)).withColumn(
        "trend_pct",
        F.try_divide((F.col("monthly_total") - F.col("moving_avg_3")) * 100, F.col("moving_avg_3")),
    )


def yoy(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Growth over the same month a year before; a missing month gives NULL, not a shifted one."""
    months = by_period(df, ts, "month", {"monthly_total": F.sum(value)})
    previous = months.select(
        F.add_months("period", 12).alias("period"), F.col("monthly_total").alias("prev_year_total")
    )
    return months.join(previous, "period", "left").withColumn(
        "yoy_growth",
        F.try_divide((F.col("monthly_total") - F.col("prev_year_total")) * 100, F.col("prev_year_total")),
    )


