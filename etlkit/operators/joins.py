"""Joins: dimension lookups, hot-key joins, semi/anti joins and interval joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.operators.windows import with_group_stats
from etlkit.runtime import BROADCAST_LIMIT, all_of, broadcast_if_small, is_small, names, require

STRATEGIES = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")


def join_dim(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Lookup join. The dimension is broadcast only when a size under ``limit`` is known."""
    return fact.join(broadcast_if_small(dim, limit), names(on), how)


def join_pruned(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Join a partitioned fact with a filtered dimension on partition columns; only matching partitions are read.

    Spark builds the filter of partitions at run time from the broadcast dimension, so this needs a
    dimension of a known small size and a filter on it; otherwise it is a plain join, with the same rows.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("partitions can be pruned by inner and left_semi joins")
    return join_dim(fact, dim, on, how, limit)


def join_with(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], strategy: str, how: str = "inner",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Equi-join with a named physical strategy; a broadcast above ``limit`` bytes becomes a shuffle."""
    if strategy not in STRATEGIES[:3]:
        raise ValueError(f"strategy must be one of {STRATEGIES[:3]}")
    if strategy == "broadcast" and not is_small(right, limit):
        strategy = "merge"
    return left.join(right.hint(strategy), names(on), how)


def join_chain(first: DataFrame, *rest: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Inner joins in the order given, smallest first."""
    out = first
    for df, on in rest:
        out = out.join(df, names(on))
    return out


def star_join(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str]]], how: str = "inner",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """A fact and its dimensions. Clashing names must be renamed by the caller."""
    seen = set(fact.columns)
    out = fact
    for dim, on in dims:
        clash = (set(dim.columns) - set(names(on))) & seen
        if clash:
            raise ValueError(f"rename before joining: {sorted(clash)}")
        seen |= set(dim.columns)
        out = join_dim(out, dim, on, how, limit)
    return out


def hot_keys(df: DataFrame, key: str, share: float, tracked: int = 20_000) -> dict:
    """Keys that hold more than ``share`` of all rows, with their estimated row counts.

    One map-side pass over the key column keeps a frequent-items sketch of ``tracked`` keys a task;
    what reaches the driver is at most ``1 / share`` keys. The sketch never misses a key above
    ``1 / tracked`` of the rows; a count may be off by that much.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    require(df, key)
    most = int(1 / share) + 1
    kind = df.schema[key].dataType
    named = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.BinaryType)):
        raise ValueError("a hot key is a number, text, date or flag")
    row = named.agg(F.expr(f"approx_top_k(k, {most}, {max(tracked, 2 * most)})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {r["item"]: r["count"] for r in row.top or [] if r["count"] > row.n * share}


def copartitioned_join(
    left: DataFrame, right: DataFrame, key: str, row_id: Sequence[str], n: int | None = None,
    how: str = "inner", share: float = 0.005, rows_per_salt: int = 100_000, most_salts: int = 10_000,
) -> DataFrame:
    """Join both sides partitioned alike on ``key``, with hot keys of ``left`` split by their size.

    ``row_id`` tells rows of ``left`` apart. A key above ``share`` of all rows gets a salt for every
    ``rows_per_salt`` of its rows (two at least, ``most_salts`` at most), and the rows of ``right``
    that match it are repeated once per salt. The list has at most ``1 / share`` keys and is part of
    the plan, so ``left`` is read twice: for the sketch and for the join. Every row is kept: salting
    changes where a pair is made, not whether.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the left side may be split: use inner, left, left_semi or left_anti")
    require(left, key, *row_id)
    require(right, key)
    hot = {k: min(most_salts, max(2, -(-rows // rows_per_salt))) for k, rows in hot_keys(left, key, share).items()}
    if not hot:
        a, b = (left.repartition(n, key), right.repartition(n, key)) if n is not None else (left, right)
        return a.join(b.hint("merge"), key, how)
    lookup = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    salts = F.coalesce(F.element_at(lookup, F.col(key)), F.lit(1))
    # NULL keys never match, so they may be spread over any salts.
    ways = F.when(F.col(key).isNull(), F.lit(1024)).otherwise(salts)
    a = left.withColumn("__salt", F.pmod(F.xxhash64(*row_id), ways).cast("int"))
    b = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))
    if n is not None:
        a, b = a.repartition(n, key, "__salt"), b.repartition(n, key, "__salt")
    return a.join(b.hint("merge"), [key, "__salt"], how).drop("__salt")


def join_auto(
    left: DataFrame, right: DataFrame, key: str, row_id: Sequence[str], limit: int = BROADCAST_LIMIT,
    how: str = "inner",
) -> DataFrame:
    """Broadcast a right side that is known to be small; otherwise split hot keys."""
    if is_small(right, limit):
        return left.join(F.broadcast(right), key, how)
    return copartitioned_join(left, right, key, row_id, how=how)


def bucketed_join(
    spark: SparkSession, left: str, right: str, key: str, how: str = "inner"
) -> DataFrame:
    """Join two catalog tables bucketed alike on ``key``: neither side is shuffled."""
    return spark.table(left).join(spark.table(right).hint("merge"), key, how)


def bucketed_join_split(
    spark: SparkSession, left: str, right: str, key: str, row_id: Sequence[str], how: str = "inner", share: float = 0.005, **options,
) -> DataFrame:
    """``bucketed_join`` for keys that may be very frequent in ``left``.

    A bucket is one task, so a hot key makes a hot task. Keys above ``share`` of the rows are taken out of both sides
    and joined with salts (``copartitioned_join``); all other keys still join bucket by bucket
    without an exchange. The list has at most ``1 / share`` keys. Rows with a NULL key are cold.
    """
    a, b = spark.table(left), spark.table(right)
    hot = list(hot_keys(a, key, share))
    if not hot:
        return bucketed_join(spark, left, right, key, how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only the left side may be split: use inner, left, left_semi or left_anti")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    cold = a.filter(~is_hot).join(b.filter(~is_hot).hint("merge"), key, how)
    split = copartitioned_join(a.filter(is_hot), b.filter(is_hot), key, row_id, how=how, share=share, **options)
    return cold.unionByName(split)


def deviation_from_group(
    df: DataFrame, by: str | Sequence[str], value: str, avg: str = "group_avg", name: str = "deviation"
) -> DataFrame:
    """Each row's distance from the average of its group."""
    rows = with_group_stats(df, by, {avg: F.avg(value)}, few=True)
    return rows.withColumn(name, F.abs(F.col(value) - F.col(avg)))


def matched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with a match (EXISTS, IN)."""
    return left.join(right.select(*names(on)), names(on), "left_semi")


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a match (NOT EXISTS); rows with a NULL key are kept."""
    return left.join(right.select(*names(on)), names(on), "left_anti")


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
    before: int, after: int, how: str = "inner",
) -> DataFrame:
    """Pairs with equal ``key`` and ``right_ts`` within [left_ts - before, left_ts + after] seconds.

    Works on batch frames and on watermarked streams. Column names of the two sides differ except
    for ``key``. Rows meet on (key, stretch of time), not on the key alone, so pairs far apart in
    time are never formed and one busy key is spread over many tasks (and state partitions).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    clash = (set(left.columns) & set(right.columns)) - {key}
    if clash:
        raise ValueError(f"rename before joining: {sorted(clash)}")
    require(left, key, left_ts)
    require(right, key, right_ts)
    width = max(before + after, 1)

    def stretch(ts: str, shift: int) -> Column:
        seconds = F.unix_micros(F.col(ts).cast("timestamp")) + F.lit(shift * 1_000_000)
        return F.floor(seconds / (width * 1_000_000)).cast("long")

    # A left row looks at one span of time; it is at most one stretch long and so starts in the
    # stretch of its lower end. A right row is offered to that stretch and the one before.
    a = left.withColumn("__slot", stretch(left_ts, -before))
    b = right.withColumnRenamed(key, "__key").withColumn(
        "__rslot", F.explode(F.array(stretch(right_ts, 0), stretch(right_ts, 0) - 1))
    )
    on = all_of([
        F.col(key) == F.col("__key"),
        F.col("__slot") == F.col("__rslot"),
        F.col(right_ts) >= F.col(left_ts) - F.expr(f"INTERVAL {before} SECONDS"),
        F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {after} SECONDS"),
    ])
    return a.join(b, on, "leftOuter" if how == "left" else "inner").drop("__slot", "__rslot", "__key")
