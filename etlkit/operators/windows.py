"""Window results on detail rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etlkit.operators.ordered import Ordering, over_blocks, rankings, running
from etlkit.runtime import join_groups, materialize, names, require, settled

__all__ = [
    "Ordering", "deltas", "first_last", "moving", "moving_range", "rankings", "running",
    "with_group_stats", "zscore",
]


def with_group_stats(
    df: DataFrame, by: str | Sequence[str], stats: Mapping[str, Column], few: bool = False
) -> DataFrame:
    """Group aggregates on every detail row: aggregate with map-side combine, then join back.

    Say ``few`` where groups are few and large: they are written first, so that their size is known when the
    join is planned, and a shuffle does not deal all rows to a few tasks. Right for any number of groups.
    """
    by = names(by)
    require(df, *by)
    groups = df.groupBy(*by).agg(*[column.alias(name) for name, column in stats.items()])
    return join_groups(df, settled(groups) if few else groups, by)


def zscore(df: DataFrame, by: str | Sequence[str], value: str, name: str = "z_score", few: bool = False) -> DataFrame:
    """``(x - avg) / stddev`` per group; NULL for one-row groups and for zero spread. ``few`` as for ``with_group_stats``."""
    stats = {"__avg": F.avg(value), "__std": F.stddev(value)}
    rows = with_group_stats(df, by, stats, few)
    return rows.withColumn(
        name, F.try_divide(F.col(value) - F.col("__avg"), F.col("__std"))
    ).drop("__avg", "__std")


def deltas(df: DataFrame, ordering: Ordering, value: str, block: int = 1_000_000) -> DataFrame:
    """Previous, next and second previous value, change, change in percent and trend."""
    require(df, value)

    def make(w):
        return {
            "prev_value": F.lag(value, 1).over(w),
            "next_value": F.lead(value, 1).over(w),
            "prev_2_value": F.lag(value, 2).over(w),
        }

    change = F.col(value) - F.col("prev_value")
    return over_blocks(df, ordering, 2, 1, make, block).withColumns({
        "change": change,
        "change_pct": F.try_divide(change * 100, F.col("prev_value")),
        "trend": F.when(change > 0, "increasing").when(change < 0, "decreasing").otherwise("stable"),
    })


def moving(
    df: DataFrame, ordering: Ordering, frames: Mapping[str, tuple[str, str, int]],
    block: int = 1_000_000,
) -> DataFrame:
    """Aggregates over the last n rows. ``frames`` maps a name to (function, column, n)."""
    functions = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "stddev": F.stddev}
    for name, (fn, column, n) in frames.items():
        require(df, column)
        if fn not in functions or n < 1:
            raise ValueError(f"frame {name!r}: function must be one of {sorted(functions)}, n >= 1")

    def make(w):
        return {
            name: functions[fn](column).over(w.rowsBetween(-(n - 1), Window.currentRow))
            for name, (fn, column, n) in frames.items()
        }

    reach = max(n - 1 for _, _, n in frames.values())
    return over_blocks(df, ordering, reach, 0, make, block)


def first_last(
    df: DataFrame, by: str | Sequence[str], order: Sequence[str], value: str, frame: str = "all"
) -> DataFrame:
    """First and last value of the group along ``order`` (its first column may tie).

    ``frame='all'`` spans the group. ``frame='peers'`` ends at the rows that tie with the current
    one on the first order column, as SQL's default frame does.
    """
    by, order = names(by), list(order)
    require(df, *by, *order, value)
    along = F.struct(*order)
    first = {"first_value": F.min_by(value, along)}
    last = {"last_value": F.max_by(value, along)}
    if frame == "all":
        return with_group_stats(df, by, {**first, **last}, few=True)
    if frame != "peers":
        raise ValueError("frame must be 'all' or 'peers'")
    # The first of a group is the first of its first peers.
    peers = materialize(df.groupBy(*by, order[0]).agg(*[column.alias(name) for name, column in {**first, **last}.items()]), "peers")
    firsts = peers.groupBy(*by).agg(F.min_by("first_value", F.struct(order[0])).alias("first_value"))
    return join_groups(df, settled(join_groups(peers.drop("first_value"), firsts, by)), [*by, order[0]])


def moving_range(
    df: DataFrame, by: str | Sequence[str], ts: str, seconds: int, stats: Mapping[str, Column]
) -> DataFrame:
    """Aggregates over the rows of the last ``seconds`` up to and including the current time.

    Time is cut into stretches one frame long. A row is also copied into the next stretch, so each
    window runs over one key and two stretches, never over a whole key. Rows without a time see each
    other, as they do in a SQL window. Any aggregate goes, but Spark sums up each row's frame anew: where frames
    hold many rows, ``moving_range_split`` takes sums, counts, averages and extremes.
    """
    by = names(by)
    require(df, *by, ts)
    micros = seconds * 1_000_000
    stretch = F.floor(F.col("__at") / micros).cast("long")
    rows = (
        df.withColumn("__at", F.unix_micros(F.col(ts).cast("timestamp")))
        .withColumn("__home", stretch)
        .withColumn("__block", F.explode(F.when(F.col("__home").isNull(), F.array(F.lit(None).cast("long"))).otherwise(
            F.array(F.col("__home"), F.col("__home") + 1))))
    )
    frame = Window.partitionBy(*by, "__block").orderBy("__at").rangeBetween(-micros, 0)
    return (
        rows.withColumns({name: column.over(frame) for name, column in stats.items()})
        .filter(F.col("__block").eqNullSafe(F.col("__home")))
        .drop("__at", "__home", "__block")
    )


# Aggregates whose value over a frame follows from the values of its pieces: parts of each, how parts
# are made from rows, how parts are put together, and the value.
_PIECEWISE = {
    "sum": (("sum",), lambda p: p[0]),
    "count": (("count",), lambda p: F.coalesce(p[0], F.lit(0))),
    "avg": (("sum", "count"), lambda p: F.try_divide(p[0], p[1])),
    "min": (("min",), lambda p: p[0]),
    "max": (("max",), lambda p: p[0]),
}
_MADE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_JOINED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _together(kind: str, parts: Sequence[Column]) -> Column:
    """One value of the pieces, of which some may be empty (NULL)."""
    if kind == "min":
        return F.least(*parts)
    if kind == "max":
        return F.greatest(*parts)
    some = F.lit(False)
    for p in parts:
        some = some | p.isNotNull()
    return F.when(some, sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0))))


def cell_seconds(df: DataFrame, by: str | Sequence[str], ts: str, seconds: int, rows: int, halvings: int = 16) -> float:
    """The longest of ``seconds``, a half, a quarter and so on for which no cell of a key holds more than ``rows`` rows.

    Rows are counted once, in the shortest cells; longer ones are sums of these. Where even the
    shortest hold more, as when very many rows share one time, they are taken.
    """
    by = names(by)
    micros = seconds * 1_000_000
    finest = max(1, micros >> halvings)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    counts = df.filter(at.isNotNull()).withColumn("__c", F.floor(at / finest).cast("long")).groupBy(*by, "__c").agg(F.count(F.lit(1)).alias("__n"))
    levels = counts.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(halvings))))
    levels = levels.groupBy(*by, "__k", F.floor(F.col("__c") / F.expr("shiftleft(1L, __k)")).alias("__c")).agg(F.sum("__n").alias("__n"))
    most = {r["__k"]: r["n"] for r in levels.groupBy("__k").agg(F.max("__n").alias("n")).collect()}
    fitting = [k for k, n in most.items() if n <= rows]
    return finest * 2 ** max(fitting, default=0) / 1_000_000


def moving_range_split(
    df: DataFrame, by: str | Sequence[str], ts: str, seconds: int, frames: Mapping[str, tuple[str, str]], rows: int = 1_000_000,
) -> DataFrame:
    """``moving_range`` for keys that hold very many rows within one frame. ``frames`` maps a name to (function, column).

    Functions are sum, count, avg, min and max. A key's time is cut in cells of at most ``rows`` rows
    (``cell_seconds``). The frame of a row is the end of one cell, whole cells, and the beginning of
    its own: running aggregates forward in a cell give the beginnings, running aggregates backward, with the row's frame
    start placed among the cell's rows, give the ends, and whole cells come from one row per key and
    cell. No window holds more than the rows of a cell and the frame starts that fall in it. Rows without a time see each other.
    """
    by = names(by)
    require(df, *by, ts, *[c for _, c in frames.values()])
    unknown = {fn for fn, _ in frames.values()} - set(_PIECEWISE)
    if unknown:
        raise ValueError(f"functions must be among {sorted(_PIECEWISE)}, not {sorted(unknown)}")
    if not frames or seconds <= 0:
        raise ValueError("give frames and a positive length")
    parts = sorted({(kind, column) for fn, column in frames.values() for kind in _PIECEWISE[fn][0]})
    name = {part: f"__p{k}" for k, part in enumerate(parts)}
    micros, cell = seconds * 1_000_000, max(1, int(cell_seconds(df, by, ts, seconds, rows) * 1_000_000))
    # Whole cells between the one a frame starts in and the row's own: one count or one more.
    whole = micros // cell
    placed = df.withColumn("__at", F.unix_micros(F.col(ts).cast("timestamp"))).withColumn("__cell", F.floor(F.col("__at") / cell).cast("long"))
    timed = placed.filter("__at IS NOT NULL")

    made = {(kind, c): _MADE[kind](c) for kind, c in parts}
    totals = timed.groupBy(*by, "__cell").agg(*[made[p].alias(name[p]) for p in parts])
    along = Window.partitionBy(*by).orderBy("__cell")
    between = {}
    for p in parts:
        for extra in (0, 1):
            reach = whole - 1 + extra
            value = _JOINED[p[0]](name[p]).over(along.rangeBetween(-reach, -1)) if reach > 0 else F.lit(None)
            between[f"{name[p]}_m{extra}"] = value.cast(totals.schema[name[p]].dataType)
    # The rows of one key in this window are its cells, not its detail.
    middles = totals.select(*by, "__cell", *[v.alias(n) for n, v in between.items()])

    forward = Window.partitionBy(*by, "__cell").orderBy("__at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    beginnings = timed.withColumns({f"{name[p]}_b": made[p].over(forward) for p in parts})
    beginnings = join_groups(beginnings, middles, [*by, "__cell"])
    start_cell = F.floor((F.col("__at") - micros) / cell).cast("long")
    beginnings = beginnings.withColumn("__from", start_cell)
    middle = {f"{name[p]}_m": F.when(F.col("__from") < F.col("__cell") - whole, F.col(f"{name[p]}_m1")).otherwise(F.col(f"{name[p]}_m0")) for p in parts}
    asked = beginnings.withColumns(middle).drop(*between)
    rest = [c for c in asked.columns if c not in (*by, "__cell", "__at", "__from")]
    # Detail of a cell and the frame starts that fall in it, latest first: what stands before a start is its end of the cell.
    carried = F.struct(*rest, F.col("__at").alias("__own"), F.col("__cell").alias("__home"))
    queries = asked.select(*by, F.col("__from").alias("__cell"), (F.col("__at") - micros).alias("__at"), carried.alias("__row"), *[
        F.lit(None).cast(df.schema[c].dataType).alias(f"__v{k}") for k, c in enumerate(sorted({c for _, c in parts}))])
    columns = sorted({c for _, c in parts})
    detail = timed.select(*by, "__cell", "__at", F.lit(None).cast(queries.schema["__row"].dataType).alias("__row"), *[F.col(c).alias(f"__v{k}") for k, c in enumerate(columns)])
    backward = Window.partitionBy(*by, "__cell").orderBy(F.col("__at").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    value_of = {c: f"__v{k}" for k, c in enumerate(columns)}
    is_detail = F.col("__row").isNull()
    ends = {f"{name[p]}_e": (F.count(F.when(is_detail, F.col(value_of[p[1]]))) if p[0] == "count" else _MADE[p[0]](value_of[p[1]])).over(backward) for p in parts}
    answered = detail.unionByName(queries).withColumns(ends).filter(~is_detail).select(*by, "__row.*", *ends)
    # Cells are never longer than the frame, so a frame never starts in the row's own cell.
    pieces = {p: _together(p[0], [F.col(f"{name[p]}_{part}") for part in ("e", "m", "b")]) for p in parts}
    found = answered.withColumns({n: _PIECEWISE[fn][1]([pieces[k, c] for k in _PIECEWISE[fn][0]]) for n, (fn, c) in frames.items()})
    untimed = with_group_stats(placed.filter("__at IS NULL"), by, {n: _MADE.get(fn, F.avg)(c) for n, (fn, c) in frames.items()})
    kept = [*df.columns, *frames]
    return found.select(*kept).unionByName(untimed.select(*kept))
