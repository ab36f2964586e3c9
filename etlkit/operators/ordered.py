"""Ordered work inside groups of any size.

A window partitioned by the group key alone puts a whole group in one task, so one hot key
stalls the job. Here a group is cut into ordered *cells* instead:

* ``levels`` are expressions, outermost first, that do not decrease along the ordering (the
  day, then a range of ids). A cell is one combination of key and levels.
* totals before each cell come from small per-cell aggregates, one level at a time, so every
  window runs over the cells of one parent and never over detail rows of a whole group;
* detail rows are windowed inside their cell, and the cell's prefix is added. Key and levels
  travel as one struct, so the window and the join share a single shuffle of the detail, and
  NULL keys compare equal.

Frames that look a fixed number of rows back or ahead cut the group into blocks of equal row
count and copy just the border rows into the neighbouring block. Results are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from etlkit.runtime import join_groups, materialize, names, require, settled

CELL = "__cell"
# How partial results of one measure are put together.
Combine = Callable[[Column], Column]


@dataclass(frozen=True)
class Ordering:
    """Group keys, a total order of column names, and monotone cell levels along it."""

    by: Sequence[str]
    order: Sequence[str]
    levels: Sequence[Column]
    descending: bool = False

    def __post_init__(self) -> None:
        if not self.by or not self.levels:
            raise ValueError("an ordering needs at least one key and one level")

    @property
    def level_names(self) -> list[str]:
        return [f"__level{i}" for i in range(len(self.levels))]

    def sort(self, columns: Sequence[str]) -> list[Column]:
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in columns]

    def with_cell(self, df: DataFrame) -> DataFrame:
        """Add the cell of each row as one struct column."""
        require(df, *self.by, *self.order)
        levels = [column.alias(name) for name, column in zip(self.level_names, self.levels)]
        return df.withColumn(CELL, F.struct(*self.by, *levels))

    def in_cell(self) -> WindowSpec:
        return Window.partitionBy(CELL).orderBy(*self.sort(self.order))

    def cells(self, base: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
        """Aggregates per cell, with keys and levels as columns again."""
        grouped = base.groupBy(CELL).agg(*[column.alias(name) for name, column in aggs.items()])
        return grouped.select(f"{CELL}.*", *aggs)

    def prefixes(self, cells: DataFrame, measures: Mapping[str, Combine]) -> DataFrame:
        return cell_prefixes(cells, self.by, self.level_names, measures, self.sort)

    def attach(self, base: DataFrame, per_cell: DataFrame, how: str = "left") -> DataFrame:
        """Join per-cell columns to the rows of their cell."""
        keys = [*self.by, *self.level_names]
        rest = [c for c in per_cell.columns if c not in keys]
        return base.join(per_cell.select(F.struct(*keys).alias(CELL), *rest), CELL, how)


def _combined(how: Combine, a: Column, b: Column) -> Column:
    """Combine two partial values of one measure; NULL is the empty partial."""
    if how is F.sum:
        return F.coalesce(a + b, a, b)
    return {F.max: F.greatest, F.min: F.least}[how](a, b)


def cell_prefixes(
    cells: DataFrame, by: Sequence[str], levels: Sequence[str], measures: Mapping[str, Combine],
    sort: Callable[[Sequence[str]], list[Column]],
) -> DataFrame:
    """For each cell, every measure combined over the earlier cells of the same group (NULL if none)."""
    parent = [*by, *levels[:-1]]
    earlier = (
        Window.partitionBy(*parent).orderBy(*sort(levels[-1:]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = cells.select(
        *parent, levels[-1], *[how(F.col(m)).over(earlier).alias(m) for m, how in measures.items()]
    )
    if len(levels) == 1:
        return local
    parents = cells.groupBy(*parent).agg(*[how(F.col(m)).alias(m) for m, how in measures.items()])
    outer = cell_prefixes(parents, by, levels[:-1], measures, sort)
    both = join_groups(local, outer.withColumnsRenamed({m: f"__outer_{m}" for m in measures}), parent)
    return both.select(*parent, levels[-1], *[
        _combined(how, F.col(f"__outer_{m}"), F.col(m)).alias(m) for m, how in measures.items()
    ])


def with_position(df: DataFrame, ordering: Ordering, name: str = "position") -> DataFrame:
    """Exact 1-based row number inside each group."""
    base = ordering.with_cell(df)
    cells = ordering.cells(base, {"__before": F.count(F.lit(1))})
    before = ordering.prefixes(cells, {"__before": F.sum})
    numbered = base.withColumn("__in_cell", F.row_number().over(ordering.in_cell()))
    return ordering.attach(numbered, before).withColumn(
        name, F.coalesce(F.col("__before"), F.lit(0)) + F.col("__in_cell")
    ).drop(CELL, "__before", "__in_cell")


def over_blocks(
    df: DataFrame, ordering: Ordering, before: int, after: int,
    make: Callable[[WindowSpec], Mapping[str, Column]], block: int = 1_000_000,
) -> DataFrame:
    """Evaluate frames reaching ``before`` rows back and ``after`` rows ahead, block by block.

    ``make`` gets a window ordered by position and returns the columns to add. Each block holds
    ``block`` rows of one group and the border rows its frames can see.
    """
    if block < max(before, after, 1):
        raise ValueError("block must be at least as long as the frame reaches")
    placed = with_position(df, ordering, "__pos")
    home, offset = F.expr(f"(__pos - 1) div {block}"), F.expr(f"(__pos - 1) % {block}")
    targets = F.array_compact(F.array(
        F.col("__home"),
        F.when(offset >= block - before, F.col("__home") + 1),
        F.when((offset < after) & (F.col("__home") > 0), F.col("__home") - 1),
    ))
    spread = placed.withColumn("__home", home).withColumn("__block", F.explode(targets))
    window = Window.partitionBy(*ordering.by, "__block").orderBy("__pos")
    return (
        spread.withColumns(dict(make(window)))
        .filter(F.col("__block") == F.col("__home"))
        .drop("__pos", "__home", "__block")
    )


def running(df: DataFrame, ordering: Ordering, value: str) -> DataFrame:
    """Running total, count, average, maximum and share of the group total, row by row."""
    require(df, value)
    base = ordering.with_cell(df)
    v = F.col(value)
    measures = {"__sum": F.sum, "__count": F.sum, "__max": F.max}
    cells = ordering.cells(base, {"__sum": F.sum(v), "__count": F.count(v), "__max": F.max(v)})
    totals = cells.groupBy(*ordering.by).agg(F.sum("__sum").alias("__all"))
    per_cell = join_groups(ordering.prefixes(cells, measures), totals, ordering.by)
    frame = ordering.in_cell().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    framed = base.withColumns({
        "running_total": F.sum(v).over(frame),
        "running_count": F.count(v).over(frame),
        "running_max": F.max(v).over(frame),
    })
    rows = ordering.attach(framed, per_cell).withColumns({
        "running_total": _combined(F.sum, F.col("__sum"), F.col("running_total")),
        "running_count": _combined(F.sum, F.col("__count"), F.col("running_count")),
        "running_max": F.greatest("__max", "running_max"),
    })
    return rows.withColumns({
        "running_avg": F.try_divide("running_total", "running_count"),
        "cumulative_pct": F.try_divide(F.col("running_total") * 100, F.col("__all")),
    }).drop(CELL, "__sum", "__count", "__max", "__all")


def rankings(
    df: DataFrame, by: str | Sequence[str], order: str, ties: Sequence[str],
    coarse: Sequence[Column] = (), fine: Sequence[Column] = (), buckets: int = 4,
    descending: bool = False,
) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank, cume_dist and ntile over ``order``.

    Ranks need only the number of rows per distinct ``order`` value, so they come from that
    small table. ``ties`` makes the row number unique; ``coarse`` levels lie above ``order`` and
    ``fine`` levels below it, for groups or single values that hold very many rows.
    """
    by = names(by)
    require(df, *by, order, *ties)
    inner = Ordering([*by, order], ties, fine or [F.lit(0)], descending)
    base = inner.with_cell(df)
    # Written, as it is read several times: the rows themselves are counted once.
    cells = materialize(inner.cells(base, {"__rows": F.count(F.lit(1))}), "cells")

    above = {f"__coarse{i}": column for i, column in enumerate(coarse)}
    peers = cells.withColumns(above).groupBy(*by, *above, order).agg(F.sum("__rows").alias("__rows"))
    peers = peers.withColumn("__values", F.lit(1).cast("long"))
    before = cell_prefixes(peers, by, [*above, order], {"__rows": F.sum, "__values": F.sum}, inner.sort)
    before = before.withColumnsRenamed({"__rows": "__rows_before", "__values": "__values_before"}).drop(*above)
    totals = peers.groupBy(*by).agg(F.sum("__rows").alias("__n"))
    ranks = join_groups(join_groups(peers.drop(*above), before, [*by, order]), totals, by).select(
        *by, order, "__n", "__rows",
        (F.coalesce("__rows_before", F.lit(0)) + 1).alias("rank"),
        (F.coalesce("__values_before", F.lit(0)) + 1).alias("dense_rank"),
    ).withColumnRenamed("__rows", "__peers")

    inside = inner.prefixes(cells, {"__rows": F.sum})
    # Small where values repeat; else rows meet it on plain columns, the one with the most values first, which sort fast.
    per_cell = settled(join_groups(inside, ranks, [*by, order]))
    numbered = base.withColumn("__in_cell", F.row_number().over(inner.in_cell()))
    numbered = numbered.withColumns({name: F.col(CELL)[name] for name in inner.level_names})
    rows = join_groups(numbered, per_cell, [order, *by, *inner.level_names]).withColumns({
        "percent_rank": F.when(F.col("__n") == 1, 0.0).otherwise((F.col("rank") - 1) / (F.col("__n") - 1)),
        "cume_dist": (F.col("rank") - 1 + F.col("__peers")) / F.col("__n"),
        "row_number": F.col("rank") - 1 + F.coalesce("__rows", F.lit(0)) + F.col("__in_cell"),
    })
    at, each, extra = F.col("row_number") - 1, F.expr(f"__n div {buckets}"), F.expr(f"__n % {buckets}")
    wide = extra * (each + 1)
    tile = F.when(at < wide, F.floor(at / (each + 1))).otherwise(
        extra + F.floor(F.try_divide(at - wide, each))
    )
    return rows.withColumn("ntile", (tile + 1).cast("int")).drop(CELL, "__rows", "__peers", "__in_cell", "__n", *inner.level_names)


def search_tree(value: Column, bounds: Sequence[float], low: int, high: int) -> Column:
    """How many of ``bounds[low:high]`` are below ``value``, plus ``low``, by binary search."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value > F.lit(bounds[middle]), search_tree(value, bounds, middle + 1, high)).otherwise(
        search_tree(value, bounds, low, middle)
    )
