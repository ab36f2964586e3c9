"""Upserts, schema changes and as-of reads on plain tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.operators.joins import unmatched
from etlkit.runtime import names, require


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Replace matched rows, insert the others. A key that occurs twice in ``source`` is an error."""
    keys = names(keys)
    require(target, *keys)
    require(source, *target.columns)
    rest = [c for c in target.columns if c not in keys]
    once = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in rest]
    )
    # A filter stays in the plan whatever columns the reader asks for.
    single = F.when(F.col("__n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"duplicate source key in {keys}")).cast("boolean")
    )
    checked = once.filter(single).select(*target.columns)
    return unmatched(target, source, keys).select(*target.columns).unionByName(checked)


def append_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows that may bring new columns or lack old ones; gaps are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def evolve(
    df: DataFrame, renames: Mapping[str, str] | None = None, adds: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rename and add columns."""
    require(df, *(renames or {}))
    return df.withColumnsRenamed(dict(renames or {})).withColumns(dict(adds or {}))


def as_of(history: DataFrame, keys: str | Sequence[str], ts: str, at: Column, ties: Sequence[str] = ()) -> DataFrame:
    """The latest version of each key at time ``at``, from an append-only history.

    Keeping a maximum per key combines before the shuffle, so long histories stay cheap.
    """
    keys = names(keys)
    require(history, *keys, ts, *ties)
    rest = [c for c in history.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.struct(ts, *ties))
    seen = history.filter(F.col(ts) <= at)
    return seen.groupBy(*keys).agg(latest.alias("__row")).select(*keys, "__row.*").select(*history.columns)
