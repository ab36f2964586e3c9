"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import names, require


def pivot_sum(
    df: DataFrame, by: str | Sequence[str], pivot: str, value: str, values: Sequence
) -> DataFrame:
    """Sums with one column per listed pivot value. Listing them saves a pass over the table."""
    require(df, *names(by), pivot, value)
    return df.groupBy(*names(by)).pivot(pivot, list(values)).agg(F.sum(value))


def unpivot(
    df: DataFrame, ids: str | Sequence[str], columns: Sequence[str], variable: str, value: str
) -> DataFrame:
    """One row per (id, column) with a value; NULLs are dropped."""
    require(df, *names(ids), *columns)
    long = df.unpivot(names(ids), list(columns), variable, value)
    return long.filter(F.col(value).isNotNull())


def crosstab(df: DataFrame, a: str, b: str, b_values: Sequence) -> DataFrame:
    """Counts of each pair of values, zeros filled in; stays distributed."""
    require(df, a, b)
    counts = df.groupBy(a).pivot(b, list(b_values)).agg(F.count(F.lit(1)))
    return counts.fillna(0, subset=[str(v) for v in b_values])
