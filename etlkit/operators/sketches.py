"""Sketches that are stored per period and put together without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import names, require

# Standard error of a distinct count with 2^12 registers is 1.04 / 2^6; ranks of a quantile sketch of 200 are within 1.7 %.
REGISTERS_LOG2, QUANTILE_SIZE = 12, 200
RANK_ERROR = 0.0175


def sketched(df: DataFrame, by: str | Sequence[str], key: str, value: str, registers_log2: int = REGISTERS_LOG2, size: int = QUANTILE_SIZE) -> DataFrame:
    """Rows, a distinct sketch of ``key`` and a quantile sketch of ``value`` for each group, a few KB each.

    Nulls are in the rows alone. Both sketches combine before the shuffle.
    """
    by = names(by)
    require(df, *by, key, value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(F.col(key).cast("string"), registers_log2).alias("keys"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("values"))


def rolled_up(sketches: DataFrame, by: Sequence[Column] | Column) -> DataFrame:
    """Sketches of coarser groups from those of finer ones; ``by`` are columns made from theirs."""
    by = [by] if isinstance(by, Column) else list(by)
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("keys").alias("keys"), F.kll_merge_agg_double("values").alias("values"))


def estimates(sketches: DataFrame, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Groups with their rows, estimated distinct keys and quantiles (an array in the order asked); sketches are dropped."""
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    rest = [c for c in sketches.columns if c not in ("keys", "values")]
    some = F.kll_sketch_get_n_double("values") > 0
    return sketches.select(
        *rest, F.hll_sketch_estimate("keys").alias("distinct_keys"), F.when(some, F.kll_sketch_get_quantile_double("values", wanted)).alias("quantiles"))
