"""CASE ladders, ratios and salts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["hash_below", "pct", "salt", "tier"]


def tier(value: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first bound that ``value`` exceeds; ``default`` otherwise, also for NULL."""
    if not steps:
        raise ValueError("tier needs at least one (bound, label) step")
    (bound, label), *rest = steps
    ladder = F.when(value > F.lit(bound), F.lit(label))
    for bound, label in rest:
        ladder = ladder.when(value > F.lit(bound), F.lit(label))
    return ladder.otherwise(F.lit(default))


def pct(num: Column, den: Column, digits: int | None = 2) -> Column:
    """``num`` as a percentage of ``den``; NULL for a zero denominator."""
    ratio = F.try_divide(num * F.lit(100.0), den)
    return ratio if digits is None else F.round(ratio, digits)


def salt(row_id: Sequence[Column], n: int, seed: int = 0) -> Column:
    """Salt 0..n-1 from the row's identity, so a re-run task gives each row the same salt."""
    if n < 1:
        raise ValueError("salt needs n >= 1")
    return F.pmod(F.xxhash64(*row_id, F.lit(seed)), F.lit(n)).cast("int")


def hash_below(key: Sequence[Column], fraction: float, seed: int = 0) -> Column:
    """True for a fixed ``fraction`` of keys: a sample that does not change between runs."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1_000_000)) < F.lit(round(fraction * 1_000_000))
