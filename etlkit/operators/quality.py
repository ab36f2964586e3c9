"""Profiling, repair, validation and cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.operators.aggregates import exact_percentiles, value_levels
from etlkit.operators.joins import unmatched
from etlkit.operators.windows import with_group_stats
from etlkit.runtime import join_groups, names, require, settled

__all__ = [
    "CLEANING_PLANS", "CleaningPlan", "Cleaned", "clean", "cleaning_stats", "dead_letter",
    "iqr_outliers", "iqr_outliers_by_group", "kept_rows", "mark_duplicates", "orphans", "profile",
    "repair_nulls", "split_dead_letters", "tag_rows", "try_convert", "validate",
]


def _repeated_rows(df: DataFrame) -> DataFrame:
    """One row: ``n``, all rows, and ``duplicates``, rows beyond the first of equal ones.

    Rows are told apart by two 64-bit hashes, of values and null marks; 16 bytes a row are shuffled. Rows whose
    hashes occur more than once are compared in full.
    """
    marks = [m for c in df.columns for m in (F.col(c), F.col(c).isNull())]
    hashed = df.withColumns({"__h1": F.xxhash64(*marks), "__h2": F.xxhash64(F.lit(1), *marks)})
    counts = hashed.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"))
    again = counts.filter("__n > 1").select(F.col("__h1").alias("__a"), F.col("__h2").alias("__b"))
    suspects = hashed.join(again, (F.col("__h1") == F.col("__a")) & (F.col("__h2") == F.col("__b")), "left_semi")
    equal = suspects.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    parts = counts.select(F.col("__n").alias("n"), F.lit(0).cast("long").alias("duplicates")).unionByName(
        equal.select(F.lit(0).cast("long").alias("n"), (F.col("__n") - 1).alias("duplicates")))
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "duplicates")])


def profile(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows, columns, NULLs per column, duplicate rows and rule violations, one row per metric.

    Counts are one aggregation without a shuffle of rows; duplicates are found by hashes of the rows.
    ``pct`` is relative to the row count and NULL for an empty table.
    """
    def rows_where(condition: Column) -> Column:
        return F.count(F.when(condition, True))

    metrics = {
        "total_records": F.count(F.lit(1)),
        "total_columns": F.lit(len(df.columns)).cast("long"),
        **{f"nulls.{c}": rows_where(F.col(c).isNull()) for c in df.columns},
        **{f"rule.{name}": rows_where(condition) for name, condition in (rules or {}).items()},
    }
    as_rows = lambda total, found: F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.alias("value"), total.alias("total")) for name, value in found.items()])).alias("m")
    counted = df.agg(*[value.alias(f"__{k}") for k, value in enumerate(metrics.values())])
    counted = counted.select(as_rows(F.col("__0"), {name: F.col(f"__{k}") for k, name in enumerate(metrics)}))
    repeated = _repeated_rows(df).select(as_rows(F.col("n"), {"duplicate_rows": F.col("duplicates")}))
    found = counted.unionByName(repeated).select("m.*")
    share = F.round(F.try_divide(F.col("value") * 100.0, F.col("total")), 2)
    no_share = F.col("metric").isin("total_records", "total_columns")
    return found.select("metric", "value", F.when(~no_share, share).alias("pct"))


def repair_nulls(
    df: DataFrame, name: str, amount: str, defaults: Mapping[str, str] | None = None
) -> DataFrame:
    """Missing names become UNKNOWN, missing or negative amounts 0, other columns their default."""
    require(df, name, amount, *(defaults or {}))
    repaired = df.withColumns({
        "name_cleaned": F.coalesce(F.col(name), F.lit("UNKNOWN")),
        "amount_cleaned": F.when(F.col(amount).isNull() | (F.col(amount) < 0), 0.0).otherwise(F.col(amount)),
    })
    return repaired.fillna(dict(defaults)) if defaults else repaired


def mark_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows share the given values, and whether a row is one of several."""
    rows = with_group_stats(df, list(columns), {"duplicate_count": F.count(F.lit(1))})
    return rows.withColumn("is_duplicate", F.col("duplicate_count") > 1)


def _fence(df: DataFrame, column: str, k: float) -> DataFrame:
    """Flag and cap by the q1 and q3 columns, which are dropped."""
    spread = F.col("__q3") - F.col("__q1")
    low, high = F.col("__q1") - k * spread, F.col("__q3") + k * spread
    value = F.col(column)
    return df.withColumns({
        "is_outlier": (value < low) | (value > high),
        "capped": F.when(value > high, high).when(value < low, low).otherwise(value),
    }).drop("__q1", "__q3")


def _exact_quartiles(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    return exact_percentiles(df, by, column, [0.25, 0.75], value_levels(df, column)).groupBy(*by).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("__q1"), F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("__q3"))


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5, accuracy: int = 10_000, exact: bool = False) -> DataFrame:
    """Flag values outside the interquartile fence and cap them to it.

    The quartiles are a scalar subquery, evaluated on the cluster when the result is. They are
    approximate, or with ``exact`` interpolated from counts of distinct values.
    """
    require(df, column)
    if exact:
        found = _exact_quartiles(df.select(F.lit(0).alias("__whole"), column), ["__whole"], column)
        both = df.withColumn("__q", found.agg(F.struct(*[F.max(q).alias(q) for q in ("__q1", "__q3")]).alias("q")).scalar())
        return _fence(both.withColumns({q: F.col(f"__q.{q}") for q in ("__q1", "__q3")}).drop("__q"), column, k)
    quartiles = df.agg(F.percentile_approx(column, [0.25, 0.75], accuracy).alias("q")).scalar()
    return _fence(
        df.withColumns({"__q1": F.get(quartiles, F.lit(0)), "__q3": F.get(quartiles, F.lit(1))}), column, k
    )


def iqr_outliers_by_group(
    df: DataFrame, by: str | Sequence[str], column: str, k: float = 1.5, accuracy: int = 10_000, exact: bool = False,
) -> DataFrame:
    """The same with one fence per group."""
    require(df, column)
    if exact:
        by = names(by)
        return _fence(join_groups(df, settled(_exact_quartiles(df, by, column)), by), column, k)
    stats = {
        "__q1": F.percentile_approx(column, 0.25, accuracy),
        "__q3": F.percentile_approx(column, 0.75, accuracy),
    }
    return _fence(with_group_stats(df, by, stats, few=True), column, k)


def validate(df: DataFrame, rules: Mapping[str, Column], errors: str = "validation_errors") -> DataFrame:
    """Codes of all broken rules in one array, and ``is_valid``. A rule states what is wrong."""
    if not rules:
        raise ValueError("at least one rule is needed")
    codes = F.array(*[F.when(condition, F.lit(code)) for code, condition in rules.items()])
    return df.withColumn(errors, F.array_compact(codes)).withColumn("is_valid", F.size(errors) == 0)


@dataclass(frozen=True)
class CleaningPlan:
    """What to do to one table. Steps run in field order."""

    remove_duplicates: bool = True
    drop_nulls: Sequence[str] = ()
    defaults: Mapping[str, str] = field(default_factory=dict)
    non_negative: Sequence[str] = ()
    not_after_as_of: Sequence[str] = ()
    standardise: Mapping[str, Sequence[str]] = field(default_factory=dict)


# The standard plans of the staging tables.
CLEANING_PLANS = {
    "staging_transactions": CleaningPlan(
        drop_nulls=("customer_id", "product_id", "amount"),
        non_negative=("amount",),
        not_after_as_of=("transaction_date",),
        standardise={"channel": ("upper", "trim"), "status": ("upper", "trim")},
    ),
    "staging_customers": CleaningPlan(
        drop_nulls=("customer_id", "customer_name"),
        defaults={"email": "no-email@unknown.com"},
        standardise={"customer_name": ("title", "trim"), "email": ("trim",), "status": ("upper",)},
    ),
    "staging_products": CleaningPlan(
        drop_nulls=("product_id", "product_name"),
        standardise={
            "product_name": ("title", "trim"), "category": ("title",), "brand": ("title",),
            "status": ("upper",),
        },
    ),
    "staging_stores": CleaningPlan(),
}

_STANDARD = {"upper": F.upper, "trim": F.trim, "title": F.initcap}


@dataclass(frozen=True)
class Cleaned:
    rows: DataFrame
    stats: DataFrame


REASON, COPIES = "__reason", "__copies"


def _broken(plan: CleaningPlan, as_of: Column) -> list[tuple[str, Column]]:
    """Removal rules of a plan in the order in which they apply."""
    return [
        *[(f"null_{c}", F.col(c).isNull()) for c in plan.drop_nulls],
        *[(f"negative_{c}", ~F.coalesce(F.col(c) >= 0, F.lit(False))) for c in plan.non_negative],
        *[(f"future_{c}", ~F.coalesce(F.col(c) <= as_of, F.lit(False))) for c in plan.not_after_as_of],
    ]


def tag_rows(df: DataFrame, plan: CleaningPlan, as_of: Column) -> DataFrame:
    """Distinct rows with their number of copies and the first rule each one breaks."""
    require(df, *plan.drop_nulls, *plan.defaults, *plan.non_negative, *plan.not_after_as_of,
            *plan.standardise)
    if plan.remove_duplicates:
        base = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))
    else:
        base = df.withColumn(COPIES, F.lit(1).cast("long"))
    reasons = [F.when(condition, F.lit(name)) for name, condition in _broken(plan, as_of)]
    return base.withColumn(REASON, F.coalesce(F.lit(None).cast("string"), *reasons))


def kept_rows(tagged: DataFrame, plan: CleaningPlan) -> DataFrame:
    """Rows that broke no rule, with defaults filled in and texts standardised."""
    kept = tagged.filter(F.col(REASON).isNull()).drop(REASON, COPIES)
    if plan.defaults:
        kept = kept.fillna(dict(plan.defaults))
    for column, steps in plan.standardise.items():
        kept = kept.withColumn(column, reduce(lambda c, s: _STANDARD[s](c), steps, F.col(column)))
    return kept


def cleaning_stats(tagged: DataFrame, plan: CleaningPlan, as_of: Column) -> DataFrame:
    """Rows before, rows removed for each reason and rows kept, from one aggregation."""
    counts = [
        ("original", F.sum(COPIES)),
        ("duplicate", F.sum(F.col(COPIES) - 1)),
        *[(name, F.count_if(F.col(REASON) == name)) for name, _ in _broken(plan, as_of)],
        ("kept", F.count_if(F.col(REASON).isNull())),
    ]
    return tagged.agg(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("reason"),
                 F.coalesce(value, F.lit(0)).alias("rows"))
        for i, (name, value) in enumerate(counts)
    ]).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def clean(df: DataFrame, plan: CleaningPlan, as_of: Column) -> Cleaned:
    """Apply a plan; ``stats`` has one row per reason with the number of rows removed."""
    tagged = tag_rows(df, plan, as_of)
    return Cleaned(kept_rows(tagged, plan), cleaning_stats(tagged, plan, as_of))


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL key is unknown to the dimension."""
    known = dim.select(F.col(dim_key or key).alias(key))
    return unmatched(fact.filter(F.col(key).isNotNull()), known, key)


def dead_letter(df: DataFrame, amount: str = "amount", customer: str = "customer_id") -> DataFrame:
    """``is_valid`` and the first reason why not. For batches and streams."""
    require(df, amount, customer)
    reason = (
        F.when(F.col(amount).isNull(), "NULL_AMOUNT")
        .when(F.col(amount) <= 0, "INVALID_AMOUNT")
        .when(F.col(customer).isNull(), "NULL_CUSTOMER")
    )
    return df.withColumn("error_reason", reason).withColumn("is_valid", F.col("error_reason").isNull())


def split_dead_letters(marked: DataFrame) -> dict[str, DataFrame]:
    require(marked, "is_valid")
    return {
        "valid": marked.filter("is_valid").drop("is_valid", "error_reason"),
        "rejected": marked.filter(~F.col("is_valid")),
    }


def try_convert(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns to ``types``. A text that does not fit gives NULL and names its column."""
    require(df, *types)
    made = {f"{c}_value": F.col(c).try_cast(t) for c, t in types.items()}
    failed = [
        F.when(F.col(c).isNotNull() & F.col(f"{c}_value").isNull(), F.lit(c)) for c in types
    ]
    return df.withColumns(made).withColumn("failed_columns", F.array_compact(F.array(*failed)))
