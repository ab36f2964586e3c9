"""Staging tables to a dimensional sales model."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.functions.values import pct, tier
from etlkit.operators.joins import star_join
from etlkit.operators.quality import (
    CLEANING_PLANS, CleaningPlan, cleaning_stats, kept_rows, profile, tag_rows,
)
from etlkit.runtime import require
from etlkit.sinks.files import write_partitioned, write_sized


@dataclass(frozen=True)
class Staging:
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    transactions: DataFrame


@dataclass(frozen=True)
class Curated:
    dim_customer: DataFrame
    dim_product: DataFrame
    fact_sales: DataFrame
    agg_sales_summary: DataFrame


# Bounds of the customer and product classes.
VETERAN_DAYS, ESTABLISHED_DAYS = 1095, 365
RISK_STEPS = [(50_000.0, "Low Risk"), (20_000.0, "Medium Risk")]
PRICE_STEPS = [(1_000.0, "Premium"), (100.0, "Standard")]
# Columns of a customer in the fact.
CUSTOMER_COLUMNS = ["customer_id", "customer_type", "region", "tier", "risk_category"]


def dim_customer(customers: DataFrame, as_of: Column) -> DataFrame:
    """Age group by days since creation, risk by credit limit."""
    require(customers, "customer_id", "created_date", "credit_limit")
    created = F.col("created_date")
    return customers.withColumns({
        "customer_age_group": F.when(created < F.date_sub(as_of, VETERAN_DAYS), "Veteran")
        .when(created < F.date_sub(as_of, ESTABLISHED_DAYS), "Established").otherwise("New"),
        "risk_category": tier(F.col("credit_limit"), RISK_STEPS, "High Risk"),
    })


def dim_product(products: DataFrame) -> DataFrame:
    """Price tier and margin as a percentage of the list price."""
    require(products, "product_id", "list_price", "cost_price")
    margin = F.col("list_price") - F.col("cost_price")
    return products.withColumns({
        "price_tier": tier(F.col("list_price"), PRICE_STEPS, "Budget"),
        "margin_percentage": pct(margin, F.col("list_price")),
    })


def fact_sales(
    transactions: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame,
    how: str = "inner",
) -> DataFrame:
    """Transactions with their dimensions, revenue, cost, profit, margin and calendar parts.

    ``how='left'`` keeps transactions with unknown keys: their missing amounts count as 0 and the
    margin is 0 where there is no revenue. A dimension whose columns the transactions hold already, as when customers
    were joined with the orders of many lines, is not joined again.
    """
    dims = [
        (customers.select(*CUSTOMER_COLUMNS), "customer_id"),
        (products.select("product_id", "category", "brand", "list_price", "cost_price", "price_tier"), "product_id"),
        (stores.select("store_id", "store_type", F.col("region").alias("store_region")), "store_id"),
    ]
    held = set(transactions.columns)
    joined = star_join(transactions, [(dim, on) for dim, on in dims if not set(dim.columns) <= held], how)
    if how == "left":
        revenue = F.coalesce("amount", F.lit(0.0))
        cost = F.coalesce("cost_price", F.lit(0.0)) * F.coalesce("quantity", F.lit(0))
    else:
        revenue, cost = F.col("amount"), F.col("cost_price") * F.col("quantity")
    with_money = joined.withColumns({"revenue": revenue, "cost": cost}).withColumn(
        "profit", F.col("revenue") - F.col("cost")
    )
    margin = pct(F.col("profit"), F.col("revenue"))
    if how == "left":
        margin = F.when(F.col("revenue") > 0, margin).otherwise(0.0)
    day = F.col("transaction_date")
    return with_money.withColumns({
        "profit_margin_pct": margin,
        "year": F.year(day), "month": F.month(day), "quarter": F.quarter(day), "day_of_week": F.dayofweek(day),
    })


def sales_summary(fact: DataFrame, digits: int | None = 2) -> DataFrame:
    """Revenue, profit, margin and distinct buyers per month, category, region and customer type.

    ``digits`` rounds the revenue per customer; None leaves it as it is.
    """
    keys = ["year", "month", "category", "region", "customer_type"]
    require(fact, *keys, "revenue", "profit", "profit_margin_pct", "transaction_id", "customer_id", "product_id")
    out = fact.groupBy(*keys).agg(
        F.sum("revenue").alias("total_revenue"), F.sum("profit").alias("total_profit"),
        F.avg("profit_margin_pct").alias("avg_profit_margin"),
        F.count("transaction_id").alias("transaction_count"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("product_id").alias("unique_products"),
    )
    share = F.try_divide("total_revenue", "unique_customers")
    return out.withColumn("revenue_per_customer", share if digits is None else F.round(share, digits))


def curate(staging: Staging, as_of: Column, how: str = "inner") -> Curated:
    """All curated tables from cleaned staging tables."""
    customers, products = dim_customer(staging.customers, as_of), dim_product(staging.products)
    fact = fact_sales(staging.transactions, customers, products, staging.stores, how)
    return Curated(customers, products, fact, sales_summary(fact))


def transaction_rules(as_of: Column) -> dict[str, Column]:
    return {
        "negative_amounts": F.col("amount") < 0,
        "future_dates": F.col("transaction_date") > as_of,
        "invalid_customer_ids": F.col("customer_id").isNull() | (F.col("customer_id") == ""),
    }


def load_table(name: str, df: DataFrame, target: str, files_mb: int = 128, increment: bool = False) -> str:
    """Write one curated table under ``target``; the fact is partitioned by year and month.

    A full load replaces the whole table. An ``increment`` of the fact replaces only the months it holds.
    """
    path = f"{target.rstrip('/')}/{name}"
    if name == "fact_sales":
        write_partitioned(df, ["year", "month"], path=path, dynamic=increment)
    else:
        write_sized(df, path, target_mb=files_mb, mode="overwrite")
    return path


def load_curated(curated: Curated, target: str, files_mb: int = 128, increment: bool = False) -> None:
    """Write all curated tables. The summary is computed from the fact as written."""
    spark = curated.fact_sales.sparkSession
    for item in fields(curated):
        df = getattr(curated, item.name)
        if item.name == "agg_sales_summary":
            df = sales_summary(spark.read.parquet(f"{target.rstrip('/')}/fact_sales"))
        load_table(item.name, df, target, files_mb, increment)


@dataclass(frozen=True)
class Run:
    """Folders written by a staging-to-curated run; every stage can be repeated from its input."""

    staged: str
    profiles: str
    tagged: str
    cleaned: str
    statistics: str
    curated: str


def run_staging_to_curated(
    staging: Staging, target: str, as_of: Column,
    plans: Mapping[str, CleaningPlan] = CLEANING_PLANS,
    on_stage: Callable[[str], None] = lambda stage: None,
) -> Run:
    """Stage, profile, clean, curate and load.

    Each stage reads what the one before it wrote. Tagged rows are written once, so removing
    duplicates costs one shuffle although both the kept rows and the statistics need it.
    """
    base = target.rstrip("/")
    run = Run(*(f"{base}/{name}" for name in ("staged", "profiles", "tagged", "cleaned", "statistics", "curated")))
    spark = staging.transactions.sparkSession
    tables = [f.name for f in fields(staging)]
    for name in tables:
        getattr(staging, name).write.mode("overwrite").parquet(f"{run.staged}/{name}")
    on_stage("staged")
    for name in tables:
        staged = spark.read.parquet(f"{run.staged}/{name}")
        rules = transaction_rules(as_of) if name == "transactions" else None
        profile(staged, rules).write.mode("overwrite").parquet(f"{run.profiles}/{name}")
        plan = plans.get(f"staging_{name}", CleaningPlan())
        tag_rows(staged, plan, as_of).write.mode("overwrite").parquet(f"{run.tagged}/{name}")
        tagged = spark.read.parquet(f"{run.tagged}/{name}")
        kept_rows(tagged, plan).write.mode("overwrite").parquet(f"{run.cleaned}/{name}")
        cleaning_stats(tagged, plan, as_of).write.mode("overwrite").parquet(f"{run.statistics}/{name}")
    on_stage("cleaned")
    ready = Staging(*(spark.read.parquet(f"{run.cleaned}/{name}") for name in tables))
    load_curated(curate(ready, as_of), run.curated)
    on_stage("curated")
    return run
