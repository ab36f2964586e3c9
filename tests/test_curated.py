"""The staging-to-curated run, end to end on generated tables."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from etlkit.plans import curated as C
from etlkit.sources import synth as S

AS_OF = "2024-06-30"


@pytest.fixture(scope="module")
def staging(spark):
    return C.Staging(
        S.synth_customers(spark, 200, AS_OF), S.synth_products(spark, 50, AS_OF), S.synth_stores(spark, 10, AS_OF),
        S.synth_transactions(spark, 3000, 200, 50, 10, AS_OF),
    )


def test_run(spark, staging, tmp_path):
    stages = []
    run = C.run_staging_to_curated(staging, str(tmp_path), F.lit(AS_OF).cast("date"), on_stage=stages.append)
    assert stages == ["staged", "cleaned", "curated"]
    stats = {r.reason: r.rows for r in spark.read.parquet(f"{run.statistics}/transactions").collect()}
    assert stats["original"] == staging.transactions.count() and stats["kept"] == sum(
        [stats["original"], -stats["duplicate"], -stats["null_customer_id"], -stats["null_product_id"], -stats["null_amount"],
         -stats["negative_amount"], -stats["future_transaction_date"]])
    cleaned, fact = spark.read.parquet(f"{run.cleaned}/transactions"), spark.read.parquet(f"{run.curated}/fact_sales")
    assert cleaned.count() == stats["kept"]
    assert fact.count() == cleaned.filter("product_id <> 'INVALID_PROD'").count() > 0
    summary = spark.read.parquet(f"{run.curated}/agg_sales_summary")
    assert round(summary.agg(F.sum("total_revenue")).first()[0], 2) == round(fact.agg(F.sum("revenue")).first()[0], 2)
    profile = {r.metric: r.value for r in spark.read.parquet(f"{run.profiles}/transactions").collect()}
    assert profile["rule.negative_amounts"] > 0 and profile["duplicate_rows"] == stats["duplicate"]
    assert spark.read.parquet(f"{run.curated}/dim_customer").count() == 200
    before = rows(summary.select("year", "month", "transaction_count"))
    again = C.run_staging_to_curated(staging, str(tmp_path), F.lit(AS_OF).cast("date"))
    assert rows(spark.read.parquet(f"{again.curated}/agg_sales_summary").select("year", "month", "transaction_count")) == before


def test_left_fact_keeps_unknown_keys(spark, staging):
    curated = C.curate(staging, F.lit(AS_OF).cast("date"), how="left")
    assert curated.fact_sales.count() == staging.transactions.count()
    lost = curated.fact_sales.filter("product_id = 'INVALID_PROD'")
    assert lost.filter("cost <> 0").count() == 0 and lost.count() > 0
    assert curated.fact_sales.filter("revenue <= 0 and profit_margin_pct <> 0").count() == 0


def test_dimension_classes(spark):
    c = spark.createDataFrame([("a", "2020-01-01", 60000.0), ("b", "2023-01-01", 30000.0), ("c", "2024-06-01", 20000.0)],
                              "customer_id string, created string, credit_limit double")
    c = c.withColumn("created_date", F.to_date("created"))
    got = C.dim_customer(c, F.lit(AS_OF).cast("date")).select("customer_id", "customer_age_group", "risk_category")
    assert rows(got) == [("a", "Veteran", "Low Risk"), ("b", "Established", "Medium Risk"), ("c", "New", "High Risk")]
    p = spark.createDataFrame([("a", 1500.0, 1000.0), ("b", 100.0, 50.0), ("c", 0.0, 1.0)], "product_id string, list_price double, cost_price double")
    got = C.dim_product(p).select("product_id", "price_tier", F.coalesce("margin_percentage", F.lit(-1.0)))
    assert rows(got) == [("a", "Premium", 33.33), ("b", "Budget", 50.0), ("c", "Budget", -1.0)]


def test_customers_held_by_the_transactions_are_not_joined_again(spark):
    sold = spark.createDataFrame([("t", 1, 1, 1, 2.0, 8.0, "A", "EUROPE", "VIP", "Low Risk")], """transaction_id string, customer_id long, product_id long,
        store_id long, quantity double, amount double, customer_type string, region string, tier string, risk_category string""")
    sold = sold.selectExpr("*", "DATE '2001-02-03' AS transaction_date")
    buyers = sold.select("customer_id", "customer_type", "region", "tier", "risk_category")
    goods = spark.sql("SELECT 1L AS product_id, 'c' AS category, 'b' AS brand, 4.0D AS list_price, 3.0D AS cost_price, 'Budget' AS price_tier")
    shops = spark.sql("SELECT 1L AS store_id, 'Mall' AS store_type, 'ASIA' AS region")
    for how in ("inner", "left"):
        plain = C.fact_sales(sold.drop("customer_type", "region", "tier", "risk_category"), buyers, goods, shops, how)
        held = C.fact_sales(sold, buyers, goods, shops, how)
        assert held.select(*plain.columns).collect() == plain.collect() and held.count() == 1
