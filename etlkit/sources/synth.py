"""Synthetic tables of any size, made on the executors from row numbers and a seed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and skew of each volume.
SIZES = {
    "small": (1_000, 0.1),
    "medium": (50_000, 0.2),
    "large": (500_000, 0.3),
    "xlarge": (2_000_000, 0.4),
}
# Customers, products, stores and transactions of each environment.
ENVIRONMENTS = {
    "development": (1_000, 500, 20, 10_000),
    "staging": (10_000, 2_000, 100, 100_000),
    "production_like": (100_000, 10_000, 500, 1_000_000),
    "stress_test": (500_000, 50_000, 1_000, 5_000_000),
}
# The domains of the generated columns.
CATEGORIES = ("Electronics", "Clothing", "Books", "Home", "Sports")
PRODUCT_CATEGORIES = CATEGORIES + ("Beauty", "Automotive", "Toys")
REGIONS = ("North", "South", "East", "West", "Central")
SALE_STATUSES = ("completed", "pending", "cancelled")
ACCOUNT_TYPES = ("checking", "savings", "credit", "investment")
TRANSACTION_TYPES = ("deposit", "withdrawal", "transfer", "payment")
CURRENCIES = ("USD", "EUR", "GBP", "JPY")
LOCATIONS = ("warehouse_A", "warehouse_B", "warehouse_C", "warehouse_D")
CUSTOMER_TYPES = ("Individual", "Corporate", "Government")
CUSTOMER_STATUSES = ("Active", "Inactive", "Suspended")
COUNTRIES = ("USA", "Canada", "Mexico", "UK", "Germany")
TIERS = (None, "VIP", "Premium", "Standard")
BRANDS = ("Brand_A", "Brand_B", "Brand_C", "Brand_D", "Brand_E")
PRODUCT_STATUSES = ("Active", "Discontinued", "Coming Soon")
PROMOTIONS = (None, "On Sale", "New Arrival", "Best Seller")
STORE_TYPES = ("Mall", "Standalone", "Outlet", "Online")
STORE_SIZES = ("Small", "Medium", "Large", "XLarge")
STORE_STATUSES = ("Active", "Inactive", "Renovation")
CHANNELS = ("Online", "Store", "Mobile", "Phone")
ORDER_STATUSES = ("Completed", "Pending", "Cancelled", "Refunded")
DEFECTS = (
    "null_customer", "invalid_product", "negative_amount", "future_date", "missing_quantity", "duplicate",
)
STEPS = {"hourly": "1 HOUR", "daily": "1 DAY", "weekly": "7 DAYS"}


@dataclass(frozen=True)
class Draw:
    """Repeatable draws: the same seed, row and purpose always give the same value."""

    seed: int
    row: str = "id"

    def bits(self, purpose: str, *more: Column) -> Column:
        return F.xxhash64(F.col(self.row), F.lit(self.seed), F.lit(purpose), *more)

    def below(self, purpose: str, n: int, *more: Column) -> Column:
        """Integer in 0..n-1."""
        return F.pmod(self.bits(purpose, *more), F.lit(n)).cast("int")

    def unit(self, purpose: str, *more: Column) -> Column:
        """Number in [0, 1)."""
        return F.pmod(self.bits(purpose, *more), F.lit(2**52)) / F.lit(float(2**52))

    def between(self, purpose: str, low: float, high: float, *more: Column) -> Column:
        return F.round(F.lit(low) + self.unit(purpose, *more) * F.lit(high - low), 2)

    def pick(self, purpose: str, values: Sequence[str | None]) -> Column:
        return F.get(F.array(*[F.lit(v).cast("string") for v in values]), self.below(purpose, len(values)))


def _day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset)


def _numbered(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def synth_sales(spark: SparkSession, n: int, skew: float = 0.2, seed: int = 0) -> DataFrame:
    """Flat sales; a share ``skew`` of rows is forced to the first category."""
    d = Draw(seed)
    customers = max(1, min(1000, n // 10)) if n >= 10 else 1000
    return spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.when(d.unit("skew") < skew, F.lit(CATEGORIES[0])).otherwise(d.pick("category", CATEGORIES)).alias("category"),
        d.pick("region", REGIONS).alias("region"),
        F.concat(F.lit("Product_"), d.below("product", 100)).alias("product_name"),
        (d.below("sales", 9_991) + 10).alias("sales"),
        _day("2023-01-01", d.below("date", 731)).alias("date"),
        d.pick("status", SALE_STATUSES).alias("status"),
        F.concat(F.lit("customer_"), d.below("customer", customers) + 1).alias("customer_id"),
        (d.below("quantity", 100) + 1).alias("quantity"),
    )


def synth_financial(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    d = Draw(seed)
    accounts = min(10_000, n // 5) or 10_000
    return spark.range(n).select(
        F.col("id").cast("int").alias("transaction_id"),
        F.concat(F.lit("account_"), d.below("account", accounts) + 1).alias("account_id"),
        d.pick("account_type", ACCOUNT_TYPES).alias("account_type"),
        d.pick("transaction_type", TRANSACTION_TYPES).alias("transaction_type"),
        d.between("amount", 1.0, 50_000.0).alias("amount"),
        d.pick("currency", CURRENCIES).alias("currency"),
        _day("2023-01-01", d.below("day", 366)).cast("timestamp").alias("timestamp"),
        F.concat(F.lit("branch_"), d.below("branch", 50) + 1).alias("branch_id"),
    )


def synth_series(spark: SparkSession, n: int, freq: str = "daily", seed: int = 0) -> DataFrame:
    """Sensor readings at a fixed step."""
    if freq not in STEPS:
        raise ValueError(f"freq must be one of {sorted(STEPS)}")
    d = Draw(seed)
    step = F.expr(f"INTERVAL {STEPS[freq]}")
    return spark.range(n).select(
        F.col("id").cast("int").alias("reading_id"),
        F.concat(F.lit("sensor_"), d.below("sensor", 20)).alias("sensor_id"),
        d.pick("location", LOCATIONS).alias("location"),
        d.between("temperature", -10.0, 50.0).alias("temperature"),
        d.between("humidity", 30.0, 90.0).alias("humidity"),
        d.between("pressure", 0.0, 100.0).alias("pressure"),
        (F.lit("2023-01-01").cast("timestamp") + step * F.col("id").cast("int")).alias("timestamp"),
    )


def synth_nested(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """Customers with 1-3 orders of 1-5 items, as one struct column."""
    d = Draw(seed)

    def item(j: Column, k: Column) -> Column:
        return F.struct(
            F.concat(F.lit("item_"), k).alias("item_id"),
            (d.below("quantity", 10, j, k) + 1).alias("quantity"),
            d.between("price", 10.0, 500.0, j, k).alias("price"),
        )

    def order(j: Column) -> Column:
        return F.struct(
            F.concat(F.lit("order_"), F.col("id"), F.lit("_"), j).alias("order_id"),
            _day("2023-01-01", d.below("order_day", 366, j)).cast("string").alias("date"),
            F.transform(F.sequence(F.lit(0), d.below("items", 5, j)), lambda k: item(j, k)).alias("items"),
        )

    person = F.struct(
        F.concat(F.lit("Customer_"), "id").alias("name"),
        (d.below("age", 63) + 18).alias("age"),
        F.concat(F.lit("customer_"), "id", F.lit("@email.com")).alias("email"),
    )
    return spark.range(n).select(F.struct(
        F.concat(F.lit("cust_"), "id").alias("customer_id"),
        person.alias("personal_info"),
        F.transform(F.sequence(F.lit(0), d.below("orders", 3)), order).alias("orders"),
    ).alias("customer_data"))


def synth_customers(spark: SparkSession, n: int, as_of: str, seed: int = 0) -> DataFrame:
    d = Draw(seed)
    return spark.range(n).select(
        _numbered("CUST_", F.col("id"), 8).alias("customer_id"),
        F.concat(F.lit("Customer_"), "id").alias("customer_name"),
        F.concat(F.lit("customer"), "id", F.lit("@email.com")).alias("email"),
        d.pick("type", CUSTOMER_TYPES).alias("customer_type"),
        d.pick("status", CUSTOMER_STATUSES).alias("status"),
        d.pick("region", REGIONS).alias("region"),
        (d.below("postal", 90_000) + 10_000).cast("string").alias("postal_code"),
        d.pick("country", COUNTRIES).alias("country"),
        _day(as_of, -(d.below("created", 3_650) + 1)).alias("created_date"),
        d.pick("tier", TIERS).alias("tier"),
        d.between("credit", 0.0, 100_000.0).alias("credit_limit"),
    )


def synth_products(spark: SparkSession, n: int, as_of: str, seed: int = 0) -> DataFrame:
    d = Draw(seed)
    category, brand = d.pick("category", PRODUCT_CATEGORIES), d.pick("brand", BRANDS)
    return spark.range(n).select(
        _numbered("PROD_", F.col("id"), 8).alias("product_id"),
        F.concat_ws("_", brand, category, F.lit("Product"), "id").alias("product_name"),
        category.alias("category"), brand.alias("brand"),
        d.between("list", 10.0, 2_000.0).alias("list_price"),
        d.between("cost", 5.0, 1_500.0).alias("cost_price"),
        d.pick("status", PRODUCT_STATUSES).alias("status"),
        d.below("stock", 10_001).alias("inventory_qty"),
        _day(as_of, -(d.below("launch", 1_095) + 1)).alias("launch_date"),
        d.pick("promotion", PROMOTIONS).alias("promotion_tag"),
        F.concat(F.lit("Description for "), category, F.lit(" product "), "id").alias("description"),
    )


def synth_stores(spark: SparkSession, n: int, as_of: str, seed: int = 0) -> DataFrame:
    d = Draw(seed)
    return spark.range(n).select(
        _numbered("Store_", F.col("id"), max(3, len(str(max(n - 1, 0))))).alias("store_id"),
        F.concat(F.lit("Store Name "), "id").alias("store_name"),
        d.pick("type", STORE_TYPES).alias("store_type"),
        d.pick("region", REGIONS).alias("region"),
        F.concat(F.lit("City_"), d.below("city", 50) + 1).alias("city"),
        d.pick("size", STORE_SIZES).alias("size_category"),
        _day(as_of, -(d.below("opening", 3_621) + 30)).alias("opening_date"),
        d.pick("status", STORE_STATUSES).alias("status"),
    )


def synth_transactions(
    spark: SparkSession, n: int, customers: int, products: int, stores: int, as_of: str,
    defect_rate: float = 0.15, seed: int = 0,
) -> DataFrame:
    """Transactions of which a share ``defect_rate`` has one defect; duplicates really are extra rows.

    Store ids are padded like those of the store dimension, so both join.
    """
    d = Draw(seed)
    defect = F.when(d.unit("defect") < defect_rate, d.pick("defect_kind", DEFECTS)).otherwise("none")
    rows = spark.range(n).withColumn("defect", defect)
    is_ = lambda kind: F.col("defect") == kind
    amount = F.when(is_("negative_amount"), -d.between("loss", 10.0, 1_000.0)).otherwise(
        d.between("amount", 10.0, 5_000.0)
    )
    day = F.when(is_("future_date"), _day(as_of, d.below("ahead", 30) + 1)).otherwise(
        _day(as_of, -d.below("back", 366))
    )
    width = max(3, len(str(max(stores - 1, 0))))
    made = rows.select(
        _numbered("TXN_", F.col("id"), 10).alias("transaction_id"),
        F.when(~is_("null_customer"), _numbered("CUST_", d.below("customer", customers), 8)).alias("customer_id"),
        F.when(is_("invalid_product"), F.lit("INVALID_PROD"))
        .otherwise(_numbered("PROD_", d.below("product", products), 8)).alias("product_id"),
        amount.alias("amount"),
        F.when(~is_("missing_quantity"), d.below("quantity", 10) + 1).alias("quantity"),
        day.alias("transaction_date"),
        d.pick("channel", CHANNELS).alias("channel"),
        d.pick("status", ORDER_STATUSES).alias("status"),
        _numbered("Store_", d.below("store", stores), width).alias("store_id"),
        F.when(is_("duplicate"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return made.withColumn("copies", F.explode("copies")).drop("copies").withColumn(
        "tax_amount", F.when(F.col("amount") > 0, F.round(F.col("amount") * 0.08, 2))
    )
