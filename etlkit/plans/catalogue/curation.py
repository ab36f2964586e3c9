"""The curated sales model on the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.aggregates import summarise
from etlkit.operators.joins import join_dim
from etlkit.operators.windows import zscore
from etlkit.plans import curated as C
from etlkit.plans.catalogue.registry import query
from etlkit.plans.catalogue.relational import LINE_ID

AS_OF = "2002-01-01"
TIE = 1e-8


def as_of():
    return F.lit(AS_OF).cast("date")


def _regions(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation"), F.col("r_name").alias("region")
    )


def customers(t):
    """Customers as staged: region by nation, tier and credit limit by balance, creation day by key."""
    rows = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"), F.col("c_nationkey").alias("nation"),
        (F.col("c_acctbal") * 10).alias("credit_limit"),
        F.date_sub(as_of(), (F.col("c_custkey") % 2000).cast("int")).alias("created_date"),
        F.when(F.col("c_acctbal") > 8000, "VIP").when(F.col("c_acctbal") > 4000, "Premium").alias("tier"),
    )
    return join_dim(rows, _regions(t), "nation").drop("nation")


def products(t):
    """The tables have no cost, so half the retail price plus the size stands in."""
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("list_price"),
        (F.col("p_retailprice") * 0.5 + F.col("p_size")).alias("cost_price"),
    )


def stores(t):
    rows = t.supplier.select(
        F.col("s_suppkey").alias("store_id"), F.when(F.col("s_acctbal") > 5000, "Mall").otherwise("Outlet").alias("store_type"),
        F.col("s_nationkey").alias("nation"),
    )
    return join_dim(rows, _regions(t), "nation").drop("nation")


def transactions(t, customers=None, how="inner"):
    """Lines with their order's customer and date; every 50th product key is unknown.

    ``customers`` are joined with the orders, of which there are fewer than lines.
    """
    lines = t.lineitem.select(
        F.concat_ws("-", *LINE_ID).alias("transaction_id"), "l_orderkey",
        F.when(F.col("l_partkey") % 50 == 0, -1).otherwise(F.col("l_partkey")).alias("product_id"),
        F.col("l_suppkey").alias("store_id"), F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
    )
    if customers is not None:
        orders = join_dim(orders, customers.select(*C.CUSTOMER_COLUMNS), "customer_id", how)
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


_STAGED = f"""
    customers AS (SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type, r_name AS region,
                         c_acctbal * 10 AS credit_limit, CAST(DATE '{AS_OF}' - CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS created_date,
                         CASE WHEN c_acctbal > 8000 THEN 'VIP' WHEN c_acctbal > 4000 THEN 'Premium' END AS tier
                  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
                        p_retailprice AS list_price, p_retailprice * 0.5::DOUBLE + p_size AS cost_price FROM part),
    stores AS (SELECT s_suppkey AS store_id, CASE WHEN s_acctbal > 5000 THEN 'Mall' ELSE 'Outlet' END AS store_type,
                      r_name AS region
               FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    transactions AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
                            o_custkey AS customer_id, CASE WHEN l_partkey % 50 = 0 THEN -1 ELSE l_partkey END AS product_id,
                            l_suppkey AS store_id, l_quantity AS quantity, l_extendedprice * (1 - l_discount) AS amount,
                            CAST(o_orderdate AS DATE) AS transaction_date
                     FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    dim_customer AS (SELECT *, CASE WHEN created_date < DATE '{AS_OF}' - 1095 THEN 'Veteran'
                                    WHEN created_date < DATE '{AS_OF}' - 365 THEN 'Established' ELSE 'New' END AS customer_age_group,
                            CASE WHEN credit_limit > 50000 THEN 'Low Risk' WHEN credit_limit > 20000 THEN 'Medium Risk'
                                 ELSE 'High Risk' END AS risk_category FROM customers),
    dim_product AS (SELECT *, CASE WHEN list_price > 1000 THEN 'Premium' WHEN list_price > 100 THEN 'Standard'
                                   ELSE 'Budget' END AS price_tier,
                           round((list_price - cost_price) * 100.0 / list_price, 2) AS margin_percentage FROM products),
    inner_fact AS (
        SELECT transaction_id, customer_id, product_id, store_id, customer_type, c.region, tier, risk_category, category, brand,
               price_tier, store_type, s.region AS store_region, amount AS revenue, cost_price * quantity AS cost,
               amount - cost_price * quantity AS profit,
               round((amount - cost_price * quantity) * 100.0 / amount, 2) AS profit_margin_pct,
               CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
               CAST(quarter(transaction_date) AS INTEGER) AS quarter, CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week
        FROM transactions JOIN dim_customer c USING (customer_id) JOIN dim_product USING (product_id) JOIN stores s USING (store_id)),
    left_fact AS (
        SELECT transaction_id, customer_id, product_id, store_id, customer_type, category, store_type, coalesce(amount, 0.0) AS revenue,
               coalesce(cost_price, 0.0) * coalesce(quantity, 0) AS cost,
               coalesce(amount, 0.0) - coalesce(cost_price, 0.0) * coalesce(quantity, 0) AS profit,
               CASE WHEN amount > 0 THEN round((amount - coalesce(cost_price, 0.0) * quantity) * 100.0 / amount, 2)
                    ELSE 0.0 END AS profit_margin_pct
        FROM transactions LEFT JOIN dim_customer USING (customer_id) LEFT JOIN dim_product USING (product_id)
        LEFT JOIN stores USING (store_id))
"""


@query(f"WITH {_STAGED} SELECT * FROM dim_customer")
def customer_dimension(t):
    return C.dim_customer(customers(t), as_of())


@query(f"WITH {_STAGED} SELECT * FROM dim_product")
def product_dimension(t):
    return C.dim_product(products(t))


def _fact(t, how="inner"):
    buyers = C.dim_customer(customers(t), as_of())
    return C.fact_sales(transactions(t, buyers, how), buyers, C.dim_product(products(t)), stores(t), how)


_MONEY = ["revenue", "cost", "profit"]


def _rounded(df, columns, digits=4):
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


_ROUND_MONEY = ", ".join(f"round({c}, 4) AS {c}" for c in _MONEY)


@query(f"WITH {_STAGED} SELECT * REPLACE ({_ROUND_MONEY}) FROM inner_fact")
def sales_fact(t):
    return _rounded(_fact(t), _MONEY).drop("amount", "quantity", "list_price", "cost_price", "transaction_date")


@query(f"WITH {_STAGED} SELECT * REPLACE ({_ROUND_MONEY}) FROM left_fact")
def sales_fact_left(t):
    return _rounded(_fact(t, "left"), _MONEY).select(
        "transaction_id", "customer_id", "product_id", "store_id", "customer_type", "category", "store_type", *_MONEY,
        "profit_margin_pct",
    )


@query(f"""
    WITH {_STAGED}
    SELECT year, month, category, region, customer_type, round(sum(revenue), 4) AS total_revenue,
           round(sum(profit), 4) AS total_profit, round(avg(profit_margin_pct) + {TIE}, 4) AS avg_profit_margin,
           count(transaction_id) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
           count(DISTINCT product_id) AS unique_products,
           round(sum(revenue) / count(DISTINCT customer_id) + {TIE}, 4) AS revenue_per_customer
    FROM inner_fact GROUP BY 1, 2, 3, 4, 5
""")
def sales_summary(t):
    out = _rounded(C.sales_summary(_fact(t), digits=None), ["total_revenue", "total_profit"])
    return out.withColumns({
        c: F.round(F.col(c) + TIE, 4) for c in ("avg_profit_margin", "revenue_per_customer")
    })


def _operator_set(t):
    """Filtered lines with a category lookup, squares and logarithms."""
    v = F.col("l_extendedprice")
    lines = t.lineitem.filter((v > 0) & F.col("l_returnflag").isin("A", "N")).select(*LINE_ID, "l_extendedprice")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    kinds = t.part.select(F.col("p_type").alias("category")).distinct().withColumn(
        "category_type", F.when(F.col("category").like("%PROMO%"), "premium").otherwise("standard")
    )
    return join_dim(lines.join(parts, "l_partkey"), kinds, "category").withColumns({
        "amount_squared": v * v, "log_amount": F.log1p(v),
    })


_SET_SQL = """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_type AS category,
                      CASE WHEN p_type LIKE '%PROMO%' THEN 'premium' ELSE 'standard' END AS category_type
               FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > 0 AND l_returnflag IN ('A', 'N'))
"""


@query(_SET_SQL + """
    SELECT category, category_type, round(sum(l_extendedprice), 2) AS total, count(*) AS rows
    FROM r GROUP BY 1, 2
""")
def operator_set_totals(t):
    return summarise(_operator_set(t), ["category", "category_type"], {
        "total": F.round(F.sum("l_extendedprice"), 2), "rows": F.count(F.lit(1)),
    })


@query(_SET_SQL + """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, amount_squared, log_amount, normalized FROM (
        SELECT *, l_extendedprice * l_extendedprice AS amount_squared, round(ln(l_extendedprice + 1), 8) AS log_amount,
               round((l_extendedprice - avg(l_extendedprice) OVER w) / stddev(l_extendedprice) OVER w, 6) AS normalized
        FROM r WINDOW w AS (PARTITION BY category)) WHERE amount_squared > 1000000
""")
def operator_set_large(t):
    rows = zscore(_operator_set(t), "category", "l_extendedprice", "normalized", few=True)
    return rows.filter(F.col("amount_squared") > 1_000_000).select(
        *LINE_ID, "amount_squared", F.round("log_amount", 8).alias("log_amount"), F.round("normalized", 6).alias("normalized")
    )
