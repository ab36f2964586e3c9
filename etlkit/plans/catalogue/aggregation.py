"""Grouped, salted, distinct, statistical, percentile and time-bucketed aggregation; reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators import aggregates as A
from etlkit.operators.reshape import crosstab, pivot_sum, unpivot
from etlkit.plans.catalogue.registry import query
from etlkit.plans.catalogue.relational import LINE_ID
from etlkit.runtime import join_groups

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FLAGS = ["A", "N", "R"]


@query("""
    SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total_sales, count(*) AS transaction_count,
           round(avg(l_extendedprice), 4) AS avg_sales
    FROM lineitem GROUP BY 1, 2
""")
def group_summary(t):
    return A.summarise(t.lineitem, ["l_returnflag", "l_linestatus"], {
        "total_sales": F.round(F.sum("l_extendedprice"), 2), "transaction_count": F.count(F.lit(1)),
        "avg_sales": F.round(F.avg("l_extendedprice"), 4),
    })


@query("SELECT round(sum(l_extendedprice), 2) AS total_sales, count(*) AS rows, max(l_shipdate) AS last_ship FROM lineitem")
def global_total(t):
    return A.summarise(t.lineitem, [], {
        "total_sales": F.round(F.sum("l_extendedprice"), 2), "rows": F.count(F.lit(1)), "last_ship": F.max("l_shipdate"),
    })


def _sales(t):
    """Order value by region and segment; every 25th customer has no segment."""
    segment = F.when(F.col("c_custkey") % 25 != 0, F.col("c_mktsegment")).alias("segment")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", segment)
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name"
    )
    return t.orders.join(customers, "o_custkey").join(places, "c_nationkey")


_SALES_SQL = """
    (SELECT o.*, r_name, CASE WHEN c_custkey % 25 <> 0 THEN c_mktsegment END AS segment
     FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey)
"""


@query(f"""
    SELECT r_name, segment, round(sum(o_totalprice), 2) AS total_sales, count(*) AS count,
           CAST(grouping(r_name, segment) AS INTEGER) AS level
    FROM {_SALES_SQL} GROUP BY ROLLUP (r_name, segment)
""")
def rollup_subtotals(t):
    return A.rollup_summary(_sales(t), ["r_name", "segment"], {
        "total_sales": F.round(F.sum("o_totalprice"), 2), "count": F.count(F.lit(1)),
    }).orderBy("level", "r_name", "segment")


@query(f"""
    SELECT r_name, segment, o_orderstatus, round(sum(o_totalprice), 2) AS total_sales,
           CAST(grouping(r_name, segment, o_orderstatus) AS INTEGER) AS level
    FROM {_SALES_SQL} GROUP BY CUBE (r_name, segment, o_orderstatus) HAVING sum(o_totalprice) IS NOT NULL
""")
def cube_subtotals(t):
    return A.cube_summary(_sales(t), ["r_name", "segment", "o_orderstatus"], {
        "total_sales": F.round(F.sum("o_totalprice"), 2),
    })


@query("""
    SELECT l_returnflag, round(sum(l_extendedprice), 2) AS total, count(l_extendedprice) AS rows,
           min(l_extendedprice) AS low, max(l_extendedprice) AS high, round(avg(l_extendedprice), 4) AS mean
    FROM lineitem GROUP BY 1
""")
def salted_totals(t):
    out = A.salted_agg(t.lineitem, "l_returnflag", "l_extendedprice", LINE_ID)
    return out.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 4)})


@query(f"""
    SELECT r_name, segment, round(sum(o_totalprice), 2) AS total_amount, count(DISTINCT o_custkey) AS unique_customers,
           round(avg(o_totalprice), 4) AS avg_amount
    FROM {_SALES_SQL} WHERE o_orderstatus = 'F' AND o_totalprice > 1000 GROUP BY 1, 2
    HAVING sum(o_totalprice) > 10000 AND count(DISTINCT o_custkey) > 5
""")
def filtered_groups_having(t):
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)
    return A.summarise(_sales(t).filter(wanted), ["r_name", "segment"], {
        "total_amount": F.round(F.sum("o_totalprice"), 2),
        "unique_customers": F.count_distinct("o_custkey"),
        "avg_amount": F.round(F.avg("o_totalprice"), 4),
    }).filter((F.col("total_amount") > 10000) & (F.col("unique_customers") > 5))


@query("""
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY 1
""")
def distinct_counts(t):
    return A.summarise(t.lineitem, "l_returnflag", {
        "parts": F.count_distinct("l_partkey"), "suppliers": F.count_distinct("l_suppkey"),
    })


_PAGES_SQL = """
    SELECT p_type, CAST((n - 1) // 100 AS BIGINT) AS page, string_agg(p_name, ',' ORDER BY p_name) AS products
    FROM (SELECT p_type, p_name, row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS n FROM {source})
    GROUP BY 1, 2
"""


@query(_PAGES_SQL.format(source="part"))
def collected_lists(t):
    """All product names of a type in order, a hundred to a row."""
    pages = A.collect(t.part, "p_type", "p_name", page=100)
    return pages.select("p_type", "page", F.array_join("values", ",").alias("products"))


@query(_PAGES_SQL.format(source="(SELECT DISTINCT p_type, p_name FROM part)"))
def collected_sets(t):
    pages = A.collect(t.part, "p_type", "p_name", distinct=True, page=100)
    return pages.select("p_type", "page", F.array_join("values", ",").alias("products"))


@query("""
    WITH m AS (SELECT l_returnflag AS g, avg(l_extendedprice) AS mu FROM lineitem GROUP BY 1),
         c AS (SELECT l_returnflag, avg((l_extendedprice - mu) ^ 2) AS m2, avg((l_extendedprice - mu) ^ 3) AS m3,
                      avg((l_extendedprice - mu) ^ 4) AS m4, stddev(l_extendedprice) AS s, variance(l_extendedprice) AS v
               FROM lineitem JOIN m ON l_returnflag = g GROUP BY 1)
    SELECT l_returnflag, round(s, 4) AS stddev, round(v, 2) AS variance, round(m3 / m2 ^ 1.5, 6) AS skewness,
           round(m4 / m2 ^ 2 - 3, 6) AS kurtosis
    FROM c
""")
def statistical_moments(t):
    out = A.moments(t.lineitem, "l_returnflag", "l_extendedprice")
    return out.select(
        "l_returnflag", F.round("stddev", 4).alias("stddev"), F.round("variance", 2).alias("variance"),
        F.round("skewness", 6).alias("skewness"), F.round("kurtosis", 6).alias("kurtosis"),
    )


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS correlation FROM lineitem GROUP BY 1")
def correlation(t):
    return A.summarise(t.lineitem, "l_returnflag", {
        "correlation": F.round(F.corr("l_quantity", "l_extendedprice"), 8),
    })


_SHARES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}


def _rank_checked(df, by, column, found, shares, accuracy):
    """Groups with, for each approximate percentile, whether it is a value whose rank is off by at most n / accuracy + 1."""
    rows = join_groups(df.filter(F.col(column).isNotNull()).select(*by, column), found, by)
    counts = {}
    for name in shares:
        counts[f"{name}_below"] = F.count_if(F.col(column) < F.col(name))
        counts[f"{name}_upto"] = F.count_if(F.col(column) <= F.col(name))
    ranks = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in counts.items()])
    slack = F.col("rows") / accuracy + 1
    ok = {n: (F.col(f"{n}_upto") > F.col(f"{n}_below")) & (F.col(f"{n}_below") <= F.col("rows") * p + slack) & (F.col(f"{n}_upto") >= F.col("rows") * p - slack)
          for n, p in shares.items()}
    return ranks.select(*by, "rows", *[c.alias(f"{n}_in_bounds") for n, c in ok.items()])


@query("SELECT l_returnflag, count(*) AS rows, " + ", ".join(f"true AS {n}_in_bounds" for n in _SHARES) + " FROM lineitem GROUP BY 1")
def approximate_percentiles(t):
    """Percentiles at the default accuracy, with their true ranks held against its bound."""
    lines = t.lineitem.select("l_returnflag", "l_extendedprice")
    found = A.percentiles(lines, "l_returnflag", "l_extendedprice", _SHARES)
    return _rank_checked(lines, ["l_returnflag"], "l_extendedprice", found, _SHARES, 10_000)


@query("\n UNION ALL ".join(f"""
    SELECT l_returnflag, {p}::DOUBLE AS p, round(quantile_cont(l_extendedprice, {p}), 4) AS value
    FROM lineitem GROUP BY 1
""" for p in (0.25, 0.5, 0.75, 0.95)))
def exact_percentiles(t):
    levels = [F.floor(F.col("l_extendedprice") / 1000)]
    out = A.exact_percentiles(t.lineitem, "l_returnflag", "l_extendedprice", [0.25, 0.5, 0.75, 0.95], levels)
    return out.withColumn("value", F.round("value", 4))


@query("SELECT l_returnflag, true AS distinct_in_bounds, true AS median_in_bounds FROM lineitem GROUP BY 1")
def approximate_profile(t):
    """Distinct keys and median from sketches, held against exact figures: 15 % (three deviations) and rank 1 in 10,000."""
    found = A.approx_profile(t.lineitem, "l_returnflag", "l_partkey", "l_extendedprice")
    exact = t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("keys"))
    lines = t.lineitem.select("l_returnflag", "l_extendedprice")
    ranked = _rank_checked(lines, ["l_returnflag"], "l_extendedprice", found.withColumnRenamed("approx_median", "median"), {"median": 0.5}, 10_000)
    both = found.join(exact, "l_returnflag").join(ranked, "l_returnflag")
    return both.select("l_returnflag", (F.abs(F.col("approx_distinct") - F.col("keys")) <= 0.15 * F.col("keys") + 1).alias("distinct_in_bounds"), "median_in_bounds")


@query("""
    SELECT round(sum(total), 2) AS total, sum(rows)::BIGINT AS rows, l_returnflag FROM (
        SELECT l_returnflag, l_orderkey // 1000 AS slice, sum(l_extendedprice) AS total, count(*) AS rows
        FROM lineitem GROUP BY 1, 2) GROUP BY l_returnflag
""")
def id_range_totals(t):
    return A.summarise(t.lineitem, "l_returnflag", {
        "total": F.round(F.sum("l_extendedprice"), 2), "rows": F.count(F.lit(1)),
    })


@query("SELECT l_returnflag, true AS in_bounds FROM lineitem GROUP BY 1")
def sampled_total(t):
    """Totals from a tenth of the orders, within five standard errors of the true totals."""
    found = A.estimate_total(t.lineitem, "l_returnflag", "l_extendedprice", ["l_orderkey"], 0.1)
    per_order = t.lineitem.groupBy("l_returnflag", "l_orderkey").agg(F.sum("l_extendedprice").alias("v"))
    exact = per_order.groupBy("l_returnflag").agg(F.sum("v").alias("total"), F.sqrt(F.sum(F.col("v") * F.col("v")) * 9).alias("error"))
    return exact.join(found, "l_returnflag", "left").select(
        "l_returnflag", (F.abs(F.coalesce("estimated_total", F.lit(0.0)) - F.col("total")) <= 5 * F.col("error")).alias("in_bounds"))


@query("""
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1, 2
""")
def two_level_totals(t):
    dated = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_totalprice")
    coarse = {"month": F.trunc("day", "month"), "o_orderstatus": F.col("o_orderstatus")}
    return A.preaggregate(dated, ["day", "o_orderstatus"], coarse, "o_totalprice").withColumn("total", F.round("total", 2))


def _period_sql(unit):
    return f"""
        SELECT CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS period, round(sum(o_totalprice), 2) AS sales,
               count(*) AS transactions, count(DISTINCT o_custkey) AS customers
        FROM orders GROUP BY 1
    """


def _period(t, unit):
    return A.by_period(t.orders, "o_orderdate", unit, {
        "sales": F.round(F.sum("o_totalprice"), 2), "transactions": F.count(F.lit(1)),
        "customers": F.count_distinct("o_custkey"),
    })


@query(_period_sql("day"))
def daily_sales(t):
    return _period(t, "day")


@query(_period_sql("week"))
def weekly_sales(t):
    return _period(t, "week")


@query(_period_sql("month"))
def monthly_sales(t):
    return _period(t, "month")


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week,
           round(sum(o_totalprice), 2) AS weekly_sales
    FROM orders GROUP BY 1, 2
""")
def calendar_week_sales(t):
    return A.by_calendar_week(t.orders, "o_orderdate", {"weekly_sales": F.round(F.sum("o_totalprice"), 2)})


_MONTHS_SQL = """
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, sum(o_totalprice) AS total
               FROM orders GROUP BY 1)
"""


@query(_MONTHS_SQL + """
    SELECT period, round(total, 2) AS monthly_total, round(a, 4) AS moving_avg_3, round((total - a) * 100 / a, 4) AS trend_pct
    FROM (SELECT *, avg(total) OVER (ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS a FROM m)
""")
def monthly_moving_average(t):
    out = A.monthly_trend(t.orders, "o_orderdate", "o_totalprice")
    return out.select("period", F.round("monthly_total", 2).alias("monthly_total"),
                      F.round("moving_avg_3", 4).alias("moving_avg_3"), F.round("trend_pct", 4).alias("trend_pct"))


@query(_MONTHS_SQL + """
    SELECT a.period, round(a.total, 2) AS monthly_total, round(b.total, 2) AS prev_year_total,
           round((a.total - b.total) * 100 / b.total, 4) AS yoy_growth
    FROM m a LEFT JOIN m b ON a.period = b.period + INTERVAL 12 MONTH
""")
def year_over_year(t):
    out = A.yoy(t.orders, "o_orderdate", "o_totalprice")
    return out.select("period", F.round("monthly_total", 2).alias("monthly_total"),
                      F.round("prev_year_total", 2).alias("prev_year_total"), F.round("yoy_growth", 4).alias("yoy_growth"))


@query("""
    SELECT o_orderpriority, round(sum(CASE WHEN o_totalprice > 300000 THEN o_totalprice ELSE 0 END), 2) AS high_value_sales,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS completed_orders,
           round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 4) AS pending_avg,
           round(sum(o_totalprice) / count(DISTINCT o_custkey), 4) AS revenue_per_customer
    FROM orders GROUP BY 1
""")
def conditional_aggregates(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return A.summarise(t.orders, "o_orderpriority", {
        "high_value_sales": F.round(F.sum(F.when(price > 300000, price).otherwise(0.0)), 2),
        "completed_orders": F.count(F.when(status == "F", 1)),
        "pending_avg": F.round(F.avg(F.when(status == "P", price)), 4),
        "revenue_per_customer": F.round(F.try_divide(F.sum(price), F.count_distinct("o_custkey")), 4),
    })


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total_sales FROM lineitem GROUP BY 1")
def group_on_partition_key(t):
    """Partitioned by the key beforehand; the aggregation adds no second exchange."""
    return A.summarise(t.lineitem.select("l_suppkey", "l_extendedprice").repartition("l_suppkey"), "l_suppkey", {
        "total_sales": F.round(F.sum("l_extendedprice"), 2),
    })


@query("""
    SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS lines
    FROM lineitem WHERE l_quantity > 20 GROUP BY 1 ORDER BY revenue DESC
""")
def filter_group_order(t):
    lines = t.lineitem.filter(F.col("l_quantity") > 20).select(
        "l_suppkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")
    )
    out = A.summarise(lines, "l_suppkey", {"revenue": F.round(F.sum("net"), 4), "lines": F.count(F.lit(1))})
    return out.orderBy(F.desc("revenue"))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("SELECT user_id, event_type FROM events GROUP BY 1, 2")
def drop_duplicate_keys(t):
    return t.events.dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query("\n UNION ALL ".join(f"SELECT {q}::DOUBLE AS quantile, true AS in_bounds FROM lineitem HAVING count(*) > 0" for q in (0.1, 0.5, 0.9)))
def column_quantiles(t):
    """Quantiles at an error of 1 in 10,000, with their true ranks held against it."""
    found = A.quantiles(t.lineitem, "l_extendedprice", [0.1, 0.5, 0.9], error=0.0001)
    # Three rows, so every price is compared with three numbers where it is read.
    known = found.agg(F.map_from_entries(F.collect_list(F.struct("quantile", "value"))).alias("known"))
    prices = t.lineitem.select("l_extendedprice", F.explode(known.scalar()).alias("quantile", "value"))
    ranks = prices.groupBy("quantile").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_extendedprice") < F.col("value")).alias("below"),
        F.count_if(F.col("l_extendedprice") <= F.col("value")).alias("upto"))
    slack = F.col("n") * 0.0001 + 1
    at = F.col("n") * F.col("quantile")
    return ranks.select("quantile", ((F.col("upto") > F.col("below")) & (F.col("below") <= at + slack) & (F.col("upto") >= at - slack)).alias("in_bounds"))


def _pivoted(t):
    """One pair of status and flag has no price, so that its cell is empty."""
    priced = F.when(~((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A")), F.col("l_extendedprice"))
    lines = t.lineitem.select("l_linestatus", "l_returnflag", priced.alias("l_extendedprice"))
    return pivot_sum(lines, "l_linestatus", "l_returnflag", "l_extendedprice", FLAGS)


_PIVOT_SQL = """
    SELECT l_linestatus, {columns} FROM lineitem GROUP BY 1
""".format(columns=", ".join(
    f"round(sum(CASE WHEN l_returnflag = '{f}' AND NOT (l_linestatus = 'O' AND l_returnflag = 'A') THEN l_extendedprice END), 2) AS \"{f}\"" for f in FLAGS
))


@query(_PIVOT_SQL)
def pivot_totals(t):
    return _pivoted(t).select("l_linestatus", *[F.round(f, 2).alias(f) for f in FLAGS])


@query(f"UNPIVOT ({_PIVOT_SQL}) ON A, N, R INTO NAME flag VALUE total")
def unpivot_totals(t):
    wide = _pivoted(t)
    return unpivot(wide, "l_linestatus", FLAGS, "flag", "total").withColumn("total", F.round("total", 2))


@query("SELECT p_brand, " + ", ".join(f"count(CASE WHEN p_type = '{k}' THEN 1 END) AS \"{k}\"" for k in TYPES)
       + " FROM part GROUP BY 1")
def crosstab_counts(t):
    return crosstab(t.part, "p_brand", "p_type", TYPES)
