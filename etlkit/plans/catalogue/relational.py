"""Scans, projections, filters, joins, set operations, sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators.joins import (
    bucketed_join, bucketed_join_split, copartitioned_join, deviation_from_group, interval_join, join_auto, join_chain,
    join_dim, join_with, matched, star_join, unmatched,
)
from etlkit.operators.relational import (
    describe, sample, sample_by_key, top, top_k_per_group, top_keys, union_alerts, union_all,
    with_slice, with_tier,
)
from etlkit.plans.catalogue.registry import query
from etlkit.runtime import plan_bytes, scratch_table, shared_dir
from etlkit.sinks.files import write_bucketed
from etlkit.sources.files import read_files
from etlkit.streaming.events import enrich, fraud_scores, high_value_alerts

LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1998-01-01'
""")
def scan_pruned(t):
    where = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return read_files(t.spark, t.file("orders"), columns=["o_orderkey", "o_totalprice"], where=where)


@query("""
    SELECT l_orderkey, l_linenumber, upper(l_returnflag) AS flag_upper,
           l_extendedprice * l_extendedprice AS value_squared
    FROM lineitem WHERE l_extendedprice > 20000 AND year(l_shipdate) >= 1998
""")
def early_projection(t):
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_shipdate")
        .withColumns({
            "value_squared": F.col("l_extendedprice") * F.col("l_extendedprice"),
            "flag_upper": F.upper("l_returnflag"),
            "year": F.year("l_shipdate"),
        })
        .filter(F.col("l_extendedprice") > 20000).filter(F.col("year") >= 1998)
        .select("l_orderkey", "l_linenumber", "flag_upper", "value_squared")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity > 10 AND l_discount >= 0.05 AND l_linestatus = 'F'
      AND l_shipdate >= TIMESTAMP '1999-01-01'
""")
def conjunctive_filter(t):
    return t.lineitem.filter(
        (F.col("l_quantity") > 10) & (F.col("l_discount") >= 0.05) & (F.col("l_linestatus") == "F")
        & (F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def set_membership(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("""
    SELECT p_partkey, p_type, CASE WHEN p_type LIKE '%ECONOMY%' THEN 'premium' ELSE 'standard' END AS type_class
    FROM part WHERE p_name LIKE '%ring%'
""")
def pattern_predicate(t):
    return t.part.filter(F.col("p_name").like("%ring%")).select(
        "p_partkey", "p_type",
        F.when(F.col("p_type").like("%ECONOMY%"), "premium").otherwise("standard").alias("type_class"),
    )


_GAPS_SQL = """
    SELECT c_custkey, c_acctbal,
           CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 20 = 1 THEN '' ELSE c_mktsegment END AS segment,
           CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_acctbal END AS balance
    FROM customer
"""


def _customers_with_gaps(t):
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", "c_acctbal",
        F.when(key % 20 == 0, F.lit(None)).when(key % 20 == 1, "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(key % 15 != 0, F.col("c_acctbal")).alias("balance"),
    )


@query(f"""
    SELECT c_custkey, segment IS NULL AS is_missing, segment = '' AS is_blank FROM ({_GAPS_SQL})
    WHERE segment IS NULL OR segment = '' OR balance IS NULL
""")
def null_predicates(t):
    rows = _customers_with_gaps(t)
    bad = F.col("segment").isNull() | (F.col("segment") == "") | F.col("balance").isNull()
    return rows.filter(bad).select(
        "c_custkey", F.col("segment").isNull().alias("is_missing"), (F.col("segment") == "").alias("is_blank")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_extendedprice > 50000 THEN 'high' WHEN l_extendedprice > 10000 THEN 'medium' ELSE 'low' END
             AS value_tier
    FROM lineitem
""")
def value_tiers(t):
    rows = t.lineitem.select(*LINE_ID, "l_extendedprice")
    tiers = [(50_000, "high"), (10_000, "medium")]
    return with_tier(rows, "l_extendedprice", tiers, "low", "value_tier").drop("l_extendedprice")


@query(f"""
    SELECT c_custkey, coalesce(segment, 'OTHER') AS segment, coalesce(balance, 0.0) AS balance,
           coalesce(balance, -c_acctbal) AS either
    FROM ({_GAPS_SQL})
""")
def null_defaults(t):
    rows = _customers_with_gaps(t).withColumn("either", F.coalesce("balance", -F.col("c_acctbal")))
    return rows.fillna({"segment": "OTHER", "balance": 0.0}).drop("c_acctbal")


@query(f"SELECT c_custkey, segment, balance FROM ({_GAPS_SQL}) WHERE segment IS NOT NULL AND balance IS NOT NULL")
def drop_null_rows(t):
    return _customers_with_gaps(t).drop("c_acctbal").na.drop(subset=["segment", "balance"])


@query("""
    SELECT p_partkey AS product_id, CAST(p_size AS BIGINT) AS size, CAST(p_retailprice AS DECIMAL(10, 2)) AS price,
           p_brand, p_name
    FROM part
""")
def rename_drop_cast(t):
    return (
        t.part.withColumnsRenamed({"p_partkey": "product_id", "p_size": "size", "p_retailprice": "price"})
        .drop("p_type").withColumns({"size": F.col("size").cast("bigint"), "price": F.col("price").cast("decimal(10,2)")})
        .select("product_id", "size", "price", "p_brand", "p_name")
    )


_SAMPLE_SQL = "SELECT count(*) AS rows, true AS all_from_table, true AS size_in_bounds FROM orders"


def _sample_checked(t, kept, unit):
    """A tenth of the orders held against the table: every kept row is one of it, and their number is in five deviations."""
    inside = t.orders.select("o_orderkey", F.col(unit).alias("u"), F.lit(1).alias("whole")).join(
        kept.select("o_orderkey", F.lit(1).alias("kept")), "o_orderkey", "full")
    per_unit = inside.groupBy("u").agg(F.count("whole").alias("n"), F.count("kept").alias("k"), F.count_if(F.col("whole").isNull()).alias("alien"))
    bound = 5 * F.sqrt(0.1 * 0.9 * F.sum(F.col("n") * F.col("n"))) + 1
    return per_unit.agg(
        F.sum("n").alias("rows"), (F.sum("alien") == 0).alias("all_from_table"), (F.abs(F.sum("k") - 0.1 * F.sum("n")) <= bound).alias("size_in_bounds"))


@query(_SAMPLE_SQL)
def bernoulli_sample(t):
    return _sample_checked(t, sample(t.orders, 0.1, seed=7), "o_orderkey")


@query(_SAMPLE_SQL.replace(" FROM", ", true AS keys_whole FROM"))
def hash_sample(t):
    """The sample takes or leaves all orders of a customer."""
    kept = sample_by_key(t.orders, "o_custkey", 0.1)
    per_key = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).join(
        kept.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k")), "o_custkey")
    whole = per_key.agg(F.coalesce(F.every(F.col("n") == F.col("k")), F.lit(True)).alias("keys_whole"))
    return _sample_checked(t, kept, "o_custkey").withColumn("keys_whole", whole.scalar())


@query("\n UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS stddev,
           min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM lineitem
""" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def column_summary(t):
    out = describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("""
    SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS slice, count(*) AS rows, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
""")
def range_slices(t):
    return with_slice(t.orders, "o_orderkey", 1000).groupBy("slice").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


_PART_JOIN_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, p_type
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def _lines_and_parts(t):
    return (
        t.lineitem.select(*LINE_ID, "l_extendedprice"),
        t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"),
    )


@query(_PART_JOIN_SQL)
def join_broadcast_checked(t):
    lines, parts = _lines_and_parts(t)
    return join_dim(lines, parts, "l_partkey")


@query(_PART_JOIN_SQL)
def join_sort_merge(t):
    lines, parts = _lines_and_parts(t)
    return join_with(lines, parts, "l_partkey", "merge")


@query(_PART_JOIN_SQL)
def join_shuffle_hash(t):
    lines, parts = _lines_and_parts(t)
    return join_with(lines, parts, "l_partkey", "shuffle_hash")


@query("""
    SELECT o_orderkey, o_totalprice, c_name, n_name, r_name
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey
""")
def join_in_order(t):
    nation = t.nation.withColumnRenamed("n_regionkey", "r_regionkey")
    customer = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_custkey").alias("o_custkey"), "c_name")
    chain = join_chain(t.region, (nation, "r_regionkey"), (customer, "n_nationkey"), (t.orders, "o_custkey"))
    return chain.select("o_orderkey", "o_totalprice", "c_name", "n_name", "r_name")


_ORDER_JOIN_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, o_orderstatus, o_totalprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def _lines_and_orders(t):
    return (
        t.lineitem.select(*LINE_ID, "l_quantity"),
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice"),
    )


@query(_ORDER_JOIN_SQL)
def join_copartitioned(t):
    lines, orders = _lines_and_orders(t)
    return copartitioned_join(lines, orders, "l_orderkey", LINE_ID)


# Three quarters of all rows get one of three keys, so hot keys are split in this query.
@query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, p_partkey, p_brand
    FROM lineitem JOIN part ON p_partkey = CASE WHEN l_linenumber <= 3 THEN l_linenumber ELSE l_partkey END
""")
def join_hot_keys(t):
    key = F.when(F.col("l_linenumber") <= 3, F.col("l_linenumber").cast("bigint")).otherwise(F.col("l_partkey"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", key.alias("p_partkey"))
    joined = copartitioned_join(lines, t.part.select("p_partkey", "p_brand"), "p_partkey", LINE_ID)
    return joined.drop("l_partkey")


@query(_ORDER_JOIN_SQL)
def join_size_adaptive(t):
    lines, orders = _lines_and_orders(t)
    return join_auto(lines, orders, "l_orderkey", LINE_ID, limit=1024)


@query(_ORDER_JOIN_SQL)
def join_bucketed(t):
    """Both tables bucketed alike; ``clear_scratch`` drops them."""
    lines, orders = _lines_and_orders(t)
    # A bucket for every 128 MB of the larger side, and at least one for each core.
    buckets = max(t.spark.sparkContext.defaultParallelism, -(-plan_bytes(lines) // (128 * 1024 * 1024)))
    base = shared_dir(t.spark, "buckets")
    tag = base.rsplit("-", 1)[1]
    tables = []
    for name, df in (("lines", lines), ("orders", orders)):
        tables.append(scratch_table(f"etlkit_{name}_{tag}"))
        write_bucketed(df, tables[-1], "l_orderkey", buckets, sort_by="l_orderkey", path=f"{base}/{name}")
    return bucketed_join(t.spark, *tables, "l_orderkey")


# Four fifths of the lines get one order key.
@query("""
    SELECT l.key AS l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus
    FROM (SELECT *, CASE WHEN l_partkey % 5 > 0 THEN (SELECT min(o_orderkey) FROM orders) ELSE l_orderkey END AS key FROM lineitem) l
    JOIN orders ON l.key = o_orderkey
""")
def join_bucketed_hot_key(t):
    """Cold keys join bucket by bucket, the hot one with salts."""
    lines, orders = _lines_and_orders(t)
    one = orders.agg(F.min("l_orderkey")).first()[0]
    skewed = lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 5 > 0, F.lit(one)).otherwise(F.col("l_orderkey")))
    base = shared_dir(t.spark, "hot-buckets")
    tables = []
    for name, df in (("lines", skewed), ("orders", orders)):
        tables.append(scratch_table(f"etlkit_hot_{name}_{base.rsplit('-', 1)[1]}"))
        write_bucketed(df, tables[-1], "l_orderkey", t.spark.sparkContext.defaultParallelism, sort_by="l_orderkey", path=f"{base}/{name}")
    out = bucketed_join_split(t.spark, *tables, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"], share=0.05)
    return out.select(*LINE_ID, "o_orderstatus")


def _geography(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


def _star(t, how):
    customers = join_dim(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), _geography(t), "n_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("r_name").alias("region")
    )
    suppliers = join_dim(t.supplier.withColumnRenamed("s_nationkey", "n_nationkey"), _geography(t), "n_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("store_region")
    )
    # Every 50th part and supplier key is unknown to its dimension.
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_partkey") % 50 == 0, -1).otherwise(F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("l_suppkey") % 50 == 0, -1).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
    )
    fact = lines.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return star_join(fact, [(customers, "o_custkey"), (parts, "l_partkey"), (suppliers, "l_suppkey")], how).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "c_mktsegment", "region", "p_type",
        "store_region",
    )


def _star_sql(how):
    return f"""
        SELECT l_orderkey, l_linenumber, l.partkey AS l_partkey, l.suppkey AS l_suppkey, l_extendedprice, c_mktsegment,
               cr.r_name AS region, p_type, s.r_name AS store_region
        FROM (SELECT *, CASE WHEN l_partkey % 50 = 0 THEN -1 ELSE l_partkey END AS partkey,
                     CASE WHEN l_suppkey % 50 = 0 THEN -1 ELSE l_suppkey END AS suppkey FROM lineitem) l
        JOIN orders ON l_orderkey = o_orderkey
        {how} JOIN (SELECT c_custkey, c_mktsegment, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey) cr ON o_custkey = c_custkey
        {how} JOIN part ON l.partkey = p_partkey
        {how} JOIN (SELECT s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey) s ON l.suppkey = s_suppkey
    """


@query(_star_sql("LEFT"))
def star_join_left(t):
    return _star(t, "left")


@query(_star_sql(""))
def star_join_inner(t):
    return _star(t, "inner")


@query("""
    SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, lang, quality
    FROM documents d FULL JOIN (SELECT doc_id + 300 AS doc_id, quality FROM labels) l ON d.doc_id = l.doc_id
""")
def join_full_outer(t):
    shifted = t.labels.select((F.col("doc_id") + 300).alias("doc_id"), "quality")
    return t.documents.select("doc_id", "lang").join(shifted, "doc_id", "full")


@query("""
    SELECT o_orderkey, round(a.avg_price, 4) AS group_avg, round(abs(o_totalprice - a.avg_price), 4) AS deviation
    FROM orders o JOIN (SELECT o_orderpriority, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1) a
      ON o.o_orderpriority = a.o_orderpriority
""")
def group_deviation(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return deviation_from_group(rows, "o_orderpriority", "o_totalprice").select(
        "o_orderkey", F.round("group_avg", 4).alias("group_avg"), F.round("deviation", 4).alias("deviation")
    )


@query("""
    SELECT c_custkey, c_name FROM customer c
    WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
""")
def semi_join_exists(t):
    big = t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return matched(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49 AND l_discount > 0.08)
""")
def semi_join_in(t):
    lines = t.lineitem.filter((F.col("l_quantity") >= 49) & (F.col("l_discount") > 0.08))
    return matched(t.part.select("p_partkey", "p_name"), lines.select(F.col("l_partkey").alias("p_partkey")), "p_partkey")


@query("""
    WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(o_totalprice) AS total
               FROM orders GROUP BY 1, 2)
    SELECT a.o_custkey, a.month, round(a.total, 2) AS total, round(b.total, 2) AS next_total
    FROM m a JOIN m b ON a.o_custkey = b.o_custkey AND b.month = a.month + INTERVAL 1 MONTH
""")
def self_join(t):
    """Each customer's month next to the same customer's following month."""
    months = t.orders.groupBy(
        "o_custkey", F.trunc(F.to_date("o_orderdate"), "month").alias("month")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    following = months.select("o_custkey", F.add_months("month", -1).alias("month"), F.col("total").alias("next_total"))
    return months.join(following, ["o_custkey", "month"])


@query("""
    WITH kinds AS (SELECT event_type, count(*) AS type_rows, round(avg(value), 4) AS type_avg FROM events GROUP BY 1)
    SELECT event_id, event_type, value, type_rows, type_avg FROM events JOIN kinds USING (event_type)
""")
def enrich_lookup(t):
    kinds = t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("type_rows"), F.round(F.avg("value"), 4).alias("type_avg")
    )
    return enrich(t.events.select("event_id", "event_type", "value"), kinds, "event_type")


def _two_event_sides(events):
    left = events.select("user_id", "event_id", "ts", "value")
    right = events.select(
        "user_id", F.col("event_id").alias("other_id"), (F.col("ts") - F.expr("INTERVAL 1 MINUTE")).alias("other_ts"),
        F.col("value").alias("previous_value"),
    )
    return left, right


_INTERVAL_SQL = """
    SELECT a.user_id, a.event_id, a.value, b.event_id AS other_id, b.value AS previous_value
    FROM events a {how} JOIN (SELECT event_id, user_id, value, ts - INTERVAL 1 MINUTE AS ts FROM events) b
      ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 2 MINUTE AND b.ts <= a.ts + INTERVAL 2 MINUTE
"""


@query(_INTERVAL_SQL.format(how=""))
def interval_join_inner(t):
    left, right = _two_event_sides(t.events)
    return interval_join(left, right, "user_id", "ts", "other_ts", 120, 120).drop("ts", "other_ts")


@query(_INTERVAL_SQL.format(how="LEFT").replace("- INTERVAL 1 MINUTE", "+ INTERVAL 5 MINUTE"))
def interval_join_left(t):
    left, right = _two_event_sides(t.events)
    right = right.withColumn("other_ts", F.col("other_ts") + F.expr("INTERVAL 6 MINUTES"))
    return interval_join(left, right, "user_id", "ts", "other_ts", 120, 120, "left").drop("ts", "other_ts")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_join(t):
    big = t.orders.filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return unmatched(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query("""
    SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier
""")
def union_by_name(t):
    customers = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"),
        F.lit("supplier").alias("kind"),
    )
    return union_all(customers, suppliers)


@query("""
    WITH high AS (SELECT event_id, user_id, value AS amount, CAST(NULL AS DOUBLE) AS fraud_score
                  FROM events WHERE value > 200),
         fraud AS (SELECT CAST(NULL AS BIGINT) AS event_id, user_id, CAST(NULL AS DOUBLE) AS amount,
                          round(count(*) * 0.3 + sum(value) / 1000 * 0.7, 6) AS fraud_score
                   FROM events GROUP BY user_id, date_trunc('hour', ts)
                   HAVING (count(*) > 2 OR sum(value) > 300) AND count(*) * 0.3 + sum(value) / 1000 * 0.7 > 0.4)
    SELECT *, CASE WHEN amount > 300 THEN 'CRITICAL' WHEN fraud_score > 1 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_severity
    FROM (SELECT * FROM high UNION ALL SELECT * FROM fraud)
""")
def union_of_alerts(t):
    high = high_value_alerts(t.events, "value", 200).select("event_id", "user_id", F.col("value").alias("amount"))
    fraud = fraud_scores(t.events, "ts", "user_id", "value", "1 hour", 2, 300, 0.4).select(
        "user_id", F.round("fraud_score", 6).alias("fraud_score")
    )
    return union_alerts(high, fraud, critical=300, high=1)


@query("""
    SELECT p_partkey, array_to_string(list_sort(list_distinct([p_brand, p_type] || ['SMALL', p_brand])), ',') AS tags
    FROM part
""")
def array_union_tags(t):
    tags = F.array_union(F.array("p_brand", "p_type"), F.array(F.lit("SMALL"), F.col("p_brand")))
    return t.part.select("p_partkey", F.array_join(F.array_sort(tags), ",").alias("tags"))


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey")
def global_order(t):
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy("o_orderdate", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_orders(t):
    return top(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 100)


@query("""
    SELECT * FROM (SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, CAST(row_number() OVER (
        PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS INTEGER)
        AS rank_in_group FROM lineitem) WHERE rank_in_group <= 10
""")
def top_per_group(t):
    order = [F.desc("l_extendedprice"), *[F.asc(c) for c in LINE_ID]]
    rows = t.lineitem.select("l_returnflag", *LINE_ID, "l_extendedprice")
    return top_k_per_group(rows, "l_returnflag", order, 10).drop("l_partkey", "l_suppkey")


@query("SELECT l_partkey, count(*) AS rows FROM lineitem GROUP BY 1 ORDER BY rows DESC, l_partkey LIMIT 20")
def most_frequent_keys(t):
    return top_keys(t.lineitem, "l_partkey", 20)
