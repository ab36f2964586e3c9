"""Profiles, repairs, validation, cleaning, history and skew measurements."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators import history as H
from etlkit.operators import layout as L
from etlkit.operators import quality as Q
from etlkit.plans.catalogue.registry import query

# Orders with defects, made the same way for both engines from the whole table: every 20th customer
# missing, every 25th amount negative, every 40th date in the future, every 30th amount missing, and
# every 50th row twice.
_DEFECTS_SQL = """
    (SELECT o_orderkey AS transaction_id, CASE WHEN o_orderkey % 20 <> 0 THEN o_custkey END AS customer_id,
            CASE WHEN o_orderkey % 30 = 0 THEN NULL WHEN o_orderkey % 25 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
            CAST(CASE WHEN o_orderkey % 40 = 7 THEN DATE '2003-01-01' ELSE o_orderdate END AS DATE) AS transaction_date,
            ' ' || lower(o_orderpriority) || ' ' AS channel, o_orderstatus AS status
     FROM orders, (SELECT unnest([0, 1]) AS copy) WHERE copy = 0 OR o_orderkey % 50 = 0)
"""
_AS_OF = "2002-01-01"


def _defective_orders(t):
    key = F.col("o_orderkey")
    copies = F.explode(F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return t.orders.select(
        key.alias("transaction_id"), F.when(key % 20 != 0, F.col("o_custkey")).alias("customer_id"),
        F.when(key % 30 == 0, F.lit(None)).when(key % 25 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("amount"),
        F.when(key % 40 == 7, F.lit("2003-01-01").cast("date")).otherwise(F.to_date("o_orderdate")).alias("transaction_date"),
        F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")).alias("channel"), F.col("o_orderstatus").alias("status"),
        copies.alias("copy"),
    ).drop("copy")


_COLUMNS = ["transaction_id", "customer_id", "amount", "transaction_date", "channel", "status"]
_METRICS = {
    "total_records": ("count(*)", False), "total_columns": ("max(6)", False),
    "duplicate_rows": (f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_DEFECTS_SQL}))", True),
    **{f"nulls.{c}": (f"count(*) - count({c})", True) for c in _COLUMNS},
    "rule.negative_amounts": ("count(*) FILTER (amount < 0)", True),
    "rule.future_dates": (f"count(*) FILTER (transaction_date > DATE '{_AS_OF}')", True),
    "rule.invalid_customer_ids": ("count(*) FILTER (customer_id IS NULL)", True),
}


@query("\n UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST({e} AS BIGINT) AS value, "
    + (f"round(({e}) * 100.0 / count(*), 2)::DOUBLE" if share else "CAST(NULL AS DOUBLE)") + f" AS pct FROM {_DEFECTS_SQL}"
    for m, (e, share) in _METRICS.items()
))
def table_profile(t):
    return Q.profile(_defective_orders(t), {
        "negative_amounts": F.col("amount") < 0,
        "future_dates": F.col("transaction_date") > F.lit(_AS_OF).cast("date"),
        "invalid_customer_ids": F.col("customer_id").isNull(),
    })


@query("""
    SELECT c_custkey, coalesce(CASE WHEN c_custkey % 20 <> 0 THEN c_name END, 'UNKNOWN') AS name_cleaned,
           CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS amount_cleaned,
           CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment ELSE 'OTHER' END AS category
    FROM customer
""")
def repaired_nulls(t):
    rows = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 20 != 0, F.col("c_name")).alias("name"), "c_acctbal",
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")).alias("category"),
    )
    return Q.repair_nulls(rows, "name", "c_acctbal", {"category": "OTHER"}).drop("name", "c_acctbal")


@query("""
    SELECT p_partkey, count(*) OVER w AS duplicate_count, count(*) OVER w > 1 AS is_duplicate
    FROM part WINDOW w AS (PARTITION BY p_name, p_brand, p_type)
""")
def duplicate_marks(t):
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return Q.mark_duplicates(rows, ["p_name", "p_brand", "p_type"]).select("p_partkey", "duplicate_count", "is_duplicate")


@query("""
    SELECT doc_id, count(*) OVER (PARTITION BY md5(text)) AS duplicate_count, count(*) OVER (PARTITION BY md5(text)) > 1 AS is_duplicate
    FROM documents
""")
def duplicate_texts(t):
    """Copies of whole texts, compared by digest so that texts are not shuffled."""
    rows = t.documents.select("doc_id", F.md5("text").alias("digest"))
    return Q.mark_duplicates(rows, ["digest"]).drop("digest")


_IQR_SQL = """
    SELECT {key}, v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) AS is_outlier,
           round(CASE WHEN v > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1)
                      WHEN v < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1) ELSE v END, 4) AS capped
"""


@query(_IQR_SQL.format(key="event_id") + """
    FROM (SELECT event_id, value AS v FROM events),
         (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
""")
def outliers(t):
    out = Q.iqr_outliers(t.events.select("event_id", "value"), "value", exact=True)
    return out.select("event_id", "is_outlier", F.round("capped", 4).alias("capped"))


@query(_IQR_SQL.format(key="event_id") + """
    FROM (SELECT event_id, event_type, value AS v FROM events) JOIN
         (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
         USING (event_type)
""")
def outliers_by_group(t):
    rows = t.events.select("event_id", "event_type", "value")
    out = Q.iqr_outliers_by_group(rows, "event_type", "value", exact=True)
    return out.select("event_id", "is_outlier", F.round("capped", 4).alias("capped"))


@query("""
    SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 20 = 0 THEN 'MISSING_NAME' END,
                                CASE WHEN c_acctbal < 0 THEN 'NEGATIVE_AMOUNT' END) AS errors,
           NOT (c_custkey % 20 = 0 OR c_acctbal < 0) AS is_valid
    FROM customer
""")
def rule_validation(t):
    rows = t.customer.select(
        "c_custkey", F.when(F.col("c_custkey") % 40 == 0, F.lit(None)).when(F.col("c_custkey") % 20 == 0, "")
        .otherwise(F.col("c_name")).alias("name"), "c_acctbal",
    )
    out = Q.validate(rows, {
        "MISSING_NAME": F.col("name").isNull() | (F.col("name") == ""), "NEGATIVE_AMOUNT": F.col("c_acctbal") < 0,
    })
    return out.select("c_custkey", F.array_join("validation_errors", ",").alias("errors"), "is_valid")


_PLAN = Q.CleaningPlan(
    drop_nulls=("customer_id", "amount"), non_negative=("amount",), not_after_as_of=("transaction_date",),
    standardise={"channel": ("upper", "trim"), "status": ("upper", "trim")},
)
_KEEP = f"customer_id IS NOT NULL AND amount IS NOT NULL AND amount >= 0 AND transaction_date <= DATE '{_AS_OF}'"


@query(f"""
    SELECT DISTINCT transaction_id, customer_id, amount, transaction_date, trim(upper(channel)) AS channel, upper(status) AS status
    FROM {_DEFECTS_SQL} WHERE {_KEEP}
""")
def cleaned_rows(t):
    return Q.clean(_defective_orders(t), _PLAN, F.lit(_AS_OF).cast("date")).rows


@query(f"""
    WITH d AS (SELECT *, CASE WHEN customer_id IS NULL THEN 'null_customer_id' WHEN amount IS NULL THEN 'null_amount'
                              WHEN amount < 0 THEN 'negative_amount'
                              WHEN transaction_date > DATE '{_AS_OF}' THEN 'future_transaction_date' ELSE 'kept' END AS r
               FROM (SELECT DISTINCT * FROM {_DEFECTS_SQL})),
         n AS (SELECT (SELECT count(*) FROM {_DEFECTS_SQL}) AS a, (SELECT count(*) FROM d) AS b)
    SELECT 0 AS step, 'original' AS reason, a AS rows FROM n UNION ALL SELECT 1, 'duplicate', a - b FROM n
    UNION ALL SELECT 2, 'null_customer_id', count(*) FILTER (r = 'null_customer_id') FROM d
    UNION ALL SELECT 3, 'null_amount', count(*) FILTER (r = 'null_amount') FROM d
    UNION ALL SELECT 4, 'negative_amount', count(*) FILTER (r = 'negative_amount') FROM d
    UNION ALL SELECT 5, 'future_transaction_date', count(*) FILTER (r = 'future_transaction_date') FROM d
    UNION ALL SELECT 6, 'kept', count(*) FILTER (r = 'kept') FROM d
""")
def cleaning_statistics(t):
    return Q.clean(_defective_orders(t), _PLAN, F.lit(_AS_OF).cast("date")).stats


@query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_partkey % 40 = 0 THEN -l_partkey - 1 ELSE l_partkey END AS l_partkey
    FROM lineitem WHERE l_partkey % 40 = 0
""")
def orphan_rows(t):
    """Every 40th part key is made unknown before the check."""
    broken = F.when(F.col("l_partkey") % 40 == 0, -F.col("l_partkey") - 1).otherwise(F.col("l_partkey"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", broken.alias("l_partkey"))
    return Q.orphans(lines, t.part, "l_partkey", "p_partkey").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


@query(f"""
    SELECT transaction_id, CASE WHEN amount IS NULL THEN 'NULL_AMOUNT' WHEN amount <= 0 THEN 'INVALID_AMOUNT'
                                WHEN customer_id IS NULL THEN 'NULL_CUSTOMER' END AS error_reason,
           amount IS NOT NULL AND amount > 0 AND customer_id IS NOT NULL AS is_valid
    FROM {_DEFECTS_SQL}
""")
def dead_letters(t):
    return Q.dead_letter(_defective_orders(t)).select("transaction_id", "error_reason", "is_valid")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(round(o_totalprice) AS BIGINT) END AS amount_value,
           CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day_value,
           concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'amount' END, CASE WHEN o_orderkey % 11 = 0 THEN 'day' END) AS failed
    FROM orders
""")
def tolerant_conversion(t):
    key = F.col("o_orderkey")
    texts = t.orders.select(
        "o_orderkey", F.when(key % 7 == 0, "12x").otherwise(F.round("o_totalprice").cast("bigint").cast("string")).alias("amount"),
        F.when(key % 11 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    out = Q.try_convert(texts, {"amount": "bigint", "day": "date"})
    return out.select("o_orderkey", "amount_value", "day_value", F.array_join("failed_columns", ",").alias("failed"))


@query("""
    WITH s AS (SELECT c_custkey + 100 AS c_custkey, upper(c_name) AS c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_acctbal > 5000)
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s) UNION ALL SELECT * FROM s
""")
def upsert_by_key(t):
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    source = target.filter(F.col("c_acctbal") > 5000).select(
        (F.col("c_custkey") + 100).alias("c_custkey"), F.upper("c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal")
    )
    return H.upsert(target, source, "c_custkey")


@query("""
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS brand FROM customer
    UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part
""")
def append_new_columns(t):
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return H.append_columns(old, new)


@query("SELECT c_custkey AS customer_id, c_name, c_acctbal, c_acctbal * 2 AS doubled, 'batch' AS origin FROM customer")
def evolved_schema(t):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return H.evolve(rows, {"c_custkey": "customer_id"}, {"doubled": F.col("c_acctbal") * 2, "origin": F.lit("batch")})


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
        FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-30') WHERE n = 1
""")
def table_as_of(t):
    history = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    at = F.lit("1999-06-30").cast("timestamp_ntz")
    return H.as_of(history, "o_custkey", "o_orderdate", at, ["o_orderkey"])


def _skew_sql(a, b, c):
    return f"""
        WITH s AS (SELECT count(*) AS groups, min(n) AS min_size, max(n) AS max_size, avg(n) AS avg_size, stddev(n) AS sd,
                          max(n) / avg(n) AS r
                   FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1))
        SELECT groups, min_size, max_size, round(avg_size, 6) AS avg_size, round(sd, 6) AS stddev_size,
               round(r, 6) AS skew_ratio, round(sd / avg_size, 6) AS variation,
               CASE WHEN r < {a} THEN 'none' WHEN r < {b} THEN 'mild' WHEN r < {c} THEN 'moderate' ELSE 'high' END AS level,
               CASE WHEN r < {a} THEN 'excellent distribution' WHEN r < {b} THEN 'monitor'
                    WHEN r < {c} THEN 'consider salting' ELSE 'salt or repartition' END AS advice
        FROM s
    """


@query(_skew_sql(1.5, 2.5, 5))
def key_skew_report(t):
    out = L.key_skew(t.orders, "o_custkey")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_size", "stddev_size", "skew_ratio", "variation")})


@query("""
    WITH s AS (SELECT count(*) AS partitions, min(n) AS smallest, max(n) AS largest, avg(n) AS avg_rows,
                      count(*) FILTER (n < 200) AS small_partitions
               FROM (SELECT count(*) AS n FROM orders GROUP BY year(o_orderdate), month(o_orderdate)))
    SELECT partitions, smallest, largest, round(avg_rows, 6) AS avg_rows, small_partitions,
           round(small_partitions * 1.0 / partitions, 6)::DOUBLE AS small_share, small_partitions * 1.0 / partitions > 0.3 AS too_fine
    FROM s
""")
def partition_value_report(t):
    dated = t.orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    out = L.partition_value_sizes(dated, ["year", "month"], small=200)
    return out.withColumns({"avg_rows": F.round("avg_rows", 6), "small_share": F.round(F.col("small_share").cast("double"), 6)})


@query("SELECT count(*) AS rows, true AS nonempty, true AS once FROM lineitem")
def partition_size_list(t):
    """Partitions of the scan as it is: their sizes add up to the table, each is listed once and holds rows."""
    sizes = L.partition_sizes(t.lineitem.select("l_orderkey"))
    return sizes.agg(F.sum("rows").alias("rows"), F.every(F.col("rows") > 0).alias("nonempty"), (F.count_distinct("partition") == F.count(F.lit(1))).alias("once"))


@query("SELECT count(*) AS total_rows, greatest(1, count(*) // 100000) AS recommended_partitions, true AS consistent FROM lineitem")
def partition_balance(t):
    """Balance of the scan as it is: extremes, average, score and skew agree with each other."""
    b = L.balance(t.lineitem.select("l_suppkey"))
    agree = (F.col("min_rows") <= F.col("avg_rows")) & (F.col("avg_rows") <= F.col("max_rows")) & (
        F.abs(F.col("avg_rows") * F.col("partitions") - F.col("total_rows")) < 0.5) & (
        F.col("balance_score") == F.round(F.col("min_rows") * 100.0 / F.col("max_rows"), 2)) & (F.col("skew_ratio") >= 1)
    return b.select("total_rows", "recommended_partitions", agree.alias("consistent"))


@query("SELECT count(*) AS rows, true AS in_range, true AS consistent FROM orders")
def bucket_size_report(t):
    """Buckets that Spark's own bucketing would fill: they add up to the table and the ratio fits the sizes."""
    b = L.bucket_sizes(t.orders, ["o_custkey"], 16)
    ratio = F.max("rows") / F.avg("rows")
    return b.agg(F.sum("rows").alias("rows"), F.every(F.col("bucket").between(0, 15)).alias("in_range"), (F.abs(F.max("skew_ratio") - ratio) < 1e-9).alias("consistent"))


# Four keys (three of 8 bytes, one of 4), four doubles, two strings of 20 and a timestamp.
@query("SELECT count(*) AS rows, 108::BIGINT AS bytes_per_row, count(*) * 108 AS estimated_bytes FROM lineitem")
def size_estimate(t):
    return L.estimate_bytes(t.lineitem).drop("plan_bytes")
