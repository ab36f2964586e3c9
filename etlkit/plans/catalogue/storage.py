"""Tables written, changed and read back: versions, merges, compaction, skipping, pruning by a join."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators import sketches as S
from etlkit.operators.joins import join_pruned
from etlkit.plans.catalogue.registry import query
from etlkit.runtime import shared_dir
from etlkit.sinks import versions as V
from etlkit.sinks.files import append_evolving, read_evolving, write_files, zordered
from etlkit.sources.files import read_files


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query(f"""
    WITH s AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
                      o_totalprice + 1 AS o_totalprice, o_orderpriority
               FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) * 0.9 FROM orders))
    SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s
""")
def merge_touched_files(t):
    """The dearest tenth of the order keys is updated or, every seventh, inserted under a new key."""
    path = shared_dir(t.spark, "merged")
    V.create(_orders(t).repartitionByRange(16, "o_orderkey"), path, stats=["o_orderkey"])
    high = t.orders.agg(F.max("o_orderkey") * 0.9).first()[0]
    key = F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    source = _orders(t).filter(F.col("o_orderkey") > high).withColumns({"o_orderkey": key, "o_totalprice": F.col("o_totalprice") + 1})
    V.merge(source, path, "o_orderkey")
    return V.read_version(t.spark, path)


@query(f"SELECT {_ORDER_COLUMNS} FROM orders")
def version_before_a_merge(t):
    """The table as it was before rows were changed: versions stay readable."""
    path = shared_dir(t.spark, "merged")
    V.create(_orders(t).repartitionByRange(8, "o_orderkey"), path, stats=["o_orderkey"])
    V.merge(_orders(t).filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0)), path, "o_orderkey")
    return V.read_version(t.spark, path, 0)


@query(f"SELECT {_ORDER_COLUMNS} FROM orders")
def compact_packed_files(t):
    """Small files of two appends packed by partition; the rows are the same."""
    path = shared_dir(t.spark, "packed")
    third = lambda k: _orders(t).filter(F.pmod("o_orderkey", F.lit(3)) == k)
    V.create(third(0).repartition(4), path, ["o_orderstatus"])
    for k in (1, 2):
        V.append(third(k).repartition(3), path)
    V.compact_small(t.spark, path, target_mb=64)
    return V.read_version(t.spark, path)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
    WHERE l_extendedprice BETWEEN 20000 AND 24000 AND l_quantity BETWEEN 10 AND 20
""")
def skip_by_statistics(t):
    """Files clustered on two columns; those whose smallest and largest values miss the filter are not opened."""
    path = shared_dir(t.spark, "skipping")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    V.create(zordered(lines, ["l_extendedprice", "l_quantity"], 32), path, stats=["l_extendedprice", "l_quantity"])
    return V.read_version(t.spark, path, where={"l_extendedprice": (20000.0, 24000.0), "l_quantity": (10.0, 20.0)})


@query("""
    SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem
    WHERE strftime(l_shipdate, '%Y-%m') IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01')
    GROUP BY 1
""")
def join_pruned_partitions(t):
    """Lines stored by month, joined with the months of a few orders: only these partitions are read."""
    path = shared_dir(t.spark, "by-month")
    month = lambda c: F.date_format(c, "yyyy-MM")
    t.lineitem.select("l_extendedprice", month("l_shipdate").alias("ship_month")).repartition("ship_month").write.partitionBy("ship_month").parquet(path)
    # As a table, so that the months are a scan with a filter that Spark can turn into one of partitions.
    calendar = shared_dir(t.spark, "calendar")
    t.orders.groupBy(month("o_orderdate").alias("ship_month")).agg(F.min("o_orderdate").alias("first_day")).write.parquet(calendar)
    months = t.spark.read.parquet(calendar).filter("first_day >= '1997-01-01' AND first_day < '1997-04-01'").select("ship_month")
    fact = t.spark.read.schema("l_extendedprice double, ship_month string").parquet(path)
    return join_pruned(fact, months, "ship_month").groupBy("ship_month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


def _round_trip(t, fmt, **options):
    path = shared_dir(t.spark, f"round-{fmt}")
    write_files(_orders(t), path, fmt)
    return read_files(t.spark, path, fmt, **options)


@query(f"SELECT {_ORDER_COLUMNS} FROM orders")
def read_orc_files(t):
    return _round_trip(t, "orc")


@query(f"SELECT {_ORDER_COLUMNS} FROM orders WHERE o_orderstatus = 'F'")
def read_json_files(t):
    return _round_trip(t, "json", schema=_orders(t).schema, where=F.col("o_orderstatus") == "F")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def read_csv_files(t):
    return _round_trip(t, "csv", schema=_orders(t).schema, columns=["o_orderkey", "o_totalprice"])


@query("""
    SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 2 <> 0
""")
def read_merged_schemas(t):
    """Two folders of files, one with a column more."""
    path = shared_dir(t.spark, "merged-schemas")
    _orders(t).filter("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice").write.parquet(f"{path}/part=0")
    _orders(t).filter("o_orderkey % 2 <> 0").select("o_orderkey", "o_totalprice", "o_orderpriority").write.parquet(f"{path}/part=1")
    return read_files(t.spark, path, merge_schema=True, glob="*.parquet").drop("part")


@query("""
    SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, floor(o_totalprice)::DOUBLE, o_orderpriority FROM orders WHERE o_orderkey % 3 = 1
    UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderkey % 3 = 2
""")
def append_widened(t):
    """Appends with an int beside a double, an int beside a long and a column more."""
    path = shared_dir(t.spark, "widened")
    third = lambda k: _orders(t).filter(F.pmod("o_orderkey", F.lit(3)) == k)
    append_evolving(third(0).select(F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_totalprice"), path)
    append_evolving(third(1).select("o_orderkey", F.floor("o_totalprice").cast("int").alias("o_totalprice"), "o_orderpriority"), path)
    append_evolving(third(2).select("o_orderkey", "o_totalprice"), path)
    return read_evolving(t.spark, path)


@query("""
    SELECT 'month' AS period, date_trunc('month', ts)::DATE AS first_day, count(*) AS n_rows, count(DISTINCT user_id) AS users, true AS users_in_bounds, true AS median_in_bounds FROM events GROUP BY 2
    UNION ALL SELECT 'week', date_trunc('week', ts)::DATE, count(*), count(DISTINCT user_id), true, true FROM events GROUP BY 2
""")
def sketch_rollup(t):
    """Daily sketches, stored and rolled up to weeks and months; exact figures beside them tell whether they hold.

    A distinct count may be five standard errors off, a median as far as its rank may be.
    """
    path = shared_dir(t.spark, "daily-sketches")
    S.sketched(t.events.withColumn("day", F.to_date("ts")), "day", "user_id", "value").write.parquet(path)
    daily = t.spark.read.parquet(path)
    low, high = 0.5 - S.RANK_ERROR, 0.5 + S.RANK_ERROR
    out = None
    for period in ("month", "week"):
        start = lambda c, unit=period: F.to_date(F.date_trunc(unit, c)).alias("first_day")
        found = S.estimates(S.rolled_up(daily, start("day")))
        exact = t.events.groupBy(start("ts")).agg(F.count_distinct("user_id").alias("users"))
        ranks = t.events.select(start("ts"), "value").join(found.select("first_day", F.col("quantiles")[0].alias("median")), "first_day").groupBy("first_day").agg(
            F.avg((F.col("value") < F.col("median")).cast("int")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("upto"))
        both = found.join(exact, "first_day").join(ranks, "first_day").select(
            F.lit(period).alias("period"), "first_day", "n_rows", "users",
            (F.abs(F.col("distinct_keys") - F.col("users")) <= 5 * 1.04 / 64 * F.col("users") + 1).alias("users_in_bounds"),
            ((F.col("below") <= high) & (F.col("upto") >= low)).alias("median_in_bounds"))
        out = both if out is None else out.unionByName(both)
    return out
