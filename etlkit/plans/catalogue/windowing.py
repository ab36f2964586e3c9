"""Window results over large, few groups: line items per return flag, in ship-date order."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.operators import windows as W
from etlkit.plans.catalogue.registry import query
from etlkit.plans.catalogue.relational import LINE_ID

_ID = ", ".join(LINE_ID)
_OVER = f"PARTITION BY l_returnflag ORDER BY l_shipdate, {_ID}"
# Small enough that the test tables span many blocks; the default is a million rows.
BLOCK = 5_000
# Averages of cents often end in exactly 5; this settles the direction in which both engines round.
TIE = 1e-8


def _lines(t):
    return t.lineitem.select("l_returnflag", "l_shipdate", *LINE_ID, "l_extendedprice", "l_quantity")


def _by_ship_date():
    """Cells of one flag: a day, then a range of order keys."""
    return W.Ordering(
        ["l_returnflag"], ["l_shipdate", *LINE_ID],
        [F.col("l_shipdate"), F.expr("l_orderkey div 1000000")],
    )


@query(f"""
    SELECT {_ID}, round(sum(l_extendedprice) OVER w, 2) AS total_sales, round(avg(l_extendedprice) OVER w, 4) AS avg_sales,
           min(l_extendedprice) OVER w AS min_sales, max(l_extendedprice) OVER w AS max_sales
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_linestatus)
""")
def group_stats_on_rows(t):
    v = "l_extendedprice"
    rows = t.lineitem.select("l_returnflag", "l_linestatus", *LINE_ID, v)
    return W.with_group_stats(rows, ["l_returnflag", "l_linestatus"], {
        "total_sales": F.round(F.sum(v), 2), "avg_sales": F.round(F.avg(v), 4), "min_sales": F.min(v), "max_sales": F.max(v),
    }, few=True).select(*LINE_ID, "total_sales", "avg_sales", "min_sales", "max_sales")


@query(f"""
    SELECT {_ID}, row_number() OVER (d, {_ID}) AS row_number, rank() OVER d AS rank, dense_rank() OVER d AS dense_rank,
           round(percent_rank() OVER d, 8) AS percent_rank, round(cume_dist() OVER d, 8) AS cume_dist,
           CAST(ntile(4) OVER (d, {_ID}) AS INTEGER) AS ntile
    FROM lineitem WINDOW d AS (PARTITION BY l_returnflag ORDER BY l_shipdate)
""".replace(f"(d, {_ID})", f"({_OVER})"))
def rankings_by_date(t):
    out = W.rankings(_lines(t), "l_returnflag", "l_shipdate", LINE_ID, fine=[F.expr("l_orderkey div 1000000")])
    return out.select(*LINE_ID, "row_number", "rank", "dense_rank", F.round("percent_rank", 8).alias("percent_rank"),
                      F.round("cume_dist", 8).alias("cume_dist"), "ntile")


@query(f"""
    SELECT {_ID}, dense_rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice DESC) AS sales_rank
    FROM lineitem
""")
def rank_by_value_descending(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", *LINE_ID, "l_extendedprice")
    out = W.rankings(
        rows, ["l_returnflag", "l_linestatus"], "l_extendedprice", LINE_ID,
        coarse=[F.floor(F.col("l_extendedprice") / 100)], descending=True,
    )
    return out.select(*LINE_ID, F.col("dense_rank").alias("sales_rank"))


@query(f"""
    SELECT {_ID}, lag(v) OVER w AS prev_value, lead(v) OVER w AS next_value, lag(v, 2) OVER w AS prev_2_value,
           round(v - lag(v) OVER w, 4) AS change, round((v - lag(v) OVER w) * 100 / lag(v) OVER w, 4) AS change_pct,
           CASE WHEN v > lag(v) OVER w THEN 'increasing' WHEN v < lag(v) OVER w THEN 'decreasing' ELSE 'stable' END AS trend
    FROM (SELECT *, l_extendedprice AS v FROM lineitem) WINDOW w AS ({_OVER})
""")
def lag_and_lead(t):
    out = W.deltas(_lines(t), _by_ship_date(), "l_extendedprice", BLOCK)
    return out.select(*LINE_ID, "prev_value", "next_value", "prev_2_value", F.round("change", 4).alias("change"),
                      F.round("change_pct", 4).alias("change_pct"), "trend")


@query(f"""
    SELECT {_ID}, round(avg(v) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) + 1e-8, 4) AS moving_avg_3,
           round(sum(v) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS moving_sum_7,
           max(v) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_max_3,
           min(v) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_min_3,
           round(stddev(v) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS moving_stddev_7
    FROM (SELECT *, l_extendedprice AS v FROM lineitem)
""".replace("(w ROWS", f"({_OVER} ROWS"))
def moving_aggregates(t):
    v = "l_extendedprice"
    out = W.moving(_lines(t), _by_ship_date(), {
        "moving_avg_3": ("avg", v, 3), "moving_sum_7": ("sum", v, 7), "moving_max_3": ("max", v, 3),
        "moving_min_3": ("min", v, 3), "moving_stddev_7": ("stddev", v, 7),
    }, BLOCK)
    return out.select(
        *LINE_ID, "moving_max_3", "moving_min_3", F.round(F.col("moving_avg_3") + TIE, 4).alias("moving_avg_3"),
        F.round("moving_sum_7", 2).alias("moving_sum_7"), F.round("moving_stddev_7", 2).alias("moving_stddev_7"),
    )


@query(f"""
    SELECT {_ID}, round(avg(l_extendedprice) OVER ({_OVER} ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) + 1e-8, 4) AS weekly_avg
    FROM lineitem
""")
def moving_average_8_rows(t):
    out = W.moving(_lines(t), _by_ship_date(), {"weekly_avg": ("avg", "l_extendedprice", 8)}, BLOCK)
    return out.select(*LINE_ID, F.round(F.col("weekly_avg") + TIE, 4).alias("weekly_avg"))


@query(f"""
    SELECT {_ID}, round(sum(v) OVER w, 2) AS running_total, count(v) OVER w AS running_count,
           round(avg(v) OVER w + 1e-8, 4) AS running_avg, max(v) OVER w AS running_max,
           round(sum(v) OVER w * 100 / sum(v) OVER (PARTITION BY l_returnflag), 6) AS cumulative_pct
    FROM (SELECT *, l_extendedprice AS v FROM lineitem)
    WINDOW w AS ({_OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def running_aggregates(t):
    out = W.running(_lines(t), _by_ship_date(), "l_extendedprice")
    return out.select(
        *LINE_ID, "running_count", "running_max", F.round("running_total", 2).alias("running_total"),
        F.round(F.col("running_avg") + TIE, 4).alias("running_avg"), F.round("cumulative_pct", 6).alias("cumulative_pct"),
    )


_ENDS_SQL = f"""
    SELECT {_ID}, first_value(l_extendedprice) OVER w AS first_value, last_value(l_extendedprice) OVER w AS last_value
    FROM lineitem WINDOW w AS ({_OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""


@query(_ENDS_SQL)
def first_and_last(t):
    out = W.first_last(_lines(t), "l_returnflag", ["l_shipdate", *LINE_ID], "l_extendedprice")
    return out.select(*LINE_ID, "first_value", "last_value")


@query(f"""
    SELECT {_ID}, first_value(l_extendedprice) OVER ({_OVER}) AS first_value,
           last_value(l_extendedprice) OVER (PARTITION BY l_returnflag, l_shipdate ORDER BY {_ID}
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value
    FROM lineitem
""")
def first_and_last_of_peers(t):
    out = W.first_last(_lines(t), "l_returnflag", ["l_shipdate", *LINE_ID], "l_extendedprice", frame="peers")
    return out.select(*LINE_ID, "first_value", "last_value")


@query("""
    SELECT event_id, round(sum(value) OVER w, 4) AS total_6h, count(*) OVER w AS events_6h, max(value) OVER w AS max_6h
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)
""")
def time_range_frames(t):
    """Pieces of frames put together, so that the work does not grow with the rows of a frame."""
    rows = t.events.select("event_id", "event_type", "ts", "value", F.lit(1).alias("row"))
    out = W.moving_range_split(rows, "event_type", "ts", 6 * 3600, {
        "total_6h": ("sum", "value"), "events_6h": ("count", "row"), "max_6h": ("max", "value"),
    })
    return out.select("event_id", F.round("total_6h", 4).alias("total_6h"), "events_6h", "max_6h")


@query("""
    SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER w) / nullif(stddev(o_totalprice) OVER w, 0), 6) AS z_score
    FROM orders WINDOW w AS (PARTITION BY o_custkey)
""")
def zscore_per_group(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return W.zscore(rows, "o_custkey", "o_totalprice").select("o_orderkey", F.round("z_score", 6).alias("z_score"))


@query("""
    SELECT event_id, round(sum(value) OVER w, 4) AS total_3d, count(value) OVER w AS events_3d, min(value) OVER w AS min_3d,
           max(value) OVER w AS max_3d, round(avg(value) OVER w, 10) AS avg_3d
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW)
""")
def time_range_frames_split(t):
    """Frames of three days over a few keys, no window over more than 20,000 rows of a cell."""
    frames = {"total_3d": ("sum", "value"), "events_3d": ("count", "value"), "min_3d": ("min", "value"), "max_3d": ("max", "value"), "avg_3d": ("avg", "value")}
    out = W.moving_range_split(t.events.select("event_id", "event_type", "ts", "value"), "event_type", "ts", 3 * 86_400, frames, rows=20_000)
    return out.select("event_id", F.round("total_3d", 4).alias("total_3d"), "events_3d", "min_3d", "max_3d", F.round("avg_3d", 10).alias("avg_3d"))
