"""Stored sketches against exact figures."""

import pytest
from pyspark.sql import functions as F

from etlkit.operators import sketches as S


def test_roll_up_of_stored_sketches(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") * 7 % 9_000).alias("k"), (F.col("id") * 13 % 1_000).cast("double").alias("v"))
    S.sketched(rows, "day", "k", "v").write.parquet(f"{tmp_path}/daily")
    daily = spark.read.parquet(f"{tmp_path}/daily")
    whole = S.rolled_up(daily, F.floor(F.col("day") / 10).alias("part"))
    assert all("daily" in f for f in whole.inputFiles())
    for r in S.estimates(whole, [0.1, 0.5, 0.9]).collect():
        part = rows.filter(F.floor(F.col("day") / 10) == r.part)
        assert r.n_rows == part.count() == 20_000
        assert r.distinct_keys == pytest.approx(part.select("k").distinct().count(), rel=5 * 1.04 / 64)
        for q, value in zip((0.1, 0.5, 0.9), r.quantiles):
            below, upto = part.agg(F.avg((F.col("v") < value).cast("int")), F.avg((F.col("v") <= value).cast("int"))).first()
            assert below <= q + S.RANK_ERROR and upto >= q - S.RANK_ERROR


def test_order_of_merging_changes_no_bound(spark):
    rows = spark.range(5_000).select((F.col("id") % 7).alias("d"), F.col("id").alias("k"), F.col("id").cast("double").alias("v"))
    twice = S.rolled_up(S.rolled_up(S.sketched(rows, "d", "k", "v"), (F.col("d") % 3).alias("d")), F.lit("all").alias("d"))
    r = S.estimates(twice).first()
    assert r.n_rows == 5_000 and r.distinct_keys == pytest.approx(5_000, rel=5 * 1.04 / 64) and r.quantiles[0] == pytest.approx(2_500, abs=5_000 * S.RANK_ERROR * 2)


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, None), (1, None, None)], "d int, k string, v double")
    r = S.estimates(S.sketched(rows, "d", "k", "v")).first()
    assert (r.n_rows, r.distinct_keys, r.quantiles) == (2, 0, None)
    assert S.estimates(S.sketched(rows.filter("d > 1"), "d", "k", "v")).count() == 0
