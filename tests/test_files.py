"""Readers and writers, read back."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, initial_plan, rows
from etlkit.runtime import shared_dir
from etlkit.sinks import files as S
from etlkit.sources import files as R


@pytest.fixture()
def sales(spark):
    return spark.range(1000).select(
        F.col("id"), (F.col("id") % 7).alias("k"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("region"),
        (F.col("id") % 2 + 2023).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"),
        (F.col("id") * 1.5).alias("amount"),
    )


def parts(path):
    return [f for f in glob.glob(f"{path}/**/part-*", recursive=True)]


def unique(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def test_pruned_scan(spark, sales, tmp_path):
    S.write_files(sales, f"{tmp_path}/p")
    df = R.read_files(spark, f"{tmp_path}/p", columns=["id", "amount"], where=F.col("year") == 2024)
    plan = initial_plan(df)
    assert "EqualTo(year,2024)" in plan and "ReadSchema: struct<id:bigint,year:int,amount:double>" in plan
    assert df.count() == 500


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats_round_trip(spark, sales, tmp_path, fmt):
    S.write_files(sales, f"{tmp_path}/{fmt}", fmt)
    back = R.read_files(spark, f"{tmp_path}/{fmt}", fmt, schema=sales.schema if fmt in R.NEED_SCHEMA else None)
    assert rows(back.select(sales.columns)) == rows(sales)


def test_codecs_and_sizes(spark, sales, tmp_path):
    paths = S.write_codecs(sales, f"{tmp_path}/codecs")
    assert set(paths) == set(S.CODECS) and all(spark.read.parquet(p).count() == 1000 for p in paths.values())
    sizes = S.write_formats(sales, f"{tmp_path}/formats")
    assert set(sizes) == {"parquet", "orc", "json", "csv"} and min(sizes.values()) > 0


def test_reader_checks(spark, tmp_path):
    with pytest.raises(ValueError, match="schema"):
        R.read_files(spark, "x", "csv")
    with pytest.raises(ValueError, match="format"):
        R.read_files(spark, "x", "xml")
    for fmt in R.PACKAGED:
        with pytest.raises(ValueError, match="package"):
            R.read_files(spark, str(tmp_path), fmt)


def test_merged_schema_and_glob(spark, sales, tmp_path):
    path = f"{tmp_path}/evolving"
    S.append_evolving(sales.select("id"), path)
    S.append_evolving(sales.select("id", F.lit("x").alias("extra")), path)
    both = R.read_files(spark, path, merge_schema=True)
    assert sorted(both.columns) == ["extra", "id"] and both.filter("extra is null").count() == 1000
    assert R.read_files(spark, path, glob="*.none", schema="id bigint").count() == 0


def test_sized_write(spark, sales, tmp_path):
    S.write_sized(sales.repartition(40), f"{tmp_path}/s", target_rows=300)
    files = parts(f"{tmp_path}/s")
    assert len(files) == 4
    assert max(spark.read.parquet(f).count() for f in files) == 300
    with pytest.raises(ValueError):
        S.write_sized(sales, "x")


def test_compaction_keeps_rows(spark, sales, tmp_path):
    sales.repartition(30).write.parquet(f"{tmp_path}/small")
    out = S.compact(spark, f"{tmp_path}/small")
    assert len(parts(out)) == 1 and rows(spark.read.parquet(out)) == rows(sales)
    assert len(parts(f"{tmp_path}/small")) == 30


def test_partitioned_write_replaces_only_its_partitions(spark, sales, tmp_path):
    path = f"{tmp_path}/by_year"
    S.write_partitioned(sales, ["year"], path=path)
    S.write_partitioned(sales.filter("year = 2024").limit(5), ["year"], path=path)
    counts = {r.year: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()}
    assert counts == {2023: 500, 2024: 5}
    name = unique("parted")
    S.write_partitioned(sales, ["year", "month"], table=name)
    S.write_partitioned(sales.filter("year = 2024 and month = 2"), ["year", "month"], table=name)
    assert spark.table(name).count() == 1000
    pruned = R.read_partitions(spark, name, {"year": [2024], "month": [1, 2, 3]})
    assert "PartitionFilters: [year" in initial_plan(pruned).replace("isnotnull(year#", "year#") or "PartitionFilters: [" in initial_plan(pruned)
    assert rows(pruned.select("month").distinct()) == [(2,)]
    with pytest.raises(ValueError, match="partition"):
        R.read_partitions(spark, name, {"region": ["a"]})


def test_bucketed_join_has_no_exchange(spark, sales, tmp_path):
    left, right = unique("b"), unique("b")
    S.write_bucketed(sales, left, "k", 4, sort_by="k", path=f"{tmp_path}/l")
    S.write_bucketed(sales.groupBy("k").agg(F.sum("amount").alias("total")), right, "k", 4, path=f"{tmp_path}/r")
    from etlkit.operators.joins import bucketed_join

    joined = bucketed_join(spark, left, right, "k")
    assert joined.count() == 1000
    assert "Exchange" not in executed_plan(joined)


def test_partitioned_bucketed_and_managed_tables(spark, sales, tmp_path):
    name = unique("pb")
    S.write_partitioned_bucketed(sales, name, "year", "k", 4, path=f"{tmp_path}/pb")
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "4" and spark.table(name).count() == 1000
    db = unique("db")
    full = S.write_table(sales, db, "facts", ["year"])
    assert spark.table(full).count() == 1000
    S.write_files(sales, f"{tmp_path}/ext")
    assert R.register_external(spark, unique("ext"), "parquet", f"{tmp_path}/ext").count() == 1000


def test_zorder_narrows_both_columns(spark, tmp_path):
    df = spark.range(4096).select((F.col("id") % 64).alias("x"), (F.col("id") / 64).cast("int").alias("y"), F.col("id"))
    S.write_zordered(df, f"{tmp_path}/z", ["x", "y"], 16, bits=5)
    S.write_zordered(df, f"{tmp_path}/again", ["x"], 4, bits=3)
    df.repartitionByRange(16, "x").write.parquet(f"{tmp_path}/linear")

    def touched(path, column):
        files = [spark.read.parquet(f).agg(F.min(column), F.max(column)).first() for f in parts(path)]
        return sum(lo <= 10 and hi >= 8 for lo, hi in files)

    assert rows(spark.read.parquet(f"{tmp_path}/z")) == rows(df)
    assert touched(f"{tmp_path}/linear", "y") == 16
    assert touched(f"{tmp_path}/z", "y") <= 8 and touched(f"{tmp_path}/z", "x") <= 8
    with pytest.raises(ValueError):
        S.z_value(df.withColumn("s", F.lit("x")), ["s"], 4)


def test_zorder_spreads_one_hot_value(spark, tmp_path):
    hot = spark.range(3000).select(F.lit(5).alias("x"), F.lit(7).alias("y"), F.col("id"))
    S.write_zordered(hot, f"{tmp_path}/hot", ["x", "y"], 6, bits=4)
    counts = [spark.read.parquet(f).count() for f in parts(f"{tmp_path}/hot")]
    assert sum(counts) == 3000 and max(counts) < 1500


def test_shared_dir_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    try:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))
        path = shared_dir(spark, "x")
        assert path.startswith(f"{tmp_path}/x-") and path != shared_dir(spark, "x")
    except Exception as error:  # the setting may be static in this build
        assert "CANNOT_MODIFY" in str(error)
    finally:
        if before and spark.conf.get("spark.checkpoint.dir", None) != before:
            spark.conf.set("spark.checkpoint.dir", before)
    assert os.path.isabs(shared_dir(spark, "y"))


def test_appends_widen_or_are_refused(spark, tmp_path):
    path = f"{tmp_path}/grown"
    frame = lambda sql: spark.sql(f"SELECT {sql}")
    S.append_evolving(frame("1 AS id, 'a' AS name, named_struct('x', 1) AS s"), path)
    S.append_evolving(frame("3000000000L AS id, 'b' AS name, named_struct('x', 2L, 'y', 'new') AS s"), path)
    S.append_evolving(frame("CAST(7 AS SMALLINT) AS id, array(named_struct('k', 1)) AS l"), path)
    schema = S.append_evolving(frame("8 AS id, array(named_struct('k', 2, 'm', 'z')) AS l"), path)
    assert schema.simpleString() == "struct<id:bigint,name:string,s:struct<x:bigint,y:string>,l:array<struct<k:int,m:string>>>"
    got = {r.id: (r.name, r.s and tuple(r.s), r.l and [tuple(e) for e in r.l]) for r in S.read_evolving(spark, path).collect()}
    assert got == {1: ("a", (1, None), None), 3_000_000_000: ("b", (2, "new"), None), 7: (None, None, [(1, None)]), 8: (None, None, [(2, "z")])}
    before = sorted(parts(path))
    for clash in ("'text' AS id", "1 AS id, 5 AS name", "1 AS id, named_struct('x', 'text') AS s", "1.5D AS id"):
        with pytest.raises(S.SchemaClash):
            S.append_evolving(frame(clash), path)
    assert sorted(parts(path)) == before
    with pytest.raises(ValueError):
        S.read_evolving(spark, f"{tmp_path}/none")
