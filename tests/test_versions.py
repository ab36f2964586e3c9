"""Versioned tables: merges and compaction touch only what they must; readers see whole versions."""

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, rows
from etlkit.plans.catalogue import QUERIES
from etlkit.sinks import versions as V
from etlkit.sinks.files import fingerprint, zordered


@pytest.fixture()
def path(tmp_path):
    return f"{tmp_path}/a table"


def _numbers(spark, low, high):
    return spark.range(low, high, 1, 1).select("id", (F.col("id") * 2).alias("v"), (F.col("id") % 3).cast("string").alias("kind"))


def _files(spark, path):
    return {r.file for r in V.files(spark, path).collect()}


def test_merge_rewrites_only_files_with_a_match(spark, path):
    V.create(_numbers(spark, 0, 800).repartitionByRange(8, "id"), path, stats=["id"])
    before = _files(spark, path)
    source = spark.createDataFrame([(5, -1, "x"), (6, -1, "x"), (2_000, -1, "new")], "id long, v long, kind string")
    change = V.merge(source, path, "id")
    after = _files(spark, path)
    assert len(before) == 8 and len(change.removed) == 1 and set(change.removed) == before - after
    assert before - set(change.removed) <= after and change.version == 1
    got = {r.id: (r.v, r.kind) for r in V.read_version(spark, path).collect()}
    want = {k: (2 * k, str(k % 3)) for k in range(800)} | {5: (-1, "x"), 6: (-1, "x"), 2_000: (-1, "new")}
    assert got == want and V.read_version(spark, path, 0).count() == 800


def test_merge_without_a_match_only_adds(spark, path):
    V.create(_numbers(spark, 0, 10), path, by="kind")
    change = V.merge(spark.createDataFrame([(50, 1, "0"), (51, 1, None)], "id long, v long, kind string"), path, "id")
    assert change.removed == [] and V.read_version(spark, path).count() == 12
    assert {f.split("/")[0] for f in _files(spark, path)} == {"kind=0", "kind=1", "kind=2", "kind=__HIVE_DEFAULT_PARTITION__"}
    assert V.read_version(spark, path).filter("kind IS NULL").count() == 1


def test_merge_refuses_a_key_twice(spark, path):
    V.create(_numbers(spark, 0, 10), path)
    twice = spark.createDataFrame([(3, 1, "a"), (3, 2, "b")], "id long, v long, kind string")
    with pytest.raises(Exception, match="duplicate source key"):
        V.merge(twice, path, "id")
    assert V.versions(spark, path) == [0] and V.read_version(spark, path).count() == 10


def test_a_taken_version_is_a_conflict(spark, path):
    V.create(_numbers(spark, 0, 10), path)
    listed = V.files(spark, path)
    V.append(_numbers(spark, 10, 12), path)
    with pytest.raises(V.VersionConflict):
        V._commit(listed, path, 1)
    assert V.read_version(spark, path).count() == 12


def test_compaction_packs_small_files_by_partition(spark, path):
    V.create(_numbers(spark, 0, 60_000).repartition(1), path, by="kind")
    large = _files(spark, path)
    for k in range(3):
        V.append(_numbers(spark, 100_000 + 10 * k, 100_010 + 10 * k), path)
    small = {r.file: r.bytes for r in V.files(spark, path).collect() if r.file not in large}
    before = fingerprint(V.read_version(spark, path)).first()
    limit = max(small.values()) + 1
    change = V.compact_small(spark, path, target_mb=1, small_mb=limit / V.MB)
    assert len(small) == 9 and set(change.removed) == set(small) and len(change.added) == 3
    assert large <= _files(spark, path) and change.added_bytes <= sum(small.values())
    assert fingerprint(V.read_version(spark, path)).first() == before
    assert V.compact_small(spark, path, target_mb=1, small_mb=0.0001) is None
    assert V.vacuum(spark, path) == 9 and V.versions(spark, path) == [change.version]
    assert fingerprint(V.read_version(spark, path)).first() == before


def test_bins_hold_all_files_and_no_more_than_the_target():
    sizes = {f"f{k}": 1 + k * 37 % 50 for k in range(40)}
    packed = V.bins(sizes, 60)
    assert sorted(f for b in packed for f in b) == sorted(sizes)
    assert all(sum(sizes[f] for f in b) <= 60 for b in packed)
    assert V.bins({"big": 99}, 60) == [["big"]] and V.bins({}, 60) == []


@pytest.mark.parametrize("where", [{"a": (10, 30)}, {"b": (None, 5)}, {"a": (900, None), "b": (900, None)}, {"a": (5_000, None)}])
def test_statistics_skip_files(spark, path, where):
    grid = spark.range(40_000).select((F.col("id") % 1000).alias("a"), (F.xxhash64("id") % 500 + 499).alias("b"), "id")
    V.create(zordered(grid, ["a", "b"], 32), path, stats=["a", "b"])
    got = V.read_version(spark, path, where=where)
    want = grid
    for c, (low, high) in where.items():
        want = want.filter(F.lit(True) if low is None else F.col(c) >= low).filter(F.lit(True) if high is None else F.col(c) <= high)
    assert rows(got) == rows(want)
    opened = len(got.inputFiles()) if got.count() else 0
    assert opened <= 16, opened


def test_unknown_versions_and_second_create(spark, path):
    with pytest.raises(ValueError):
        V.files(spark, path)
    V.create(_numbers(spark, 0, 0), path)
    assert V.read_version(spark, path).count() == 0
    V.append(_numbers(spark, 0, 2), path)
    assert V.read_version(spark, path).count() == 2 and V.merge(_numbers(spark, 1, 3), path, "id").version == 2
    assert sorted(r.id for r in V.read_version(spark, path).collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        V.create(_numbers(spark, 0, 1), path)


def test_partitions_are_pruned_by_the_join(spark, data):
    plan = executed_plan(QUERIES["join_pruned_partitions"](spark, data))
    assert "dynamicpruning" in plan.lower()
