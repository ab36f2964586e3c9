"""Tables of immutable files under versions: merges and compaction rewrite only the files they touch.

A table is a folder with ``data`` (parquet files, in partition folders if asked for) and ``_versions/<n>``,
each a small parquet table that lists the files of the version with their sizes, rows and the smallest and largest
values of chosen columns. A change writes new files, lists them beside the untouched old ones
and puts the list in place under the next number in one step that fails if the number is taken. Readers use one
list, so they see a change whole or not at all, and old versions stay readable until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.operators.history import upsert
from etlkit.runtime import all_of, names, require

MB = 1024 * 1024


class VersionConflict(RuntimeError):
    """Another change has taken the next version."""


class Change(NamedTuple):
    """A new version, the files that left the list, those that came and the bytes written."""

    version: int
    removed: list[str]
    added: list[str]
    added_bytes: int


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    at, fs = _fs(spark, f"{path}/_versions")
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n) for n in found if n.isdigit())


def files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The list of a version: ``file``, ``bytes``, ``rows`` and, for tables with statistics, ``low`` and ``high``."""
    known = versions(spark, path)
    version = known[-1] if version is None and known else version
    if version not in known:
        raise ValueError(f"no version {version} of {path}")
    return spark.read.parquet(f"{path}/_versions/{version}")


def _base(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    return fs.makeQualified(at).toString()


def _schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(f"{path}/_schema").first()[0]))


def _read(spark: SparkSession, path: str, listed: Sequence[str]) -> DataFrame:
    schema = _schema(spark, path)
    if not listed:
        return spark.createDataFrame([], schema)
    base = _base(spark, path)
    return spark.read.schema(schema).option("basePath", f"{base}/data").parquet(*[f"{base}/data/{f}" for f in listed])


def read_version(spark: SparkSession, path: str, version: int | None = None, where: Mapping[str, tuple] | None = None) -> DataFrame:
    """Rows of a version, the latest by default.

    ``where`` maps columns to (lowest, highest) values, either of them None. Files whose statistics
    show no such value are not opened; the condition itself is applied to the rows of the others.
    """
    listed = files(spark, path, version)
    bounds = dict(where or {})
    kept = [may_hold(column, low, high) for column, (low, high) in bounds.items() if "low" in listed.columns and column in listed.schema["low"].dataType.names]
    if kept:
        listed = listed.filter(all_of(kept))
    rows = _read(spark, path, [r.file for r in listed.select("file").collect()])
    wanted = [_within(F.col(c), low, high) for c, (low, high) in bounds.items()]
    return rows.filter(all_of(wanted)) if wanted else rows


def _within(column: Column, low, high) -> Column:
    parts = ([column >= F.lit(low)] if low is not None else []) + ([column <= F.lit(high)] if high is not None else [])
    return all_of(parts) if parts else F.lit(True)


def may_hold(column: str, low, high) -> Column:
    """Whether a file's statistics allow a value of a column in bounds; a file without values has none."""
    parts = [F.col(f"high.{column}").isNotNull()] if (low, high) != (None, None) else []
    parts += [F.col(f"high.{column}") >= F.lit(low)] if low is not None else []
    parts += [F.col(f"low.{column}") <= F.lit(high)] if high is not None else []
    return all_of(parts) if parts else F.lit(True)


def _relative(spark: SparkSession, path: str) -> Column:
    """A row's file, relative to ``data``."""
    base = _base(spark, path).split(":", 1)[-1].lstrip("/")
    return F.regexp_replace(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), rf"^[a-z0-9]*:/*\Q{base}\E/data/", "")


def _add(df: DataFrame, path: str, by: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Write rows as new files below ``data`` and list them. Names are unique, so nothing is overwritten."""
    spark = df.sparkSession
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(staged)
    at, fs = _fs(spark, staged)
    root, found, sizes = fs.makeQualified(at).toString(), [], fs.listFiles(at, True)
    while sizes.hasNext():
        status = sizes.next()
        name = status.getPath().toString()[len(root) + 1 :]
        if not name.startswith("_"):
            target, _ = _fs(spark, f"{path}/data/{name}")
            fs.mkdirs(target.getParent())
            if not fs.rename(status.getPath(), target):
                raise OSError(f"could not move {name}")
            found.append((name, int(status.getLen())))
    fs.delete(at, True)
    sized = spark.createDataFrame(found, "file string, bytes long")
    rows = _read(spark, path, [f for f, _ in found])
    bounds = [F.struct(*[fn(c).alias(c) for c in stats]).alias(name) for name, fn in (("low", F.min), ("high", F.max))] if stats else []
    counted = rows.groupBy(_relative(spark, path).alias("file")).agg(F.count(F.lit(1)).alias("rows"), *bounds)
    return sized.join(counted, "file")


def _commit(listed: DataFrame, path: str, version: int) -> None:
    """Put a list in place as a version, in one step."""
    spark = listed.sparkSession
    staged, fs = _fs(spark, f"{path}/_staged/{uuid.uuid4().hex}")
    listed.coalesce(1).write.parquet(staged.toString())
    target, _ = _fs(spark, f"{path}/_versions/{version}")
    fs.mkdirs(target.getParent())
    jvm = spark._jvm.org.apache.hadoop.fs
    plain = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    try:
        jvm.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, target, plain)
    except Py4JJavaError as error:
        fs.delete(staged, True)
        if fs.exists(target):
            raise VersionConflict(f"version {version} of {path} is taken") from error
        raise


def create(df: DataFrame, path: str, by: str | Sequence[str] = (), stats: Sequence[str] = ()) -> None:
    """Version 0 of a table with the rows of ``df``, partitioned ``by`` columns, with statistics of ``stats``."""
    spark, by = df.sparkSession, names(by)
    require(df, *by, *stats)
    if versions(spark, path):
        raise ValueError(f"{path} has versions already")
    ordered = T.StructType([f for f in df.schema if f.name not in by] + [df.schema[c] for c in by])
    spark.createDataFrame([(ordered.json(),)], "value string").coalesce(1).write.text(f"{path}/_schema")
    _commit(_add(df, path, by, stats), path, 0)


def _layout(spark: SparkSession, path: str, listed: DataFrame) -> tuple[list[str], list[str]]:
    """Partition columns, from a file's folder, and columns with statistics."""
    first = listed.select("file").first()
    by = [part.split("=")[0] for part in first.file.split("/")[:-1]] if first else []
    return by, listed.schema["low"].dataType.names if "low" in listed.columns else []


def _replace(spark: SparkSession, path: str, old: DataFrame, version: int, gone: Sequence[str], rows: DataFrame, by, stats) -> Change:
    added = _add(rows, path, by, stats)
    listed = added.collect()
    kept = old.join(spark.createDataFrame([(f,) for f in gone], "__file string"), F.col("file") == F.col("__file"), "left_anti")
    _commit(kept.unionByName(spark.createDataFrame(listed, added.schema)), path, version + 1)
    return Change(version + 1, sorted(gone), sorted(r.file for r in listed), sum(r.bytes for r in listed))


def append(df: DataFrame, path: str) -> Change:
    """Add rows as new files."""
    spark = df.sparkSession
    version, old = versions(spark, path)[-1], files(spark, path)
    by, stats = _layout(spark, path, old)
    return _replace(spark, path, old, version, [], df, by, stats)


def merge(source: DataFrame, path: str, keys: str | Sequence[str]) -> Change:
    """Replace the rows that match a key of ``source`` and add its other rows, rewriting touched files only.

    A pass over the keys finds the files that hold a match; files whose statistics exclude all keys of ``source`` are not
    opened for it. A key that occurs twice in ``source`` is an error, and nothing changes.
    """
    spark, keys = source.sparkSession, names(keys)
    version, old = versions(spark, path)[-1], files(spark, path)
    by, stats = _layout(spark, path, old)
    covered = [k for k in keys if k in stats]
    looked = old
    if covered:
        bounds = source.agg(*[fn(k).alias(f"{name}_{k}") for k in covered for name, fn in (("low", F.min), ("high", F.max))]).first()
        looked = old.filter(all_of([may_hold(k, bounds[f"low_{k}"], bounds[f"high_{k}"]) for k in covered]))
    held = _read(spark, path, [r.file for r in looked.select("file").collect()])
    touched: list[str] = []
    if not looked.isEmpty():
        matched = held.select(*keys, _relative(spark, path).alias("__file")).join(source.select(*keys), keys, "left_semi")
        touched = sorted(r["__file"] for r in matched.select("__file").distinct().collect())
    target = _read(spark, path, touched)
    # Rows are gathered by measured size, so a small change makes few files.
    rows = upsert(target, source.select(*target.columns), keys).hint("rebalance")
    return _replace(spark, path, old, version, touched, rows, by, stats)


def bins(sizes: Mapping[str, int], target: int) -> list[list[str]]:
    """Files packed in bins of at most ``target`` bytes, the largest first into the first bin with room."""
    packed: list[tuple[int, list[str]]] = []
    for name in sorted(sizes, key=lambda f: (-sizes[f], f)):
        at = next((k for k, (used, _) in enumerate(packed) if used + sizes[name] <= target), None)
        if at is None:
            packed.append((sizes[name], [name]))
        else:
            packed[at] = (packed[at][0] + sizes[name], [*packed[at][1], name])
    return [found for _, found in packed]


def compact_small(spark: SparkSession, path: str, target_mb: float = 128, small_mb: float | None = None) -> Change | None:
    """Pack small files together, partition by partition; larger files stay as they are.

    Files below ``small_mb`` (half the target, unless given) go in bins of at most ``target_mb``, and a bin of two or
    more becomes one file. None when there is nothing to pack. The new version must hold as many rows with the same
    checksum, or it is an error and the old version stays.
    """
    from etlkit.sinks.files import fingerprint

    limit = (target_mb / 2 if small_mb is None else small_mb) * MB
    version, old = versions(spark, path)[-1], files(spark, path)
    by, stats = _layout(spark, path, old)
    folders: dict[str, dict[str, int]] = {}
    for r in old.filter(F.col("bytes") < limit).select("file", "bytes").toLocalIterator():
        folders.setdefault(r.file.rpartition("/")[0], {})[r.file] = r.bytes
    packs = [b for _, sizes in sorted(folders.items()) for b in bins(sizes, int(target_mb * MB)) if len(b) > 1]
    if not packs:
        return None
    number = {f: k for k, pack in enumerate(packs) for f in pack}
    pack_of = spark.createDataFrame(list(number.items()), "__file string, __pack int")
    before = _read(spark, path, sorted(number))
    rows = before.select("*", _relative(spark, path).alias("__file")).join(F.broadcast(pack_of), "__file")
    # A task is a bin: at most the target size, whatever the partition holds.
    packed = rows.repartitionById(len(packs), F.col("__pack")).drop("__file", "__pack")
    wanted = fingerprint(before).first()
    added = _add(packed, path, by, stats)
    listed = added.collect()
    got = fingerprint(_read(spark, path, [r.file for r in listed])).first()
    if got != wanted:
        raise RuntimeError(f"compaction changed the data: {wanted} became {got}")
    kept = old.join(pack_of, F.col("file") == F.col("__file"), "left_anti")
    _commit(kept.unionByName(spark.createDataFrame(listed, added.schema)), path, version + 1)
    return Change(version + 1, sorted(number), sorted(r.file for r in listed), sum(r.bytes for r in listed))


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Drop all but the last ``keep`` versions and the files that no kept version lists; returns how many files went."""
    known = versions(spark, path)
    gone, kept = known[: max(0, len(known) - keep)], known[max(0, len(known) - keep) :]
    if not gone:
        return 0
    listed = lambda of: spark.read.parquet(*[f"{path}/_versions/{v}" for v in of]).select("file").distinct()
    dropped = listed(gone).join(listed(kept), "file", "left_anti")
    n = 0
    for r in dropped.toLocalIterator():
        at, fs = _fs(spark, f"{path}/data/{r.file}")
        n += bool(fs.delete(at, False))
    for v in gone:
        at, fs = _fs(spark, f"{path}/_versions/{v}")
        fs.delete(at, True)
    return n
