"""File and table writes with a chosen format, codec, size and layout."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from etlkit.operators.ordered import search_tree
from etlkit.runtime import names, require, shared_dir

MB = 1024 * 1024
CODECS = ("snappy", "gzip", "lz4", "zstd")
# The codec that goes with each format.
FORMATS = {"parquet": "snappy", "orc": "zlib", "json": "gzip", "csv": "gzip"}


def _writer(df: DataFrame, fmt: str, codec: str | None, mode: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode(mode)
    if codec:
        writer = writer.option("compression", codec)
    return writer.option("header", True) if fmt == "csv" else writer


def write_files(
    df: DataFrame, path: str, fmt: str = "parquet", codec: str | None = None, block_mb: int = 128,
    page_mb: int = 1, mode: str = "errorifexists",
) -> None:
    """Write files; row group and page sizes apply to parquet."""
    writer = _writer(df, fmt, codec or FORMATS.get(fmt), mode)
    if fmt == "parquet":
        writer = writer.option("parquet.block.size", block_mb * MB).option("parquet.page.size", page_mb * MB)
    writer.save(path)


def write_codecs(df: DataFrame, base: str, codecs: Sequence[str] = CODECS, mode: str = "errorifexists") -> dict[str, str]:
    """The same frame as parquet under several codecs; returns codec -> path.

    The frame is evaluated once: later copies are made from the first.
    """
    paths = {codec: f"{base.rstrip('/')}/{codec}" for codec in codecs}
    source = df
    for codec, path in paths.items():
        write_files(source, path, "parquet", codec, mode=mode)
        if source is df:
            source = df.sparkSession.read.parquet(path)
    return paths


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path of whichever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(target).getLength())


def write_formats(
    df: DataFrame, base: str, formats: Mapping[str, str] | None = None, mode: str = "errorifexists"
) -> dict[str, int]:
    """The same frame in several formats (format -> codec); returns the bytes each one takes.

    After the first columnar copy, the others are made from it instead of from the frame.
    """
    spark = df.sparkSession
    source, sizes = df, {}
    for fmt, codec in (formats or FORMATS).items():
        path = f"{base.rstrip('/')}/{fmt}"
        write_files(source, path, fmt, codec, mode=mode)
        sizes[fmt] = stored_bytes(spark, path)
        if source is df and fmt in ("parquet", "orc"):
            source = spark.read.format(fmt).load(path)
    return sizes


def written_row_bytes(df: DataFrame, fmt: str = "parquet", codec: str | None = None, rows: int = 20_000) -> float:
    """Bytes a row takes in files of a format, from at most ``rows`` rows written to a scratch folder."""
    path = shared_dir(df.sparkSession, "row-size")
    sample = df.limit(rows)
    write_files(sample, path, fmt, codec)
    n = df.sparkSession.read.format(fmt).load(path).count()
    return stored_bytes(df.sparkSession, path) / n if n else 1.0


def write_sized(
    df: DataFrame, path: str, fmt: str = "parquet", codec: str | None = None,
    target_rows: int | None = None, target_mb: int | None = None, mode: str = "errorifexists",
) -> None:
    """Even files of a target size.

    With ``target_rows`` AQE rebalances partitions by measured bytes and the writer starts a new file
    at the row limit. With ``target_mb`` the bytes a row takes are measured on a written sample, rows
    are counted, and as many even partitions are made as there are to be files, whatever the
    session's advisory size.
    """
    if (target_rows is None) == (target_mb is None):
        raise ValueError("give either target_rows or target_mb")
    if target_rows:
        writer = _writer(df.hint("rebalance"), fmt, codec or FORMATS.get(fmt), mode)
        writer.option("maxRecordsPerFile", target_rows).save(path)
        return
    files = max(1, round(df.count() * written_row_bytes(df, fmt, codec) / (target_mb * MB)))
    _writer(df.repartition(files), fmt, codec or FORMATS.get(fmt), mode).save(path)


def write_partitioned(
    df: DataFrame, by: str | Sequence[str], path: str | None = None, table: str | None = None,
    fmt: str = "parquet", codec: str | None = None, mode: str = "overwrite",
    max_rows_per_file: int = 10_000_000, dynamic: bool = True,
) -> None:
    """Partitioned files or table. A ``dynamic`` overwrite replaces only the partitions present in ``df``.

    Rows of one partition value meet in few tasks, but a large value is split over several.
    """
    by = names(by)
    require(df, *by)
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    writer = (
        _writer(df.hint("rebalance", *by), fmt, codec or FORMATS.get(fmt), mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static").option("maxRecordsPerFile", max_rows_per_file)
    )
    if path:
        writer.partitionBy(*by).save(path)
    elif mode == "overwrite" and df.sparkSession.catalog.tableExists(table):
        # Replace partitions of an existing table instead of dropping it.
        order = df.sparkSession.table(table).columns
        df.select(*order).hint("rebalance", *by).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic" if dynamic else "static"
        ).option("maxRecordsPerFile", max_rows_per_file).insertInto(table)
    else:
        writer.partitionBy(*by).saveAsTable(table)


def write_bucketed(
    df: DataFrame, table: str, columns: str | Sequence[str], n: int,
    sort_by: str | Sequence[str] | None = None, path: str | None = None, fmt: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Bucketed, optionally sorted table.

    Rows are shuffled on the bucket keys first, so a bucket is written by one task, or by a few
    when it holds so many rows that AQE splits it.
    """
    columns = names(columns)
    require(df, *columns)
    writer = df.hint("rebalance", n, *columns).write.format(fmt).mode(mode).bucketBy(n, *columns)
    if sort_by:
        writer = writer.sortBy(*names(sort_by))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_partitioned_bucketed(
    df: DataFrame, table: str, by: str | Sequence[str], columns: str | Sequence[str], n: int,
    path: str | None = None, fmt: str = "parquet", mode: str = "errorifexists",
) -> None:
    """Partitioned and bucketed table, shuffled on both key sets to keep the file count down."""
    by, columns = names(by), names(columns)
    require(df, *by, *columns)
    writer = (
        df.hint("rebalance", n, *by, *columns).write.format(fmt).mode(mode)
        .partitionBy(*by).bucketBy(n, *columns)
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_table(
    df: DataFrame, db: str, name: str, by: str | Sequence[str] = (), mode: str = "overwrite",
) -> str:
    """Managed table in a database that is created when missing; returns its full name."""
    spark = df.sparkSession
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": db})
    writer = df.write.mode(mode)
    full = f"{db}.{name}"
    (writer.partitionBy(*names(by)) if by else writer).saveAsTable(full)
    return full


def z_value(df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    """Interleaved bits of each column's quantile bucket.

    The 2**bits - 1 quantiles per column come from one aggregation and are the only values read
    back; they become a CASE tree, so each row costs ``bits`` comparisons per column.
    """
    require(df, *columns)
    if not 1 <= bits <= 10 or bits * len(columns) > 62:
        raise ValueError("bits must be 1..10 and bits x columns at most 62")
    parts = 2**bits
    numbers = {c: _as_number(df, c) for c in columns}
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(*[F.percentile_approx(v, shares, 10 * parts).alias(c) for c, v in numbers.items()]).first()
    z = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        bounds = sorted(set(row[c] or []))
        rank = search_tree(numbers[c], bounds, 0, len(bounds)).cast("long")
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return z


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(column)).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise ValueError(f"z-order needs numeric or time columns, not {kind.simpleString()} {column!r}")


def zordered(df: DataFrame, columns: Sequence[str], n_files: int, bits: int = 8) -> DataFrame:
    """Rows arranged in ``n_files`` tasks that are clustered on several columns at once.

    The order is broken by a row hash, so one very frequent z value still spreads over tasks.
    """
    z = z_value(df, columns, bits)
    ranged = df.withColumns({"__z": z, "__h": F.xxhash64(*df.columns)})
    return ranged.repartitionByRange(n_files, "__z", "__h").sortWithinPartitions("__z", *columns).drop("__z", "__h")


def write_zordered(
    df: DataFrame, path: str, columns: Sequence[str], n_files: int, bits: int = 8,
    mode: str = "errorifexists",
) -> None:
    """Files clustered on several columns at once, so range filters on any of them skip files."""
    zordered(df, columns, n_files, bits).write.mode(mode).parquet(path)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free exact sum of row hashes."""
    row = F.xxhash64(*df.columns).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("checksum"))


def compact(
    spark: SparkSession, path: str, fmt: str = "parquet", target_mb: int = 128, out: str | None = None
) -> str:
    """Rewrite many small files as few of a target size, beside the original.

    The copy is compared with the original by row count and checksum before its path is returned.
    """
    out = out or f"{path.rstrip('/')}-compacted-{uuid.uuid4().hex[:8]}"
    df = spark.read.format(fmt).load(path)
    write_sized(df, out, fmt, target_mb=target_mb)
    before, after = fingerprint(df).first(), fingerprint(spark.read.format(fmt).load(out)).first()
    if before != after:
        raise RuntimeError(f"compaction changed the data: {before} became {after}")
    return out


# Types that take every value of another without loss.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"),
    "float": ("double",), "date": ("timestamp_ntz",),
}
# Columns of a folder that grew by ``append_evolving``; hidden from readers of rows.
_SCHEMA_FILE = "_evolved_schema"


class SchemaClash(ValueError):
    """A column has types that do not widen into each other."""


def _wider(old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    """The type that holds the values of both."""
    a, b = old.simpleString(), new.simpleString()
    if a == b or b in ("void",):
        return old
    if a == "void" or b in WIDER.get(a, ()):
        return new
    if a in WIDER.get(b, ()):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_wider(old.elementType, new.elementType, f"{name}[]"))
    raise SchemaClash(f"column {name}: {a} and {b} do not widen into each other")


def merged_schema(old: T.StructType, new: T.StructType, prefix: str = "") -> T.StructType:
    """Columns of both, old ones first, each with a type that loses nothing; clashes are an error. All may be null."""
    known = {f.name: f.dataType for f in new}
    fields = [T.StructField(f.name, _wider(f.dataType, known[f.name], prefix + f.name) if f.name in known else f.dataType) for f in old]
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name not in {g.name for g in old}])


def _as_type(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value in a wider type; fields that a struct lacks are NULL."""
    if old == new:
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields = [(_as_type(value[f.name], old[f.name].dataType, f.dataType) if f.name in old.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in new]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda v: _as_type(v, old.elementType, new.elementType))
    return value.cast(new)


def evolved_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a folder of files: those noted by ``append_evolving``, else those of its footers; None without files."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    notes = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_SCHEMA_FILE}")
    if fs.exists(notes):
        numbers = sorted(int(s.getPath().getName()) for s in fs.listStatus(notes))
        return T.StructType.fromJson(json.loads(spark.read.text(f"{path}/{_SCHEMA_FILE}/{numbers[-1]}").first()[0]))
    if not fs.exists(target) or not any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(target)):
        return None
    return spark.read.option("mergeSchema", True).parquet(path).schema


def append_evolving(df: DataFrame, path: str) -> T.StructType:
    """Append files that may bring new columns or wider or narrower types; returns the folder's columns after it.

    The columns are compared before anything is written: a narrower type is written as the wider one, a wider one widens the
    folder's column, an int beside a text is an error and nothing is written. The columns are noted beside the
    files for ``read_evolving``. One writer at a time.
    """
    spark = df.sparkSession
    old = evolved_schema(spark, path)
    schema = merged_schema(old, df.schema) if old else merged_schema(T.StructType([]), df.schema)
    wanted = {f.name: f.dataType for f in schema}
    write_files(df.select(*[_as_type(F.col(f.name), f.dataType, wanted[f.name]).alias(f.name) for f in df.schema]), path, mode="append")
    noted = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_SCHEMA_FILE}")
    fs = noted.getFileSystem(spark._jsc.hadoopConfiguration())
    number = len(fs.listStatus(noted)) if fs.exists(noted) else 0
    if old != schema or not number:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{path}/{_SCHEMA_FILE}/{number}")
    return schema


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a folder that grew by ``append_evolving``, in its present columns; what a file lacks is NULL."""
    schema = evolved_schema(spark, path)
    if schema is None:
        raise ValueError(f"no files in {path}")
    return spark.read.schema(schema).parquet(path)
