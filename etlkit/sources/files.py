"""Batch reads with the projection and filter stated next to the path, so both reach the scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats that Spark reads without further packages, and those that need one on the class path.
BUILT_IN = ("parquet", "orc", "json", "csv", "text")
PACKAGED = ("avro", "delta", "iceberg")
# Text formats are never read with schema inference: it costs a pass and loses types.
NEED_SCHEMA = ("json", "csv")


def read_files(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
    columns: Sequence[str] | None = None, where: Column | None = None,
    schema: T.StructType | str | None = None, merge_schema: bool = False, glob: str | None = None,
    **options: str,
) -> DataFrame:
    """Scan files. ``options`` pass through, such as ``versionAsOf`` or ``snapshot-id``."""
    if fmt not in BUILT_IN + PACKAGED:
        raise ValueError(f"format must be one of {BUILT_IN + PACKAGED}")
    if fmt in NEED_SCHEMA and schema is None:
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        df = reader.load(path if isinstance(path, str) else list(path))
    except (AnalysisException, Py4JJavaError) as error:
        if fmt in PACKAGED and "Failed to find" in str(error):
            raise ValueError(f"reading {fmt} needs its package on the class path") from error
        raise
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def register_external(spark: SparkSession, name: str, fmt: str, path: str) -> DataFrame:
    """Put a catalog table over existing files; dropping it leaves the files."""
    if fmt not in BUILT_IN + PACKAGED:
        raise ValueError(f"format must be one of {BUILT_IN + PACKAGED}")
    spark.catalog.createTable(name, path=path, source=fmt)
    return spark.table(name)


def read_partitions(
    spark: SparkSession, table: str, values: Mapping[str, Sequence]
) -> DataFrame:
    """Rows of the given partition values; literals prune partitions at planning time."""
    df = spark.table(table)
    partitioned = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    unknown = set(values) - partitioned
    if unknown:
        raise ValueError(f"not partition columns: {sorted(unknown)}")
    for column, wanted in values.items():
        df = df.filter(F.col(column).isin(list(wanted)))
    return df
