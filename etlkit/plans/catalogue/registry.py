"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The input tables of one directory, as attributes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        # Files in a micro-batch of a stream over a table; all there are, unless set.
        self.stream_files: int | None = None
        self._frames: dict[str, DataFrame] = {}

    def file(self, name: str) -> str:
        return f"{self.path}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(self.file(name))
        return self._frames[name]


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under its own name. Without ``sql`` only rows are checked."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")
        QUERIES[name] = lambda spark, path: build(Tables(spark, path))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
