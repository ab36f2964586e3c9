"""Scratch tables, batches and connected components shared by the operators here."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.runtime import materialize

# Edges that a task holds for its forest.
FOREST_EDGES = 1_000_000
# Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 * 1024 * 1024


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bound on bytes in an Arrow batch, so that a task's memory outside the heap does not grow with the texts.

    Spark's own is 64 MiB, which a task holds several times (as the buffer grows, beside the batch before, and in the
    worker). A lower bound stays. It is not put back: Spark reads it when a returned frame is written.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def merge_links(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the classes of linked positions; a label is the lowest position of its class."""
    while True:
        la, lb = labels[a], labels[b]
        low = np.minimum(la, lb)
        new = labels.copy()
        np.minimum.at(new, la, low)
        np.minimum.at(new, lb, low)
        new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half-round over edges ``(a, b)`` with ``a > b``.

    Large star: every node passes its smallest neighbour (or itself) to its larger neighbours.
    Small star: every node and its smaller neighbours are tied to the smallest of them.
    """
    out = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        out = out.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    lowest = materialize(out.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "lowest")
    joined = out.join(lowest, "u")
    tied = joined.filter("v > u" if large else "v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        tied = tied.unionByName(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return tied.filter("a <> b").distinct()


def _forest(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` with ``a > b``, of each task a spanning forest alone: the same components from fewer rows.

    A task holds FOREST_EDGES edges and a batch. A forest that fills half of that leaves the task, which begins anew.
    """
    def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        start = np.arange(len(ids))
        labels = merge_links(start, at[: len(a)], at[len(a) :])
        moved = np.flatnonzero(labels != start)
        return ids[moved], ids[labels[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda a, b: pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        held, n = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)))
            n += batch.num_rows
            if n >= FOREST_EDGES:
                held = [spanning(*map(np.concatenate, zip(*held)))]
                n = len(held[0][0])
                if 2 * n >= FOREST_EDGES:
                    yield out(*held.pop())
                    held, n = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
        yield out(*spanning(*map(np.concatenate, zip(*held))))

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an undirected graph of long ids.

    ``component`` is the smallest id reachable. Alternating large and small stars end after about
    log^2 rounds whatever the diameter; each half-round is a grouped minimum and an equi-join whose
    hot side AQE can split. Tasks begin with the spanning forests of their edges. Null ends and self-loops are left out; an empty graph gives no rows.
    """
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    now = materialize(_forest(ends.filter("a <> b")).distinct(), "edges")
    seen = _digest(now)
    while seen[0]:
        now = materialize(_stars(materialize(_stars(now, True), "large"), False), "small")
        after = _digest(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()


def _digest(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())
