"""Near-duplicate vectors by collision-counting projections.

Vectors of one label are projected on many random lines. On each line the vectors are sorted, and
every vector opens a window around its own place; the vectors inside collide with it. The difference
of two unit vectors at cosine ``c`` projects to a normal deviate of scale ``sqrt(2 - 2c)``, so the
chance of a collision at the threshold is known and the number of collisions a pair must reach is
set from the wanted recall. Pairs that reach it are verified by their cosine in double precision.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import components, materialize
from etlkit.llm.simhash import merge_links
from etlkit.runtime import require

# Half a window, in deviations of a pair at the threshold: half of such pairs collide on a line.
HALF_WINDOW = 0.6744897501960817


def needed_collisions(lines: int, recall: float) -> int:
    """The most collisions that pairs at the threshold still reach with probability ``recall``."""
    p = erf(HALF_WINDOW / sqrt(2))
    tail = lambda least: sum(comb(lines, k) * p**k * (1 - p) ** (lines - k) for k in range(least, lines + 1))
    return max(1, max(k for k in range(lines + 1) if tail(k) >= recall))


def directions(dim: int, lines: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, lines))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaling by the largest entry first keeps squares finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def block_links(
    ids: np.ndarray, copies: np.ndarray, side: np.ndarray, rows: np.ndarray, cosine: float, lines: int, least: int, seed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two blocks of one label (or within one): id, linked vectors, lowest linked id."""
    order = np.argsort(ids, kind="stable")
    ids, copies, side, x = ids[order], copies[order], side[order], unit(rows[order])
    n, labels, links = len(ids), np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64)
    half = HALF_WINDOW * sqrt(2 - 2 * cosine)
    projected = x @ directions(x.shape[1], lines, seed)
    two = side.min() != side.max()
    queries = np.flatnonzero(side == 0) if two else np.arange(n)
    others = np.flatnonzero(side == 1) if two else np.arange(n)
    by_line = [others[np.argsort(projected[others, k], kind="stable")] for k in range(lines)]
    step = max(1, 4_000_000 // max(1, len(others)))
    place = np.empty(n, dtype=np.int64)
    place[others] = np.arange(len(others))
    for at in range(0, len(queries), step):
        q = queries[at : at + step]
        hits = np.zeros((len(q), len(others)), dtype=np.uint8)
        for k, line in enumerate(by_line):
            along = projected[line, k]
            low = np.searchsorted(along, projected[q, k] - half, "left")
            count = np.searchsorted(along, projected[q, k] + half, "right") - low
            row = np.repeat(np.arange(len(q)), count)
            col = line[np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
            hits[row, place[col]] += 1  # a vector lies on a line once, so no index repeats
        i, j = np.nonzero(hits >= least)
        a, b = q[i], others[j]
        if not two:
            a, b = a[a < b], b[a < b]
        for cut in range(0, len(a), 200_000):
            c, d = a[cut : cut + 200_000], b[cut : cut + 200_000]
            near = np.einsum("ij,ij->i", x[c], x[d]) >= cosine
            c, d = c[near], d[near]
            if len(c):
                links += np.bincount(c, weights=copies[d], minlength=n).astype(np.int64)
                links += np.bincount(d, weights=copies[c], minlength=n).astype(np.int64)
                labels = merge_links(labels, c, d)
    some = np.flatnonzero(links)
    return ids[some], links[some], ids[labels[some]]


def near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = 0.93,
    lines: int = 24, recall: float = 0.98, block: int = 4096, seed: int = 11,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row for each row of ``vectors``.

    Vectors link when their labels are equal, they have as many components, and their cosine is at
    least ``cosine``; none below it link. ``recall`` is the chance of finding a pair exactly at the
    threshold. Null, empty or zero vectors and vectors with null or non-finite components link with
    nothing, nor do rows with a null label or id (a null id has a null component and is not kept).
    Equal vectors are one class before any comparison, counted and expanded afterwards. A label's
    classes are cut in blocks of ``block`` by a hash and every pair of blocks is compared in a task
    of its own, so a label may hold any share of the rows; counting works on every pair of classes
    of a label, without ever writing one out. An empty table gives no rows.
    """
    require(vectors, vec_id, embedding, label)
    least = needed_collisions(lines, recall)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = usable & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("v", F.when(usable, F.col("v")))
    classes = rows.filter("v IS NOT NULL").groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.withColumn("dim", F.size("v")), "vector-classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cells"))
    split = classes.join(sizes, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    split = split.select(
        "label", "dim", F.least("own", "other").alias("low_cell"), F.greatest("own", "other").alias("high_cell"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "copies", "v")

    def compare(t: pa.Table) -> pa.Table:
        ids, copies, side = (t[c].to_numpy() for c in ("id", "copies", "side"))
        v = t["v"].combine_chunks()
        found = block_links(ids, copies, side, v.flatten().to_numpy().reshape(len(ids), -1), cosine, lines, least, seed)
        return pa.table(dict(zip(("id", "links", "low"), (pa.array(f, pa.int64()) for f in found))))

    linked = split.groupBy("label", "dim", "low_cell", "high_cell").applyInArrow(compare, "id long, links long, low long")
    linked = materialize(linked, "vector-links")
    parts = components(linked, "id", "low")
    totals = linked.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.join(totals, "id", "left").join(parts, F.col("id") == F.col("node"), "left")
    named = materialize(named.select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component")), "vector-named")
    out = rows.join(named, ["label", "v"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
