"""Near-duplicate texts: candidates by anchor-point covering of SimHash fingerprints, links verified on shingles.

Wide fingerprints of word shingles are cut in 23-bit blocks, and each block is filed under all anchors
of the covering code within its radius plus one. Two fingerprints that differ in two bits or fewer in
some block meet at an anchor, where they are compared whole against a loose bound of bits. The bound
only picks candidates: a link is a pair whose sets of shingles have the wanted Jaccard similarity.

Candidates go out as pairs only where few hang together at an anchor. A crowd goes out as one edge a row, which
names the crowd it belongs to; its sets of shingles are then compared inside tasks, block by block, and only a
spanning forest of its links leaves them. Pairs that hang together in small groups are compared the same way, so that each
set of shingles crosses the network once for its group; only pairs of long chains are verified one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from etlkit.llm.common import bound_batches, components, materialize
from etlkit.llm.simhash import CELL_ROWS, GROUP_ROWS, RADIUS, _blocks, anchors_of, fingerprint, merge_links
from etlkit.runtime import require

ANCHORS = 4096
# Anchors within RADIUS + 1 of a block, on average (5.3), and candidates that hang together before they are a crowd.
FILED, CROWD = 5.4, 16
# Rows and bytes of text of a block of a crowd (about 1.7 million shingles, 5 million at most).
BLOCK_ROWS, BLOCK_BYTES = 2_048, 10_000_000
SEED = 9
# Bits of the map that keeps texts which no candidate asks for off the network.
ASKED_LOG2 = 25


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles, as the fingerprint takes them."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    width = min(shingle, len(tokens))
    hashes = (xxhash.xxh64_intdigest(b" ".join(tokens[k : k + width]), SEED) for k in range(len(tokens) - width + 1 if tokens else 0))
    return np.unique(np.fromiter(hashes, dtype=np.uint64)).view(np.int64)


def _digest(text: str):
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of words, for any shapes that broadcast."""
    return sum(np.bitwise_count(a[..., k] ^ b[..., k]).astype(np.int16) for k in range(a.shape[-1]))


def _near(words: np.ndarray, bits: int, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``left`` and ``right`` positions within ``bits``, by steps of bounded size."""
    step = max(1, 1_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        part = left[at : at + step]
        i, j = np.nonzero(_differing(words[part, None], words[None, right]) <= bits)
        i, j = part[i], right[j]
        keep = i != j
        yield i[keep], j[keep]


def crowd_pairs(ids: np.ndarray, words: np.ndarray, side: np.ndarray, bits: int, crowd: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates of one anchor: all pairs of a small group; of a crowd its smallest id with every other; and which are of crowds."""
    at = np.arange(len(ids))
    two = side.min() != side.max()
    left, right = (at[side == 0], at[side == 1]) if two else (at, at)
    labels, kept, held = at, [], 0
    for i, j in _near(words, bits, left, right):
        if len(i):
            labels = merge_links(labels, i, j)
            if held < 500_000:
                kept.append((i, j))
                held += len(i)
    sizes = np.bincount(labels, minlength=len(ids))[labels]
    small = np.flatnonzero((sizes > 1) & (sizes <= crowd))
    if held < 500_000:
        i, j = (np.concatenate([p[k] for p in kept]) if kept else at[:0] for k in (0, 1))
        pairs = [(i[sizes[i] <= crowd], j[sizes[i] <= crowd])]
    else:
        order = small[np.argsort(labels[small], kind="stable")]
        pairs = [p for group in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1) for p in _near(words, bits, group, group)]
    i, j = (np.concatenate([p[k] for p in pairs]) if pairs else at[:0] for k in (0, 1))
    big = np.flatnonzero((sizes > crowd) & (labels != at))
    a, b = ids[np.concatenate([i, labels[big]])], ids[np.concatenate([j, big])]
    return np.minimum(a, b), np.maximum(a, b), np.arange(len(a)) >= len(i)


def candidates(classes: DataFrame, bits: int, words: int, blocks: int, crowd: int = CROWD) -> DataFrame:
    """``(a, b, crowd)`` of rows ``(id, fingerprint)`` by ``crowd_pairs``, each at most once, ``a`` below ``b``. An anchor that holds more than CELL_ROWS rows is cut in cells by a hash of the
    id, and every pair of its cells is compared in a task of its own. Only the cells of crowded
    anchors are broadcast, at most 4,096 a block.
    """
    context = classes.sparkSession.sparkContext
    width = max(1, int(ANCHORS * blocks // max(512 * blocks, classes.count() * FILED * blocks / GROUP_ROWS)))
    columns = [f"w{k}" for k in range(words)]

    def places(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, 8 * words)
        longs = raw.view(">u8").astype(np.uint64).view(np.int64)
        for b, x in enumerate(_blocks(raw, blocks)):
            for at in range(0, len(x), 4096):
                row, anchor, _ = anchors_of(x[at : at + 4096], RADIUS + 1)
                yield row + at, anchor + ANCHORS * b, longs

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ANCHORS * blocks, dtype=np.int64)
        for batch in batches:
            for _, anchor, _ in places(batch) if batch.num_rows else ():
                total += np.bincount(anchor, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["anchor", "n"])

    read = classes.select("id", "fingerprint")
    crowded = read.mapInArrow(measure, "anchor int, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") > CELL_ROWS).toArrow()
    cells = np.ones(ANCHORS * blocks, dtype=np.int32)
    cells[crowded["anchor"].to_numpy()] = -(-crowded["n"].to_numpy() // CELL_ROWS)
    shared = context.broadcast(cells)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            mixed = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for row, anchor, longs in places(batch):
                many = shared.value[anchor]
                other = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                row, anchor, many = np.repeat(row, many), np.repeat(anchor, many), np.repeat(many, many)
                own = (mixed[row] % many.astype(np.uint64)).astype(np.int64)
                made = [anchor // width, np.minimum(own, other), np.maximum(own, other), anchor, own > other]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(m.astype(np.int32)) for m in made], pa.array(ids[row]), *[pa.array(longs[row, k]) for k in range(words)]],
                    names=["bundle", "low", "high", "anchor", "side", "id", *columns])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        ids, side, anchor = (t[c].to_numpy() for c in ("id", "side", "anchor"))
        packed = np.stack([t[c].to_numpy() for c in columns], axis=1).view(np.uint64)
        order = np.argsort(anchor, kind="stable")
        for g in np.split(order, np.flatnonzero(np.diff(anchor[order])) + 1):
            a, b, many = crowd_pairs(ids[g], packed[g], side[g], bits, crowd)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(many)], names=["a", "b", "crowd"])

    schema = "bundle int, low int, high int, anchor int, side int, id long, " + ", ".join(f"{c} long" for c in columns)
    return read.mapInArrow(file, schema).groupBy("bundle", "low", "high").applyInArrow(compare, "a long, b long, crowd boolean").distinct()


def _asked(marks: DataFrame, key: str, digest: str):
    """A flag for rows ``(key, digest)``: false only where ``marks`` (``__id``, ``__digest``) has no such row, by a bitmap of 2^ASKED_LOG2 bits.

    A filter only: rows that pass by chance fall out of the join that follows. The bitmap never grows; where it fills up it
    lets all rows through. Python sees the hashes alone.
    """
    cell = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << ASKED_LOG2))
    bits = marks.select(cell("__id", "__digest").alias("c")).groupBy(F.expr("c div 64").alias("word"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(c % 64 AS int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (ASKED_LOG2 - 6), dtype=np.int64)
    bitmap[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    shared = marks.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def held(cells: pa.Array) -> pa.Array:
        at = cells.to_numpy(zero_copy_only=False)
        on = shared.value[at >> 6].view(np.uint64) >> (at & 63).astype(np.uint64) & np.uint64(1)
        return pa.array(on.astype(bool))

    return held(cell(key, digest))


def sets_of(asked: DataFrame, docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``asked`` (written, one row for each ``__id`` and ``__digest``) with ``s``, the set of shingles of its text.

    Rows of one id and text are one before the shuffle, and each text crosses the network once at any size.
    """
    rest = [f for f in asked.schema if f.name not in ("__id", "__digest")]
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                made = [shingle_set(t.as_py(), shingle) for t in part.column(len(names))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(made, pa.list_(pa.int64()))], names=[*names, "s"])

    def keys(key: str, digest: str):
        return [F.coalesce(key, F.lit(0)).alias("__at"), F.col(key).isNull().alias("__none"), F.col(digest).alias("__d")]

    keyed = docs.select(F.col(doc_id).cast("long").alias("__key"), _digest(text).alias("__d"), F.col(text).alias("__text"))
    texts = keyed.filter(_asked(asked, "__key", "__d")).groupBy(*keys("__key", "__d")).agg(F.any_value("__text").alias("__text"))
    rows = texts.join(asked.select(*names, *keys("__id", "__digest")), ["__at", "__none", "__d"]).select(*names, "__text")
    return rows.mapInArrow(run, StructType([*rest, StructField("s", ArrayType(LongType()))]))


def verified(pairs: DataFrame, sets: DataFrame, jaccard: float) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose sets have at least the Jaccard similarity. Empty sets are equal."""
    one, two = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= jaccard * (F.size("sa") + F.size("sb") - shared) - 1e-9).select("a", "b")


def set_links(ids: np.ndarray, side: np.ndarray, starts: np.ndarray, shingles: np.ndarray, jaccard: float) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links between rows (of two sides, or within one) whose sets have the Jaccard similarity.

    ``starts`` cuts ``shingles`` in the rows' sets. A row's shared shingles with all others are counted along the lists of the rows
    that hold each of its shingles.
    """
    n, sizes = len(ids), np.diff(starts)
    row = np.repeat(np.arange(n), sizes)
    codes = np.unique(shingles, return_inverse=True)[1]
    by_code = np.argsort(codes, kind="stable")
    lists, many = row[by_code], np.bincount(codes, minlength=1)
    first = np.cumsum(many) - many
    labels, two = np.arange(n), side.min() != side.max()
    for i in np.flatnonzero(side == 0) if two else range(n):
        held = codes[starts[i] : starts[i + 1]]
        count = many[held]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[held], count)
        shared = np.bincount(lists[at], minlength=n)
        near = shared >= jaccard * (sizes[i] + sizes - shared) - 1e-9
        near &= side != side[i] if two else np.arange(n) > i
        j = np.flatnonzero(near)
        if len(j):
            labels = merge_links(labels, np.full(len(j), i), j)
    moved = np.flatnonzero(labels != np.arange(n))
    return ids[moved], ids[labels[moved]]


def crowd_links(crowds: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, shingle: int, jaccard: float) -> DataFrame:
    """``(a, b)`` links inside crowds ``(node, component)``: every pair of blocks of a crowd is compared in a task of its own.

    Texts are looked up with the places of their rows beside them, so a set goes straight from where it is made to the tasks that compare it.
    """
    rows = materialize(crowds.withColumnRenamed("node", "id").join(classes.drop("fingerprint"), "id"), "near-crowds")
    sizes = rows.groupBy("component").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n_bytes") / BLOCK_BYTES)).cast("int").alias("cells"))
    placed = rows.join(materialize(sizes, "near-crowd-sizes"), "component")
    # A row is in one crowd and one group at most.
    asked = placed.groupBy("id", F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).agg(
        F.collect_list(F.struct("component", "cells")).alias("places"))
    sets = sets_of(materialize(asked, "near-asked"), docs, doc_id, text, shingle)
    split = sets.select("id", "s", F.explode("places").alias("place")).select("id", "s", "place.*")
    split = split.withColumn("own", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select(
        "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "s")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        listed = t["s"].combine_chunks()
        starts = np.concatenate(([0], np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))))
        a, b = set_links(t["id"].to_numpy(), t["side"].to_numpy(), starts, listed.flatten().to_numpy(), jaccard)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return split.groupBy("component", "low", "high").applyInArrow(compare, "a long, b long")


def groups_of_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(node, component)`` of pairs that hang together in at most BLOCK_ROWS rows, and the pairs ``(a, b)`` of longer chains."""
    groups = materialize(components(pairs, "a", "b"), "near-groups")
    small = F.col("n") <= BLOCK_ROWS
    sized = groups.join(groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "component")
    chained = pairs.select("a", "b").join(sized.filter(~small).select(F.col("node").alias("a")), "a", "left_semi")
    return sized.filter(small).select("node", "component"), chained


def near_text_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, jaccard: float = 0.8, bits: int = 60, words: int = 4, blocks: int = 11,
    crowd: int = CROWD,
) -> DataFrame:
    """``(doc_id, digest, component)``, one row for each row of ``docs``; near duplicates share the component.

    ``digest`` is the md5 of the text (null counts as empty). Equal texts are one class before any comparison. Classes link
    when their sets of ``shingle``-word shingles (A-Z lower-cased, words cut at ASCII white space; fewer
    words are one shingle) have a Jaccard similarity of ``jaccard`` or more, and texts without words link with each other;
    no pair below it links. Candidates are pairs of fingerprints of ``64 * words`` bits that
    differ in at most ``bits`` and, in one of ``blocks`` runs of 23 bits, in at most two; where more than ``crowd`` hang together at an
    anchor, all of them are compared. ``component``
    is a number that means nothing else. Rows with a null id have classes like others; rows of one id and
    different texts are different rows; extra columns play no part; an empty table gives no rows.
    """
    require(docs, doc_id, text)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle, words) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.binary())], names=["doc_id", "digest", "n_bytes", "fingerprint"])

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _digest(text).alias("digest"), n_bytes, F.col(text).alias("text"))
    rows = materialize(picked.mapInArrow(run, "doc_id long, digest string, n_bytes long, fingerprint binary"), "near-rows")
    classes = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.any_value("fingerprint").alias("fingerprint"))
    # Numbers are fixed once written.
    classes = materialize(classes.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    found = materialize(candidates(classes, bits, words, blocks, crowd), "near-candidates")
    groups, chained = groups_of_pairs(found.filter("NOT crowd"))
    # A row may be in a crowd and in a group; groups have the negative numbers.
    groups = groups.select("node", (-1 - F.col("component")).alias("component"))
    crowds = components(found.filter("crowd"), "a", "b").unionByName(groups)
    linked = crowd_links(crowds, classes, docs, doc_id, text, shingle, jaccard)
    chained = materialize(chained, "near-chained")
    if not chained.isEmpty():
        ids = chained.select(F.col("a").alias("id")).unionByName(chained.select(F.col("b").alias("id"))).distinct()
        asked = materialize(classes.join(ids, "id").select("id", F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")), "near-asked")
        sets = materialize(sets_of(asked, docs, doc_id, text, shingle), "near-sets")
        linked = linked.unionByName(verified(chained, sets, jaccard))
    parts = components(linked, "a", "b")
    named = classes.join(parts, classes["id"] == parts["node"], "left").select("digest", F.coalesce("component", "id").alias("component"))
    return rows.select("doc_id", "digest").join(materialize(named, "near-named"), "digest")


def distinct_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, columns as they are.

    The row with the smallest id stays (null ids last; ties: the smallest digest of the text, then the
    smallest hash of the row's columns, and of wholly equal rows one). Groups are those of ``near_text_groups``.
    """
    groups = near_text_groups(docs, doc_id, text, **options)
    members = materialize(groups.groupBy("component", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "near-members")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("digest").alias("digest"))
    best = members.groupBy("component").agg(F.min(rank).alias("best"))
    marked = members.join(best, "component").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "n", (F.col("best") == rank).alias("__stays"))
    # Only rows that go or come more than once are looked up; most others stay where they are at any size.
    marked = materialize(marked.filter("NOT __stays OR n > 1"), "near-marked")
    keyed = docs.withColumns({"__key": F.col(doc_id).cast("long"), "__d": _digest(text)})
    same = F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__digest"))
    looked = _asked(marked, "__key", "__d")
    once = keyed.filter(~looked).unionByName(keyed.filter(looked).join(marked, same, "left_anti")).select(*docs.columns)
    plain = [c.name for c in docs.schema if c.dataType.typeName() not in ("map", "variant")]
    repeated = keyed.filter(looked).join(marked.filter("__stays"), same).groupBy("__id", "__digest").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("row"))
    return once.unionByName(repeated.select("row.*"))
