"""SimHash near-duplicates by anchor-point covering.

The binary Golay code of length 23 is perfect: every 23-bit word lies within 3 bits of exactly one
of its 4,096 codewords, so its codewords serve as anchors with covering radius 3. Two words at most
``t`` bits apart meet at an anchor when one is filed under its nearest anchor (its home) and the
other under every anchor within 3 + t bits. A fingerprint is cut into 23-bit blocks; whole
fingerprints at most ``t`` bits apart are at most ``t`` bits apart in any block, so one block is
enough for an exact join at a small threshold. Very many fingerprints take the product of two codes, a
codeword for each of two blocks (16.8 million anchors), so that anchors stay small; the bits beyond
radius 3 that a copy may differ by are then shared between the blocks. A loose threshold on a wide
fingerprint uses several blocks on their own: a pair is found when at least one of them differs in four
bits or fewer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import components, materialize, merge_links
from etlkit.runtime import require

SEED = 42
BLOCK = 23
RADIUS = 3
# Generator polynomial of the binary Golay code (a fixed value of the code).
GENERATOR = 0b110001110101
# Rows compared in one call, about, and rows of an anchor compared in one cell.
GROUP_ROWS, CELL_ROWS = 20_000, 20_000
# From so many distinct fingerprints on, two codes give fewer copies and comparisons than one.
TWO_CODES_FROM = 40_000_000


def _spread_bits(h: np.ndarray, words: int) -> np.ndarray:
    """One 64-bit hash to ``words`` of them (the first is the hash itself), by a 64-bit finaliser."""
    out = np.empty((len(h), words), dtype=np.uint64)
    out[:, 0] = h
    for k in range(1, words):
        x = h + np.uint64((k * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def fingerprint(text: str | None, shingle: int = 3, words: int = 1, chunk: int = 16_384) -> bytes:
    """The fingerprint of a text, most significant bit first.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles keep repeats.
    Fewer words than a shingle make one shingle of all; none give zero. Memory is bounded by
    ``chunk`` shingles beyond the text itself.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return bytes(8 * words)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(tokens))
    starts, ends = starts[: len(tokens) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64 * words, dtype=np.int64)
    for at in range(0, len(starts), chunk):
        pairs = zip(starts[at : at + chunk], ends[at : at + chunk])
        h = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)
        bits = np.unpackbits(_spread_bits(h, words).astype(">u8").view(np.uint8).reshape(len(h), -1), axis=1)
        # Sums of at most 255 bits fit the bytes they are made of.
        total += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(starts)).tobytes()


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1) -> DataFrame:
    """``(doc_id, fingerprint binary)`` for every row; a null text counts as empty."""
    require(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle, words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["doc_id", "fingerprint"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "doc_id long, fingerprint binary")


def _remainder(x: int) -> int:
    for k in range(BLOCK - 1, 10, -1):
        if x >> k & 1:
            x ^= GENERATOR << (k - 11)
    return x


@cache
def covering(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns up to ``reach`` bits, grouped by syndrome (lightest first): starts, patterns, syndrome tables."""
    unit = [_remainder(1 << k) for k in range(BLOCK)]
    found: list[tuple[int, int, int]] = []
    for weight in range(reach + 1):
        for bits in combinations(range(BLOCK), weight):
            syndrome = error = 0
            for k in bits:
                syndrome ^= unit[k]
                error |= 1 << k
            found.append((syndrome, weight, error))
    found.sort()
    table = np.array(found, dtype=np.int64)
    starts = np.searchsorted(table[:, 0], np.arange(2049))
    tables = np.array([[_remainder(v << s) if v << s < 1 << BLOCK else 0 for v in range(256)] for s in (0, 8, 16)])
    return starts, table[:, 2], tables


def anchors_of(x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 23-bit words: row number, anchor and whether it is the row's nearest, of all anchors within ``reach``."""
    starts, errors, tables = covering(reach)
    syndrome = tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][x >> 16]
    first, count = starts[syndrome], starts[syndrome + 1] - starts[syndrome]
    row = np.repeat(np.arange(len(x)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    # Any 12 consecutive bits of a cyclic codeword name it.
    return row, (x[row] ^ errors[at]) >> 11, at == first[row]


def product_anchors(x: np.ndarray, y: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for pairs of 23-bit words and pairs of codewords.

    If two words differ by ``d1`` bits in one block and ``d2`` in the other, with ``d1 + d2`` at most
    ``threshold``, the second is within ``3 + d1`` and ``3 + d2`` bits of the first's nearest codewords.
    So a copy goes to pairs of codewords whose distances exceed 3 by at most ``threshold`` in all.
    """
    one, two = anchors_of(x, RADIUS + threshold), anchors_of(y, RADIUS + threshold)
    over = [np.maximum(np.bitwise_count(_codeword_distance(w, row, a)).astype(np.int64) - RADIUS, 0) for w, (row, a, _) in ((x, one), (y, two))]
    starts = np.searchsorted(two[0], np.arange(len(y) + 1))
    first, count = starts[one[0]], (starts[1:] - starts[:-1])[one[0]]
    left = np.repeat(np.arange(len(one[0])), count)
    right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    near = over[0][left] + over[1][right] <= threshold
    left, right = left[near], right[near]
    return one[0][left], one[1][left] * 4096 + two[1][right], one[2][left] & two[2][right]


def _codeword_distance(words: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Differing bits, as a mask, of each word and the codeword that an anchor names."""
    return words[row] ^ _codewords()[anchor]


@cache
def _codewords() -> np.ndarray:
    """All codewords by their leading 12 bits."""
    return np.array([(m << 11) ^ _remainder(m << 11) for m in range(4096)])


def _blocks(raw: np.ndarray, blocks: int) -> list[np.ndarray]:
    """The first ``blocks`` runs of 23 bits of each row of bytes, as integers."""
    bits = np.unpackbits(raw, axis=1)
    weights = 1 << np.arange(BLOCK - 1, -1, -1, dtype=np.int64)
    return [bits[:, b * BLOCK : (b + 1) * BLOCK].astype(np.int64) @ weights for b in range(blocks)]


def link_within(ids: np.ndarray, words: np.ndarray, home: np.ndarray, side: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest over the rows of one anchor: ``(id, lowest linked id)`` for rows not their own lowest.

    Every home row is compared with every row (of the other side, where a crowded anchor was cut in
    cells). Links are merged block by block, so no list of pairs outlives its block.
    """
    order = np.argsort(ids, kind="stable")
    ids, words, home, side = ids[order], words[order], home[order], side[order]
    labels, homes = np.arange(len(ids)), np.flatnonzero(home)
    two = side.min(initial=0) != side.max(initial=0)
    step = max(1, 2_000_000 // max(1, len(ids)))
    for at in range(0, len(homes), step):
        rows = homes[at : at + step]
        near = np.bitwise_count(words[rows, None, 0] ^ words[None, :, 0]).astype(np.int16)
        if words.shape[1] > 1:
            near += np.bitwise_count(words[rows, None, 1] ^ words[None, :, 1])
        i, j = np.nonzero(near <= threshold)
        keep = rows[i] != j if not two else side[rows[i]] != side[j]
        i, j = i[keep], j[keep]
        if words.shape[1] > 2 and len(i):
            far = np.bitwise_count(words[rows[i], 2:] ^ words[j, 2:]).sum(axis=1, dtype=np.int64) + near[i, j]
            i, j = i[far <= threshold], j[far <= threshold]
        if len(i):
            labels = merge_links(labels, rows[i], j)
    moved = np.flatnonzero(labels != np.arange(len(ids)))
    return ids[moved], ids[labels[moved]]


def links(classes: DataFrame, threshold: int, words: int = 1, blocks: int = 1, everywhere: bool = False, codes: int | None = None) -> DataFrame:
    """``(id, low)``: spanning links between rows ``(id long, fingerprint binary)`` of distinct fingerprints.

    By default a row is at home with its nearest anchor and copied to all within the covering radius
    plus ``threshold``; every pair within the threshold is found. With ``everywhere`` a pair counts
    as met in a block when it differs there in four bits or fewer. Such a pair has a midpoint at most
    two bits from both, whose anchor lies within radius + 2 of both, so rows are filed there and all
    are compared; every pair is found when the threshold is below five bits a block. A crowded anchor is cut in cells by id and every
    pair of its cells is compared in a task of its own; nothing is capped. ``codes`` of 2 files under
    anchors of the product code, which is the default for very many fingerprints; links between the
    same rows are found either way.
    """
    reach = RADIUS + (2 if everywhere else threshold)
    many = classes.count()
    codes = codes or (2 if many >= TWO_CODES_FROM and not everywhere else 1)
    if codes not in (1, 2) or codes == 2 and (everywhere or blocks != 1):
        raise ValueError("two codes make one anchor of two blocks")
    # Anchors are compared in bundles of a bounded expected number of rows.
    copies = many * (61 if codes == 2 else 22 if not everywhere else 22 * blocks)
    width = max(1, int((1 << 24 if codes == 2 else 4096 * blocks) // max(512 * blocks, copies / GROUP_ROWS)))
    columns = [f"w{k}" for k in range(words)]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(len(ids), 8 * words)
            longs = raw.view(">u8").astype(np.uint64).view(np.int64)
            cut = _blocks(raw, 2 if codes == 2 else blocks)
            for b, x in enumerate(cut[:blocks]):
                for at in range(0, len(ids), 4096):
                    if codes == 2:
                        row, anchor, home = product_anchors(x[at : at + 4096], cut[1][at : at + 4096], threshold)
                    else:
                        row, anchor, home = anchors_of(x[at : at + 4096], reach)
                    row += at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((anchor + 4096 * b).astype(np.int32)), pa.array(home | everywhere), pa.array(ids[row]),
                         *[pa.array(longs[row, k]) for k in range(words)]], names=["anchor", "home", "id", *columns])

    def compare(table: pa.Table) -> pa.Table:
        ids, anchor = table["id"].to_numpy(), table["anchor"].to_numpy()
        home, side = table["home"].to_numpy(), table["side"].to_numpy()
        packed = np.stack([table[c].to_numpy() for c in columns], axis=1).view(np.uint64)
        order = np.argsort(anchor, kind="stable")
        cuts = np.flatnonzero(np.diff(anchor[order])) + 1
        found = [link_within(ids[g], packed[g], home[g], side[g], threshold) for g in np.split(order, cuts) if len(g) > 1]
        a, b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
        return pa.table({"id": pa.array(a, pa.int64()), "low": pa.array(b, pa.int64())})

    schema = "anchor int, home boolean, id long, " + ", ".join(f"{c} long" for c in columns)
    filed = classes.select("id", "fingerprint").mapInArrow(replicate, schema)
    crowded = filed.groupBy("anchor").count().filter(F.col("count") > CELL_ROWS)
    crowded = crowded.select("anchor", F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("cells"))
    cell = F.pmod(F.xxhash64("id"), F.col("cells")).cast("int")
    split = filed.join(crowded, "anchor", "left").withColumn("cells", F.coalesce("cells", F.lit(1))).withColumn("own", cell)
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    split = split.withColumn("low_cell", F.least("own", "other")).withColumn("high_cell", F.greatest("own", "other"))
    split = split.withColumn("side", (F.col("own") > F.col("other")).cast("int"))
    split = split.withColumn("bundle", F.expr(f"anchor div {width}"))
    grouped = split.groupBy("bundle", "low_cell", "high_cell")
    return grouped.applyInArrow(compare, "id long, low long")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, threshold: int = 2,
    words: int = 1, blocks: int = 1, everywhere: bool = False,
) -> DataFrame:
    """``(doc_id, fingerprint binary, component_id)``, one row for each row of ``docs``.

    Fingerprints of ``64 * words`` bits link at ``threshold`` or fewer differing bits;
    ``component_id`` is the smallest doc_id reachable, the row's own included. Rows of one fingerprint
    are one class before any comparison, however many they are. Empty and null texts share the zero
    fingerprint and link like any other. Rows with a null doc_id get a null component. Other columns,
    whatever their names, play no part. An empty table gives no rows.
    """
    hashed = materialize(fingerprints(docs, doc_id, text, shingle, words), "fingerprints")
    known = hashed.filter("doc_id IS NOT NULL")
    classes = materialize(known.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "classes")
    linked = components(links(classes, threshold, words, blocks, everywhere), "id", "low")
    # A class is one row here, so a hot fingerprint is hot on the detail side alone, which AQE can split.
    named = classes.join(linked, classes["id"] == linked["node"], "left")
    named = materialize(named.select("fingerprint", F.coalesce("component", "id").alias("component_id")), "named")
    return hashed.join(named, "fingerprint", "left").select(
        "doc_id", "fingerprint", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
