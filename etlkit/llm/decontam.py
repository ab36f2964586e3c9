"""Benchmark decontamination by spaced seeds.

A spaced seed looks at some positions of a window of tokens and ignores the rest, so a hit survives
substitutions at the ignored positions. Hashes of the benchmark and of the corpus under short seeds,
of which every overlap asked for holds one, are joined; around each hit the two texts are laid side
by side and the overlap is verified by counting equal tokens, substitutions allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import bound_batches, materialize
from etlkit.runtime import require

TOKEN = re.compile(r"\w+")
# Seeds of the join (fixed masks, 0 is ignored). Together they meet every overlap of 16 or 15 tokens with three
# substitutions and of 12 to 14 tokens with two; ``seeds_for`` tries all of these.
SEEDS = ("111101", "1100111")
# Runs of three that are counted before a seed is sent: an overlap holds some whatever is substituted.
GRAM = "111"
# Items below this number of tokens are looked for as a whole.
SHORT = 12
# Bits of the filter that is sent to the executors, as a power of two: 4 MiB whatever the benchmark.
FILTER_LOG2 = 25
MULTIPLIERS = np.random.default_rng(20240).integers(1, 2**62, (2, SHORT), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """64-bit hashes of tokens, remembered up to a number of tokens."""

    def __missing__(self, token: str) -> int:
        h = xxhash.xxh64_intdigest(token, 17)
        if len(self) >= 100_000:
            self.clear()
        self[token] = h
        return h


def token_hashes(text: str | None, memory: _Hashes) -> np.ndarray:
    """Hashes of the lower-cased words of a whole text. Equal words have equal hashes."""
    found = TOKEN.findall((text or "").lower())
    return np.fromiter(map(memory.__getitem__, found), dtype=np.uint64, count=len(found))


def pattern_hashes(tokens: np.ndarray, pattern: str, row: int = 0) -> np.ndarray:
    """Hash of the places of every window that a pattern marks by 1, different for each pattern."""
    n = len(tokens) - len(pattern) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.full(n, int("1" + pattern, 2), dtype=np.uint64)
    for k, seen in enumerate(pattern):
        if seen == "1":
            h += tokens[k : k + n] * MULTIPLIERS[row, k]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def needed(n: int, window: int, share: float) -> int:
    """Equal tokens that make an overlap with an item of ``n`` tokens: all of a short one, else a share of the window."""
    return n if n < SHORT else int(np.ceil(share * min(window, n) - 1e-9))


@cache
def seeds_for(n: int, changed: int) -> tuple[str, ...]:
    """Seeds of which every window of ``n`` tokens with at most ``changed`` substitutions holds one."""
    for many in range(1, len(SEEDS) + 1):
        places = [{at + k for k, seen in enumerate(s) if seen == "1"} for s in SEEDS[:many] for at in range(n - len(s) + 1)]
        if all(any(p.isdisjoint(c) for p in places) for c in combinations(range(n), changed)):
            return SEEDS[:many]
    raise ValueError(f"no seeds find every overlap of {n} tokens with {changed} substitutions")


def _counted(hits: np.ndarray, width: int, least: int) -> np.ndarray:
    """Positions from which ``width`` places hold ``least`` hits, and the ``width - 1`` positions after each of them."""
    total = np.cumsum(np.concatenate(([0], hits, np.zeros(width, dtype=np.int64))))
    full = (total[width:] - total[:-width] >= least)[: len(hits)]
    total = np.cumsum(np.concatenate((np.zeros(width, dtype=np.int64), full)))
    return total[width:] > total[:-width]


def _joined_spans(positions: np.ndarray, reach: int, n: int) -> list[tuple[int, int]]:
    """Stretches of tokens within ``reach`` of some position, overlapping ones joined."""
    low, high = np.maximum(positions - reach, 0), np.minimum(positions + SHORT + reach, n)
    cut = np.flatnonzero(low[1:] > high[:-1]) + 1
    starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(low)]))
    return [(int(low[a]), int(high[b - 1])) for a, b in zip(starts, ends)]


def best_overlap(tokens: np.ndarray, item: np.ndarray, offset: int, window: int) -> int:
    """Most equal tokens in any ``window`` neighbouring positions of an item laid over a text.

    ``offset`` is the text position of the item's first token (it may be negative).
    """
    low, high = max(0, -offset), min(len(item), len(tokens) - offset)
    if high - low < window:
        return 0
    equal = np.cumsum(np.concatenate(([0], item[low:high] == tokens[low + offset : high + offset])))
    return int((equal[window:] - equal[:-window]).max())


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 16, share: float = 0.8, longest_item: int = 4_096, least_item: int = 1,
) -> DataFrame:
    """``(doc_id, item_id, overlap)`` of every pair of a row and an item with a verified overlap.

    An overlap is ``window`` neighbouring tokens of an item of which at least ``share`` stand at the
    same places of the text; ``overlap`` is the largest count of equal tokens. Every overlap holds one
    of the seeds; a window and share for which none of them is sure to raise ``ValueError``. An item
    shorter than ``window`` is its own window, and below 12 tokens all of them must be equal. Items
    below ``least_item`` tokens and without any match nothing (with 1, a document that holds a one-word item
    matches it); null texts count as empty. An item above ``longest_item`` tokens is cut in pieces
    that overlap by two windows, so each part of it is looked for. Rows of one id count as one document; rows and items with a null
    id are left out. An empty table on either side gives no rows.
    """
    lengths = range(SHORT, window + 1)
    if window < SHORT:
        raise ValueError(f"a window has {SHORT} tokens or more")
    asked = {n: seeds_for(n, n - needed(n, window, share)) for n in lengths}
    # A substitution takes away at most three of a window's runs of three.
    least = min(n - len(GRAM) + 1 - len(GRAM) * (n - needed(n, window, share)) for n in lengths)
    require(docs, doc_id, text)
    bound_batches(docs.sparkSession)
    require(benchmark, item_id, item_text)
    kinds = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Hashes()
        for batch in batches:
            ids, numbers, parts = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = token_hashes(t, memory)
                for at in range(0, max(1, len(tokens) - 2 * window), longest_item - 2 * window):
                    part = tokens[at : at + longest_item]
                    if len(part) and len(tokens) >= least_item:
                        ids.append(i), numbers.append(at), parts.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.types[0]), pa.array(numbers, pa.int64()), pa.array(parts, pa.binary())], names=["item_id", "piece", "item"])

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, number, raw in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.frombuffer(raw, dtype=np.uint64)
                patterns = ("1" * len(tokens),) if len(tokens) < SHORT else asked[min(window, len(tokens))]
                # Runs that are only counted have no place.
                counted = pattern_hashes(tokens, GRAM)[: len(tokens) if len(tokens) >= SHORT else 0]
                hashes = [pattern_hashes(tokens, q, int(len(tokens) < SHORT)) for q in patterns]
                at = np.concatenate([*map(np.arange, map(len, hashes)), np.full(len(counted), -1)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([*hashes, counted]).view(np.int64)), pa.array([i] * len(at), batch.schema.types[0]),
                     pa.array([number] * len(at), pa.int64()), pa.array(at, pa.int32())], names=["hash", "item_id", "piece", "item_at"])

    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).filter("item_id IS NOT NULL")
    items = materialize(items.distinct().mapInArrow(pieces, f"item_id {kinds[1]}, piece long, item binary"), "items")
    seeded = materialize(items.mapInArrow(seeds, f"hash long, item_id {kinds[1]}, piece long, item_at int"), "seeds")

    # A bitmap of fixed size, built from at most 2^19 words, keeps windows that no item can match off the network.
    slot = F.shiftrightunsigned("hash", 64 - FILTER_LOG2)
    cells = seeded.select(F.shiftright(slot, 6).cast("int").alias("cell"), (slot % 64).cast("int").alias("bit"))
    cells = cells.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    bitmap = np.zeros(1 << (FILTER_LOG2 - 6), dtype=np.uint64)
    for row in cells.toLocalIterator():
        bitmap[row.cell] = np.uint64(row.bits % 2**64)
    size = F.octet_length("item") / 8
    short = sorted(int(r.n) for r in items.filter(size < SHORT).select(size.alias("n")).distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, words, shift = _Hashes(), shared.value, np.uint64(64 - FILTER_LOG2)

        def known(h: np.ndarray) -> np.ndarray:
            place = h >> shift
            return (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)

        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = token_hashes(value.as_py(), memory)
                marks, hashes, places = np.zeros(len(tokens), dtype=bool), [], []
                near = _counted(known(pattern_hashes(tokens, GRAM)), window - len(GRAM) + 1, least) if least > 0 else np.ones(len(tokens), dtype=bool)
                patterns = [(q, 0) for q in SEEDS if near.any()] + [("1" * n, 1) for n in short]
                for q, whole in patterns:
                    h = pattern_hashes(tokens, q, whole)
                    hit = known(h)
                    hit = np.flatnonzero(hit if whole else hit & near[: len(h)])
                    marks[hit] = True
                    hashes.append(h[hit]), places.append(hit)
                if not marks.any():
                    continue
                all_h, all_p = np.concatenate(hashes).view(np.int64), np.concatenate(places)
                for low, high in _joined_spans(np.flatnonzero(marks), 2 * window, len(tokens)):
                    inside = (all_p >= low) & (all_p < high)
                    out[0].append(i), out[1].append(low), out[2].append(tokens[low:high].tobytes())
                    out[3].append([{"hash": int(h), "at": int(p - low)} for h, p in zip(all_h[inside], all_p[inside])])
            hit_type = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.types[0]), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()), pa.array(out[3], hit_type)],
                names=["doc_id", "low", "span", "hits"])

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    spans = materialize(read.mapInArrow(scan, f"doc_id {kinds[0]}, low long, span binary, hits array<struct<hash:long,at:int>>"), "spans")
    # Equal spans, as copies of a document have, are verified once.
    spans = spans.withColumn("key", F.sha2("span", 256))
    texts = spans.groupBy("key").agg(F.any_value("span").alias("span"), F.any_value("hits").alias("hits"))
    texts = materialize(texts, "span-texts")
    hits = texts.select("key", F.explode("hits").alias("hit")).select("key", "hit.hash", "hit.at").distinct()
    found = hits.join(seeded.filter("item_at >= 0"), "hash").select("key", "item_id", "piece", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    found = found.join(texts.select("key", "span"), "key").join(items, ["item_id", "piece"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            best = []
            for s, t, o in columns:
                item = np.frombuffer(t, np.uint64)
                n = best_overlap(np.frombuffer(s, np.uint64), item, o, min(window, len(item)))
                best.append(n if n >= needed(len(item), window, share) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.int32())], names=["key", "item_id", "overlap"])

    checked = found.select("key", "item_id", "span", "item", "offset").mapInArrow(verify, f"key string, item_id {kinds[1]}, overlap int")
    checked = checked.filter("overlap > 0").groupBy("key", "item_id").agg(F.max("overlap").alias("overlap"))
    checked = materialize(checked, "verified")
    return spans.select("doc_id", "key").join(checked, "key").groupBy("doc_id", "item_id").agg(F.max("overlap").alias("overlap"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, columns as they are, whose text has no verified overlap. Ids, null ones too, play no part."""
    keyed = docs.select(F.md5(text).alias("__key"), F.col(text).alias("text"))
    bad = contaminated(keyed, benchmark, "__key", **options).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(materialize(bad, "bad-documents"), F.md5(text) == F.col("__bad"), "left_anti")
