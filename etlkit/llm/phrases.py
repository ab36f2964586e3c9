"""Phrase collocations by SON partitioning.

The corpus is cut in a few shards by document. A phrase with the wanted number of occurrences has at
least its proportional share of them in some shard, so each shard is mined completely at its share of
the support (words of the shard over words of the language, rounded up), the phrases frequent in some
shard are united, and these candidates alone are counted over the whole corpus, exactly.

Mining works on 64-bit hashes, which can only add candidates; the counts are of the phrases' texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from etlkit.llm.common import materialize
from etlkit.runtime import require

# Separators of pieces become this byte, which no UTF-8 text holds.
BREAK = b"\xff"
TO_BREAK = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
WORD_PATTERN = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
# A phrase is packed in one integer, so many bits for the number of each word in its buffer.
ID_BITS, LONGEST = 21, 3
ID_MASK = (1 << ID_BITS) - 1
# Bytes of text counted together; with a byte and a space at least for each word, numbers fit ID_BITS.
BUFFER = 4_000_000
# Counted phrases merged in one call, about.
MERGED = 2_000_000
# Bits of the bitmap of candidates, as a power of two: 16 MiB whatever the corpus.
FILTER_LOG2 = 27
MULTIPLIERS = np.random.default_rng(11).integers(1, 2**62, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _numbered(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """Words of a prepared text as numbers from 1 on, 0 for a break, and the words by number less one."""
    raw = np.frombuffer(text.replace(BREAK, b" " + BREAK + b" "), dtype=np.uint8)
    inside = (raw != 0x20) & (raw != 0x09)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    lengths = edges[1::2] - edges[::2]
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    encoded = tokens.dictionary_encode()
    ids = encoded.indices.to_numpy().astype(np.int64) + 1
    at = encoded.dictionary.index(pa.scalar(BREAK, pa.binary())).as_py()
    if at >= 0:
        ids[ids == at + 1] = 0
    return ids, encoded.dictionary


def grams(ids: np.ndarray, skip: int, longest: int) -> np.ndarray:
    """All phrases of up to ``longest`` words that end at position ``skip`` or later, packed."""
    out = []
    for size in range(1, longest + 1):
        first = max(0, skip - size + 1)
        n = len(ids) - size + 1 - first
        if n <= 0:
            continue
        packed, whole = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        for k in range(size):
            part = ids[first + k : first + k + n]
            packed = packed << ID_BITS | part
            whole &= part > 0
        out.append(packed[whole])
    return np.concatenate(out) if out else np.empty(0, dtype=np.int64)


def _parts(packed: np.ndarray) -> list[np.ndarray]:
    """The word numbers of packed phrases, 0 before the first word of a short one."""
    return [packed >> ID_BITS * k & ID_MASK for k in reversed(range(LONGEST))]


def _hashes(packed: np.ndarray, words: pa.Array, lang: str) -> np.ndarray:
    table = np.zeros(len(words) + 1, dtype=np.uint64)
    table[1:] = np.fromiter((xxhash.xxh64_intdigest(w, 5) | 1 for w in words.to_pylist()), dtype=np.uint64, count=len(words))
    h = np.full(len(packed), xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 7), dtype=np.uint64)
    for part, factor in zip(_parts(packed), MULTIPLIERS):
        h += table[part] * factor
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _slices(text: bytes, size: int, carried: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts cut at spaces, each with the last ``carried`` words of the part before and their number."""
    at, before = 0, b""
    while at < len(text):
        cut = text.find(b" ", at + size)
        cut = len(text) if cut < 0 else cut
        part = text[at:cut]
        yield before + b" " + part, len(before.split())
        # Breaks are words here.
        last = (before + b" " + part).replace(BREAK, b" " + BREAK + b" ").rsplit(None, carried)[-carried:] if carried else []
        before, at = b" ".join(last), cut


def counted(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[tuple, pa.Array, np.ndarray, np.ndarray]]:
    """Phrases of (text, lang, shard) rows, counted in buffers: group, words, packed phrases, counts.

    A text longer than a buffer is counted part by part; a phrase belongs to the part in which it ends.
    """
    held: dict[tuple, list[bytes]] = {}
    size = 0

    def count(group: tuple, text: bytes, skip: int) -> tuple[tuple, pa.Array, np.ndarray, np.ndarray]:
        ids, words = _numbered(text)
        return group, words, *np.unique(grams(ids, skip, longest), return_counts=True)

    for batch in batches:
        for text, lang, shard in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            body = text.as_py().lower().translate(TO_BREAK)
            if len(body) > BUFFER:
                yield from (count((lang, shard), part, skip) for part, skip in _slices(body, BUFFER, longest - 1))
                continue
            held.setdefault((lang, shard), []).append(body)
            size += len(body)
            if size >= BUFFER:
                yield from (count(group, BREAK.join(texts), 0) for group, texts in held.items())
                held, size = {}, 0
    yield from (count(group, BREAK.join(texts), 0) for group, texts in held.items())


def _phrases(packed: np.ndarray, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts of packed phrases, and their sizes; phrases are sorted, so short ones come first."""
    parts = [p - 1 for p in _parts(packed)]
    sizes = sum((p >= 0).astype(np.int32) for p in parts)
    made = []
    for size in range(1, LONGEST + 1):
        rows = sizes == size
        taken = [words.take(pa.array(p[rows])) for p in parts[LONGEST - size :]]
        made.append(taken[0] if size == 1 else pc.binary_join_element_wise(*taken, pa.scalar(b" ", pa.binary())))
    return pa.concat_arrays(made), sizes


def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a hash among ``size`` (a power of two), from its first and its last bits."""
    return hashes >> np.uint64(65 - size.bit_length()), hashes & np.uint64(size - 1)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with the places of all hashes; it is put together from one row for each 64 places."""
    first, last = F.shiftrightunsigned("hash", 64 - FILTER_LOG2), F.col("hash").bitwiseAND((1 << FILTER_LOG2) - 1)
    slots = hashes.select(F.explode(F.array(first, last)).alias("slot"))
    cells = slots.select(F.shiftright("slot", 6).cast("int").alias("cell"), (F.col("slot") % 64).cast("int").alias("bit"))
    cells = cells.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(1 << max(0, FILTER_LOG2 - 6), dtype=np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.view(np.uint64)


def frequent(docs: DataFrame, lang: str, text: str, doc_id: str, longest: int, support: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases with ``f`` of at least ``support``, and ``(lang, n)``."""
    shard = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(shards)).cast("int")
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    body = F.coalesce(F.col(text), F.lit(""))
    words = docs.groupBy(named.alias("lang"), shard.alias("shard")).agg(F.sum(F.regexp_count(body, F.lit(WORD_PATTERN))).cast("long").alias("words"))
    words = materialize(words, "phrase-words")
    totals = materialize(words.groupBy("lang").agg(F.sum("words").cast("long").alias("n")), "phrase-totals")
    least = words.join(totals, "lang").select("lang", "shard", F.expr(f"({support} * words + n - 1) div greatest(n, 1)").alias("least"))
    least = materialize(least, "phrase-least")
    rows = docs.select(body.cast("binary").alias("text"), named.alias("lang"), shard.alias("shard"))
    # Buckets of hashes, as many as keep the phrases of a bucket of the largest shard within one call.
    largest = words.agg(F.max("words")).first()[0] or 0
    bits = max(1, int(np.ceil(np.log2(max(1, largest * longest / MERGED)))))

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Most phrases of a buffer come once, and need no count.
        for (name, part), words, packed, n in counted(batches, longest):
            hashes = _hashes(packed, words, name)
            order = np.argsort(hashes)
            hashes, n = hashes[order], n[order]
            buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(buckets)) + 1, [len(hashes)])) if len(hashes) else np.zeros(1, dtype=np.int64)
            out: tuple[list, ...] = ([], [], [], [])
            for low, high in zip(cuts[:-1], cuts[1:]):
                h, m = hashes[low:high], n[low:high]
                for column, value in zip(out, (int(buckets[low]), h[m == 1].tobytes(), h[m > 1].tobytes(), m[m > 1].astype(np.int32).tobytes())):
                    column.append(value)
            many = len(out[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * many, pa.string()), pa.array([part] * many, pa.int32()), pa.array(out[0], pa.int64()), *[pa.array(c, pa.binary()) for c in out[1:]]],
                names=["lang", "shard", "bucket", "once", "often", "times"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        once, often, times = (np.frombuffer(b"".join(t[c].to_pylist()), dtype=kind) for c, kind in (("once", np.uint64), ("often", np.uint64), ("times", np.int32)))
        order = np.argsort(hashes := np.concatenate([once, often]))
        hashes, n = hashes[order], np.concatenate([np.ones(len(once), dtype=np.int64), times.astype(np.int64)])[order]
        starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.empty(0, dtype=np.int64)
        total = np.add.reduceat(n, starts) if len(starts) else n
        found = hashes[starts][total >= t["least"][0].as_py()]
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    mined = rows.mapInArrow(mine, "lang string, shard int, bucket long, once binary, often binary, times binary").join(least, ["lang", "shard"])
    united = materialize(mined.groupBy("lang", "shard", "bucket").applyInArrow(merge, "hash long"), "phrase-candidates")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(united))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for (name, _), words, packed, n in counted(batches, longest):
            known = np.ones(len(packed), dtype=bool)
            for place in _places(_hashes(packed, words, name), 64 * len(bits)):
                known &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            packed, n = packed[known], n[known]
            for at in range(0, len(n), 100_000):
                texts, sizes = _phrases(packed[at : at + 100_000], words)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(name, len(texts)), texts, pa.array(sizes), pa.array(n[at : at + 100_000].astype(np.int64))], names=["lang", "phrase", "size", "m"])

    one = rows.withColumn("shard", F.lit(0))
    exact = one.mapInArrow(count, "lang string, phrase binary, size int, m long")
    exact = exact.groupBy("lang", F.col("phrase").cast("string").alias("phrase"), "size").agg(F.sum("m").alias("f"))
    return materialize(exact.filter(F.col("f") >= support), "phrase-counts"), totals


def score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))``, exact for counts below 10^16."""
    wide = lambda c: c.cast("decimal(16,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(left) * wide(right))


def collocations(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", longest: int = 3, support: int = 10,
    inside: int = 50, top: int = 2_000, shards: int = 3,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` best phrases of each language.

    Phrases have 2 to ``longest`` (at most 3) words of one piece of a text and ``a``, at least
    ``support``, occurrences, overlapping ones included. ``score`` is floor(10^6 a^2 / (l r)) at the cut in
    two parts, occurring ``l`` and ``r`` times, that scores lowest (ties: the shortest first part). A phrase that stands inside a longer
    one with at least ``inside`` percent of its occurrences is left out. ``n`` counts the language's
    words. Ties rank by ``a``, then by the phrase's bytes. A null language is ``und``, a null text
    is empty; repeated rows count as often as they come, null ids like any other; extra columns play
    no part. An empty table gives no rows.

    ``shards`` sets the local support alone: a shard is mined by all tasks, a phrase hash at a time, so neither a
    shard nor a language has to fit a task. Only a bitmap of fixed size is broadcast; where it fills up,
    more phrases are counted, with the same result.
    """
    require(docs, doc_id, text, lang)
    if not 2 <= longest <= LONGEST or support < 1 or shards < 1:
        raise ValueError(f"phrases have 2 to {LONGEST} words, support and shards are 1 or more")
    counts, totals = frequent(docs, lang, text, doc_id, longest, support, shards)
    phrases = counts.filter("size > 1")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)")})
    part = lambda name, f: counts.select(F.col("lang"), F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", score(F.col("f"), F.col("l"), F.col("r")))
    worst = cuts.groupBy("lang", "phrase", F.col("f").alias("a")).agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    held = phrases.filter("size > 2").select(
        "lang", "f", F.explode(F.expr("array(substring_index(phrase, ' ', size - 1), substring_index(phrase, ' ', 1 - size))")).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = worst.join(held, ["lang", "phrase"], "left").filter(F.expr(f"longer IS NULL OR 100 * longer < {inside} * a"))
    left = materialize(left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "phrase-scores")
    # The best of each of 16 parts of a language first, so that the last step sorts 16 times ``top`` rows a language at most.
    by_score = F.desc("score"), F.desc("a"), "phrase"
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(16))).orderBy(*by_score)
    first = left.withColumn("rank", F.row_number().over(parted)).filter(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
