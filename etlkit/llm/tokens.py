"""Token counts by a map-side two-tier lookup of pre-token lengths.

The vocabulary has no piece in which a space follows another character and none that holds a line
feed, so no merge crosses the start of a run of spaces or either side of a line feed. A text
is cut there into pre-tokens, whose token counts add up to the text's. The first tier is a small
broadcast table of frequent pre-tokens; the second is a cache in each Python worker, filled by the
tokenizer itself. Pre-tokens are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import require

PRE_TOKEN = re.compile(r" *[^ \n]+|\n+| +")
# The model's own sign for a space; it is read as one.
SPACE = "▁"
LONGEST_CACHED = 64


@cache
def processor(model: str | None):
    """The tokenizer of a model file, once per worker; by default the public 32k BPE model."""
    import sentencepiece

    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
        raise ValueError("this vocabulary merges across spaces or line feeds")
    if sp.encode("a  b ", out_type=str) != [SPACE + "a", SPACE, SPACE + "b", SPACE]:
        raise ValueError("this model trims or normalises spaces")
    return sp


class Lengths(dict):
    """First tier: frequent pre-tokens. What it lacks comes from a bounded cache, or from the tokenizer."""

    def __init__(self, frequent: dict[str, int], model: str | None, room: int) -> None:
        super().__init__(frequent)
        self.sp, self.room, self.cache = processor(model), room, {}

    def __missing__(self, pre: str) -> int:
        n = self.cache.get(pre)
        if n is None:
            # The line feed keeps the model from putting a space before the pre-token.
            n = len(self.sp.encode("\n" + pre)) - 2
            if len(pre) <= LONGEST_CACHED:
                if len(self.cache) >= self.room:
                    self.cache.clear()
                self.cache[pre] = n
        return n


def pre_tokens(text: str) -> Iterator[str]:
    """Pre-tokens of a text, with the space that the model puts first."""
    return (m.group() for m in PRE_TOKEN.finditer(" " + text.replace(SPACE, " ")))


_LENGTHS: dict[tuple, Lengths] = {}


def frequent_lengths(docs: DataFrame, text: str = "text", model: str | None = None, rows: int = 2_000, entries: int = 32_768) -> dict[str, int]:
    """The most frequent short pre-tokens of at most ``rows`` rows, with their token counts.

    It holds at most ``entries`` keys of at most 64 characters, so its broadcast is bounded (about
    3 MB as used). It only saves time: a text's count does not depend on what is in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(p for p in pre_tokens(t or "") if len(p) <= LONGEST_CACHED)
        lengths = Lengths({}, model, entries)
        top = [p for p, _ in seen.most_common(entries)]
        yield pa.RecordBatch.from_arrays([pa.array(top, pa.string()), pa.array([lengths[p] for p in top], pa.int32())], names=["pre", "n"])

    picked = docs.filter(F.pmod(F.xxhash64(text), F.lit(16)) == 0).select(text).limit(rows)
    return {r.pre: r.n for r in picked.mapInArrow(run, "pre string, n int").toLocalIterator()}


def token_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None, limit: int = 4096,
    room: int = 200_000,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row for each row of ``docs``.

    Tokens are those of the model without begin, end or added special tokens. Null and empty texts
    have 0 bytes and 0 tokens. Very long texts are read as a stream of pre-tokens; a pre-token of any
    length is encoded whole. Repeated rows and null ids stay as they are; other columns play no part.
    """
    require(docs, doc_id, text)
    warm = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (warm.id if hasattr(warm, "id") else id(warm), model, room)
        if key not in _LENGTHS:
            _LENGTHS.clear()
            _LENGTHS[key] = Lengths(warm.value, model, room)
        get = _LENGTHS[key].__getitem__
        for batch in batches:
            counts = []
            for value in batch.column(1):
                t = value.as_py()
                if not t:
                    counts.append(0)
                elif len(t) < 1 << 20:
                    counts.append(sum(map(get, PRE_TOKEN.findall(" " + t.replace(SPACE, " ")))))
                else:
                    counts.append(sum(map(get, pre_tokens(t))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), size)
    kind = docs.schema[doc_id].dataType.simpleString()
    counted = picked.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
