import random
import re
from collections import Counter

import numpy as np
import pytest

from etlkit.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, phrase string, hash int, n int"


def brute(rows, longest=3, support=10, inside=50, top=2000):
    out = []
    for lang in sorted({r[2] or "und" for r in rows}):
        f, n = Counter(), 0
        for _, text, name, *_ in rows:
            if (name or "und") != lang:
                continue
            lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for size in range(1, longest + 1):
                    f.update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
        found = []
        often = [(q, g) for q, g in f.items() if len(q) > 2 and g >= support]
        for p, a in f.items():
            if len(p) < 2 or a < support:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [g for q, g in often if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q)))]
            if not any(100 * g >= inside * a for g in longer):
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def corpus():
    rnd = random.Random(3)
    names = ["alpha", "Beta", "gamma", "délta", "eps-ilon", "Z", "q\x0bq", " x", "İ"]
    rows = []
    for i in range(120):
        words = [rnd.choice(names) for _ in range(rnd.randrange(0, 60))]
        rows.append((i, "".join(w + rnd.choice([" ", " ", "  ", "\t", ", ", ". ", "\n"]) for w in words), rnd.choice(["en", "fr", None, "und"]), "x", 1, 2))
    rows += [(None, "new york city new york city", "en", "x", 1, 2)] * 12
    rows += [(100, None, "en", "x", 1, 2), (101, "", "zz", "x", 1, 2), (102, "a a a a a a a a a a a a", "aa", "x", 1, 2), (103, " ".join(["b c d"] * 40_000), "long", "x", 1, 2)]
    return rows


def got(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = P.collocations(frame, **options)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("options", [{}, {"shards": 1}, {"shards": 40, "support": 7}, {"longest": 2, "top": 3}])
def test_matches_brute_force(spark, options):
    rows = corpus()
    want = brute(rows, **{k: v for k, v in options.items() if k != "shards"})
    assert got(spark, rows, **options) == sorted(want) and len(want) >= 6


def test_buffers_and_parts_change_nothing(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["a", "b", "c", "d.", "e"], 500)).encode() for _ in range(8)] + [b"one two three", b"", b"x"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 11), pa.array([0, 1] * 5 + [0], pa.int32())], names=["t", "l", "s"])

    def total():
        out = Counter()
        for group, words, packed, n in P.counted(iter([batch]), 3):
            found, sizes = P._phrases(packed, words)
            for phrase, size, m in zip(found.to_pylist(), sizes.tolist(), n.tolist()):
                assert len(phrase.split()) == size
                out[group, phrase] += m
        return out

    whole = total()
    for size in (1, 7, 50, 999):
        monkeypatch.setattr(P, "BUFFER", size)
        assert total() == whole and sum(whole.values()) > 8 * 1000


def test_many_buckets_change_nothing(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(P, "MERGED", 5_000)
    monkeypatch.setattr(P, "BUFFER", 3_000)
    assert got(spark, rows) == sorted(brute(rows))


def test_a_full_bitmap_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(P, "FILTER_LOG2", 7)
    rows = corpus()
    assert got(spark, rows) == sorted(brute(rows))


def test_scores_beyond_64_bits(spark):
    a, left, right = 4 * 10**12, 5 * 10**12 + 1, 7 * 10**12 + 3
    frame = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert frame.select(P.score(frame.a, frame.l, frame.r)).first()[0] == 1_000_000 * a * a // (left * right)


def test_empty_table(spark):
    assert got(spark, []) == []
    with pytest.raises(ValueError):
        P.collocations(spark.createDataFrame([], SCHEMA), longest=4)
