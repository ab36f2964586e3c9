import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from etlkit.llm import simhash
from etlkit.llm.common import components


def brute_fingerprint(text, shingle=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = [w for w in words.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64(s, seed=42).intdigest() >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out


def brute_components(prints, threshold):
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= threshold:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in prints}


def test_fingerprint_matches_definition():
    texts = ["", None, " \t\n", "One", "one TWO", "Ä ö ß É word word word", "a b c d e f g " * 40, "x\x0by\x0cz", "non breaking space stays"]
    for text in texts:
        assert int.from_bytes(simhash.fingerprint(text), "big") == brute_fingerprint(text)
    # Chunks do not matter.
    long = " ".join(str(i % 977) for i in range(3000))
    assert simhash.fingerprint(long, chunk=100) == simhash.fingerprint(long)
    assert simhash.fingerprint(long, words=4)[:8] == simhash.fingerprint(long)


def test_spark_hash_agrees(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest("one two three", 42)


def test_code_covers_and_pairs_meet():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 300)
    row, anchor, home = simhash.anchors_of(x, 5)
    assert home.sum() == 300  # one nearest anchor each: the code is perfect
    at = [set(anchor[row == i]) for i in range(300)]
    nearest = {i: a for i, a, h in zip(row, anchor, home) if h}
    for i in range(300):
        y = x[i] ^ (1 << int(rng.integers(23))) ^ (1 << int(rng.integers(23)))
        _, near_y, home_y = simhash.anchors_of(np.array([y]), 5)
        assert nearest[i] in set(near_y) and near_y[home_y][0] in at[i]
        _, tight_x, _ = simhash.anchors_of(x[i : i + 1], 4)
        _, tight_y, _ = simhash.anchors_of(np.array([y]), 4)
        assert set(tight_x) & set(tight_y)


def test_groups_match_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    base = [[rnd.choice(words) for _ in range(60)] for _ in range(12)]
    texts = []
    for b in base:
        texts.append(" ".join(b))
        for _ in range(6):
            c = list(b)
            c[rnd.randrange(60)] = rnd.choice(words)
            texts.append(" ".join(c))
    texts += [None, "", "  ", "one", "One", texts[0], texts[0].upper()]
    rows = [(i * 3 + 1, t, "x", 1) for i, t in enumerate(texts)] + [(None, "no id", "x", 1), (1, texts[0], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, id int").repartition(3)
    got = simhash.near_groups(docs).collect()
    assert len(got) == len(rows)
    want = brute_components({i: brute_fingerprint(t) for i, t, *_ in rows if i is not None}, 2)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
    # Crowded anchors are cut in cells without losing a link.
    monkeypatch.setattr(simhash, "CELL_ROWS", 3)
    assert {(r.doc_id, r.component_id) for r in simhash.near_groups(docs).collect()} == {(r.doc_id, r.component_id) for r in got}


def test_product_code_finds_the_same_links(spark):
    rng = np.random.default_rng(9)
    x, y = rng.integers(0, 1 << 23, 200), rng.integers(0, 1 << 23, 200)
    row, anchor, home = simhash.product_anchors(x, y, 2)
    assert home.sum() == 200 and 40 < len(row) / 200 < 90
    nearest = {i: a for i, a, h in zip(row, anchor, home) if h}
    for i in range(200):
        flips = [1 << int(k) for k in rng.integers(0, 46, 2)]
        u, v = x[i], y[i]
        for f in flips:
            u, v = (u ^ f, v) if f < 1 << 23 else (u, v ^ (f >> 23))
        assert nearest[i] in set(simhash.product_anchors(np.array([u]), np.array([v]), 2)[1])
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = [int(b) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for b in base for _ in range(4)]
    rows = [(i, p.to_bytes(8, "big")) for i, p in enumerate(dict.fromkeys(prints))]
    classes = spark.createDataFrame(rows, "id long, fingerprint binary")
    want = brute_components({i: int.from_bytes(p, "big") for i, p in rows}, 2)
    for codes in (1, 2):
        got = {r.node: r.component for r in components(simhash.links(classes, 2, codes=codes), "id", "low").collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_loose_threshold_finds_near_copies(spark):
    rnd = random.Random(5)
    rows, pairs = [], []
    for k in range(60):
        b = [f"v{rnd.randrange(4000)}" for _ in range(200)]
        c = list(b)
        for _ in range(3):  # at most 15 of 196 shingles differ
            c[rnd.randrange(200)] = f"u{rnd.randrange(4000)}"
        rows += [(2 * k, " ".join(b)), (2 * k + 1, " ".join(c))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(docs, shingle=5, words=4, blocks=11, threshold=52, everywhere=True).collect()}
    assert sum(got[2 * k + 1] == 2 * k for k in range(60)) >= 57
    assert all(got[2 * k] == 2 * k for k in range(60))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_groups(docs).count() == 0


def test_loose_threshold_over_blocks_is_exact(spark):
    rng, rows, far = np.random.default_rng(5), [], [5] * 8 + [4] * 3
    for k in range(60):
        bits = rng.integers(0, 2, 256, dtype=np.uint8)
        other = bits.copy()
        # 52 differing bits, four or five in each block; every third pair has one more.
        for b, n in enumerate(rng.permutation(far)):
            other[b * 23 + rng.choice(23, n, replace=False)] ^= 1
        if k % 3 == 0:
            other[255] ^= 1
        rows += [(2 * k, np.packbits(bits).tobytes()), (2 * k + 1, np.packbits(other).tobytes())]
    classes = spark.createDataFrame(rows, "id long, fingerprint binary")
    got = {(r.id, r.low) for r in simhash.links(classes, 52, 4, 11, True).collect()}
    assert got == {(2 * k + 1, 2 * k) for k in range(60) if k % 3}
