import random

import numpy as np

from etlkit.llm import decontam as D

SCHEMA, ITEMS = "doc_id long, text string, item_id int, hash int", "item_id long, text string, doc_id int"


def corpus():
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(500)}"
    items = [(j, " ".join(word() for _ in range(rnd.randrange(14, 40))), 1) for j in range(8)] + [(8, "too short", 1), (9, None, 1), (None, "x " * 40, 1)]
    docs = []
    for i in range(40):
        words = [word() for _ in range(rnd.randrange(0, 90))]
        if i % 2:
            passage = items[rnd.randrange(8)][1].split()
            for _ in range(rnd.randrange(0, 7)):
                passage[rnd.randrange(len(passage))] = "changed"
            at = rnd.randrange(len(words) + 1)
            words[at:at] = passage[rnd.randrange(0, 8):]
        docs.append((i, ", ".join(words).upper(), 5, 6))
    docs += [(None, items[0][1], 5, 6), (41, None, 5, 6), (42, "", 5, 6), (1, docs[1][1], 5, 6), (43, items[2][1] + " " + "z " * 60_000, 5, 6)]
    return docs, items


def test_decontaminated_judges_every_row_by_its_text(spark):
    docs, items = corpus()
    docs = docs[:-1] + [(0, items[3][1], 5, 6)]
    d, b = spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS)
    bad = {docs[k][1] for k, _ in plain([(k, *r[1:]) for k, r in enumerate(docs)], items)}
    kept = D.decontaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, [r for r in d.select("doc_id", "text").collect() if r.text not in bad]))
    gone = [i for i, t, *_ in docs if t in bad]
    assert None in gone and 0 in gone and docs[0][1] not in bad


def test_items_above_the_piece_length(spark):
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(900)]
    d = spark.createDataFrame([(1, " ".join(words[690:715])), (2, " ".join(words[84:104])), (3, " ".join(words[884:900])), (4, " ".join(words[890:900]))], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    assert {r.doc_id for r in D.contaminated(d, b, longest_item=100).collect()} == {1, 2, 3}


def test_empty_tables(spark):
    docs, items = corpus()
    d, b = spark.createDataFrame(docs[:5], SCHEMA), spark.createDataFrame(items, ITEMS)
    assert D.contaminated(d.filter("doc_id < 0"), b).count() == 0
    assert D.contaminated(d, b.filter("item_id < 0")).count() == 0


def plain(docs, items, window=16):
    """Every alignment of every pair, without seeds: 80 % of a window, all of an item below 12 tokens."""
    out = {}
    for i, t, *_ in docs:
        for j, s, *_ in items:
            a, b = (D.TOKEN.findall((x or "").lower()) for x in (t, s))
            w = min(window, len(b))
            need = w if w < 12 else -(-w * 4 // 5)
            for shift in range(w - len(b), len(a) - w + 1) if w and None not in (i, j) else ():
                low, high = max(0, -shift), min(len(b), len(a) - shift)
                for at in range(low, high - w + 1):
                    n = sum(a[at + k + shift] == b[at + k] for k in range(w))
                    if n >= need:
                        out[i, j] = max(out.get((i, j), 0), n)
    return out


def test_matches_the_plain_definition(spark):
    docs, items = corpus()
    fifth = " ".join("changed" if k % 5 == 4 else w for k, w in enumerate(items[1][1].split()))
    docs = docs[:-1] + [(50, "and so " + fifth, 5, 6)]
    d, b = spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): r.overlap for r in D.contaminated(d, b).collect()}
    assert got == plain(docs, items) and (50, 1) in got


def test_items_below_the_window(spark):
    words = [f"v{k}" for k in range(15)]
    items = [(n, " ".join(words[:n]), 1) for n in (15, 14, 13, 12, 11, 5)] + [(0, "", 1)]
    change = lambda *at: " ".join("changed" if k in at else w for k, w in enumerate(words))
    docs = [(k, t, 5, 6) for k, t in enumerate([change(), "a b " + change(3, 7, 11) + " c", change(3, 7, 10, 12), change(5, 11), change(0), "v0 v1 v2 v3 v4", "v0 v1 v2 v3", "x " * 40 + change(4)])]
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): r.overlap for r in D.contaminated(d, b).collect()}
    assert got == plain(docs, items) and {(0, 15), (1, 15), (0, 5), (5, 5)} <= set(got)


def test_seeds_find_every_overlap():
    assert all("0" in seed for seed in D.SEEDS)
    for n, changed in ((16, 3), (15, 3), (14, 2), (13, 2), (12, 2)):
        assert D.seeds_for(n, changed)
    with np.testing.assert_raises(ValueError):
        D.seeds_for(20, 12)


def test_patterns_ignore_their_gaps():
    a = np.arange(1, 8, dtype=np.uint64) * np.uint64(77777)
    for seed in D.SEEDS:
        b = a.copy()
        b[[k for k, seen in enumerate(seed) if seen == "0"]] = 1
        assert D.pattern_hashes(a, seed)[0] == D.pattern_hashes(b, seed)[0]
        b[seed.index("1")] = 1
        assert D.pattern_hashes(a, seed)[0] != D.pattern_hashes(b, seed)[0]


def test_a_word_that_half_of_the_items_hold(spark):
    rnd = random.Random(4)
    run = "a b c d e f g h i j"
    items = [(j, f"{run} " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(8)), 1) for j in range(60)] + [(99, "lone", 1)]
    docs = [(i, f"x{i} {run} y{i} " * 3, 5, 6) for i in range(30)] + [(50, "so " + items[7][1], 5, 6), (51, "lone", 5, 6)]
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    found = lambda **o: {(r.doc_id, r.item_id): r.overlap for r in D.contaminated(d, b, **o).collect()}
    assert found() == plain(docs, items)
    assert (51, 99) in found() and (51, 99) not in found(least_item=2)
