import random

import numpy as np
import pytest

from etlkit.llm import near_texts as N

SCHEMA = "doc_id long, text string, digest string, component int"


def brute(texts, jaccard=0.8, shingle=5):
    """Components of all pairs of texts by exact Jaccard similarity, as labels, and the pairs."""
    sets = [set(N.shingle_set(t, shingle).tolist()) for t in texts]
    labels, pairs = list(range(len(texts))), []
    order = sorted(range(len(texts)), key=lambda k: len(sets[k]))
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if len(sets[i]) < jaccard * len(sets[j]):
                break
            shared = len(sets[i] & sets[j])
            if shared >= jaccard * (len(sets[i]) + len(sets[j]) - shared) - 1e-9:
                pairs.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(labels[i], labels[j])
            if (labels[i], labels[j]) != (low, low):
                labels[i] = labels[j] = low
                changed = True
    return labels, pairs


def grouped(labels):
    out = {}
    for k, label in enumerate(labels):
        out.setdefault(label, set()).add(k)
    return {frozenset(g) for g in out.values()}


def corpus(seed=2, copies=120):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    texts = []
    base = [word() for _ in range(300)]
    for _ in range(copies):
        made = list(base)
        for _ in range(rnd.randrange(0, 9)):
            made[rnd.randrange(len(made))] = word()
        texts.append(" ".join(made))
    for _ in range(60):
        words = [word() for _ in range(rnd.randrange(1, 200))]
        texts.append(" ".join(words))
        if rnd.random() < 0.6:
            words[rnd.randrange(len(words))] = word()
            texts.append(" ".join(words).upper())
    return texts


def groups(spark, rows, **options):
    return N.near_text_groups(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()


@pytest.mark.parametrize("crowd", [8, 1_000])
def test_matches_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(N, "BLOCK_ROWS", 50)
    texts = corpus()
    found = {r.doc_id: r.component for r in groups(spark, [(i, t, "x", 1) for i, t in enumerate(texts)], crowd=crowd)}
    labels, pairs = brute(texts)
    assert grouped([found[i] for i in range(len(texts))]) == grouped(labels) and len(pairs) > 500


def test_recall_and_no_link_below_the_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = {r.doc_id: r.component for r in N.near_text_groups(docs).collect()}
    labels, pairs = brute([r.text for r in rows])
    met = sum(found[rows[i].doc_id] == found[rows[j].doc_id] for i, j in pairs)
    assert met >= 0.97 * len(pairs) and len(pairs) > 20
    # Each group found lies inside one of brute force.
    outer = {}
    for k, r in enumerate(rows):
        assert outer.setdefault(found[r.doc_id], labels[k]) == labels[k]


def test_cells_change_nothing(spark, monkeypatch):
    texts = corpus(4, 90)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    whole = {r.doc_id: r.component for r in groups(spark, rows)}
    monkeypatch.setattr(N, "CELL_ROWS", 25)
    cut = {r.doc_id: r.component for r in groups(spark, rows)}
    ids = range(len(texts))
    assert grouped([whole[i] for i in ids]) == grouped([cut[i] for i in ids])


def test_one_row_of_each_group_stays(spark):
    long = "word " * 30_000
    rows = [(1, "a b c d e f g h", "p", 1), (1, "quite another text", "q", 1), (2, "A b c d\te f g h", "r", 1), (3, None, "s", 1), (4, "", "t", 1), (None, " ", "u", 1),
            (None, "no id here", "v", 1), (None, "no id here", "v", 1), (5, "twice", "w", 1), (5, "twice", "w", 1), (5, "twice", "z", 1), (6, long, "x", 1), (7, long, "y", 1),
            (8, "a b c d e f g i", "p", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = N.distinct_texts(frame)
    assert out.columns == frame.columns
    kept = sorted(((r.doc_id or -1, (r.text or "")[:20]) for r in out.collect()))
    assert kept == [(-1, "no id here"), (1, "a b c d e f g h"), (1, "quite another text"), (3, ""), (5, "twice"), (6, long[:20]), (8, "a b c d e f g i")]
    assert N.distinct_texts(frame.filter("doc_id > 99")).count() == 0


def test_shingle_sets():
    assert len(N.shingle_set(None, 5)) == 0 == len(N.shingle_set(" \n", 5))
    assert np.array_equal(N.shingle_set("A b", 5), N.shingle_set("a\tB", 5))
    assert len(N.shingle_set("a b c d e f a b c d e", 5)) == 6


def test_sets_go_straight_to_the_comparison(spark, monkeypatch):
    """No set of shingles is written, or sent by its id, on its way to the tasks that compare it."""
    written, real = [], N.materialize
    monkeypatch.setattr(N, "materialize", lambda df, label: written.append((label, df.columns)) or real(df, label))
    rows = [(i, t, "x", 1) for i, t in enumerate(corpus(3, 40))]
    # The same row many times, and rows without id.
    rows += [(0, rows[0][1], "x", 1)] * 50 + [(None, rows[1][1], "x", 1)] * 3 + [(None, None, "x", 1), (None, "", "x", 1)]
    found = groups(spark, rows)
    labels, _ = brute([r[1] or "" for r in rows[: len(rows) - 55]])
    assert grouped([{r.doc_id: r.component for r in found}[i] for i in range(len(labels))]) == grouped(labels) and len(found) == len(rows)
    assert written and not [label for label, columns in written if "s" in columns]


def test_long_chains_are_verified_pair_by_pair(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 3)
    texts = corpus(6, 30)
    found = {r.doc_id: r.component for r in groups(spark, [(i, t, "x", 1) for i, t in enumerate(texts)], crowd=1_000)}
    assert grouped([found[i] for i in range(len(texts))]) == grouped(brute(texts)[0])


def test_rows_that_stay_are_not_shuffled(spark):
    """With nothing small enough to broadcast, only rows that go or come twice are exchanged whole."""
    rows = [(i, f"text number {i} of its own {i * 7} {i * 13} {i * 17}", "x", 1) for i in range(300)] + [(500, "twice", "x", 1)] * 2 + [(None, "gone", "x", 1), (501, "gone", "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        out = N.distinct_texts(frame)
        kept = sorted(r.doc_id for r in out.collect())
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for key in limits:
            spark.conf.unset(key)
    assert kept == [*range(300), 500, 501]
    anti = plan[plan.index("LeftAnti"):].split("Join")[0]
    assert "held(" in anti
