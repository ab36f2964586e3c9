import hashlib
import random
from collections import defaultdict
from itertools import groupby
from math import floor

import pytest
from pyspark.sql import functions as F

from etlkit.llm import mixing

W = {"domain": {"a": 5, "b": 1, "c": 2}, "lang": {"en": 3, "fr": 1, "": 1}, "source": {"s0": 1, "s1": 2, "s2": 0, "s3": 4}}


def weight(level, column):
    return F.coalesce(F.expr(f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in W[level].items()) + " END"), F.lit(1))


def fill(children, budget):
    """Shares of (room, weight) children, found by filling the fullest again and again."""
    open_, given = {k for k, (room, w) in children.items() if room > 0 and w > 0}, dict.fromkeys(children, 0)
    left = budget
    while open_:
        total = sum(children[k][1] for k in open_)
        full = [k for k in open_ if children[k][0] <= left / total * children[k][1]]
        if not full:
            return given | {k: floor(left / total * children[k][1] + 1e-6) for k in open_}
        for k in full:
            given[k] = children[k][0]
        left -= sum(children[k][0] for k in full)
        open_ -= set(full)
    return given


def brute(rows, share, epochs, seed):
    leaf = defaultdict(list)
    for i, t, d, l, s in rows:
        key = hashlib.md5((t or "").encode()).hexdigest() if i is None else str(i)
        leaf[d or "", l or "", s or ""].append((key, len((t or "").split()), i))
    tokens = {k: sum(n for _, n, _ in v) for k, v in leaf.items()}
    w = lambda level, name: W[level].get(name, 1)
    room = {k: n * epochs if min(w("domain", k[0]), w("lang", k[1]), w("source", k[2])) > 0 else 0 for k, n in tokens.items()}
    given = {(): floor(sum(tokens.values()) * share)}
    for depth, level in enumerate(("domain", "lang", "source")):
        new = {}
        for parent, b in given.items():
            kids = {k[: depth + 1] for k in room if k[:depth] == parent}
            new |= fill({c: (sum(r for k, r in room.items() if k[: depth + 1] == c), w(level, c[-1])) for c in kids}, b)
        given = new
    out = []
    for k, docs in leaf.items():
        full, rest = divmod(given[k], tokens[k]) if tokens[k] else (0, 0)
        place = lambda x: (int(hashlib.md5(f"{seed}:{full}:{x[0]}".encode()).hexdigest()[:15], 16), x[0], x[1])  # noqa: E731,B023
        past = 0
        for _, same in groupby(sorted(docs, key=place), key=place):
            same = list(same)
            past += sum(n for _, n, _ in same)
            out += [(str(i), *k, n, (full + (past <= rest)) if n else 0) for _, n, i in same]
    return sorted(out)


def corpus(n=600):
    rnd, rows = random.Random(4), []
    for i in range(n):
        d, l = rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice(["en", "en", "fr", None])
        rows.append((i, "w " * rnd.choice([0, 1, 5, 30, 200]), d, l, rnd.choice(["s0", "s0", "s0", "s1", "s2", "s3", None])))
    return rows + [(None, "no id here", "a", "en", "s0"), (7, "twice twice", "a", "en", "s0"), (7, "twice twice", "a", "en", "s0"), (n, None, "b", "fr", "s1")]


@pytest.mark.parametrize(("share", "epochs"), [(1.0, 4), (0.3, 1), (3.5, 3), (0.0, 2), (50.0, 2)])
def test_matches_brute_force(spark, share, epochs):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, domain string, lang string, source string, copies int").repartition(3)
    weights = {k: weight(k, k) for k in W}
    out = mixing.mixed(docs, F.col("domain"), F.col("lang"), F.col("source"), weights, share=share, epochs=epochs, seed=1)
    got = sorted((str(r.doc_id), r["__domain"], r["__lang"], r["__source"], r.n_tokens, r.copies) for r in out.collect())
    assert got == brute(rows, share, epochs, 1)
    assert out.columns == ["doc_id", "text", "domain", "lang", "source", "__domain", "__lang", "__source", "n_tokens", "copies"]


@pytest.mark.parametrize("rows", [[(5, "w " * 10)] * 1_000, [(None, f"{k % 3} " * 10) for k in range(1_000)], [(None, f"t{k} " * 10) for k in range(1_000)], [(k, None) for k in range(9)]])
def test_a_budget_is_not_passed_on_ties(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", "x") for i, t in rows], "doc_id long, text string, lang string, source string, __domain string").repartition(4)
    out = mixing.mixed(docs, F.lit("d"), F.col("lang"), F.col("source"), {k: F.lit(1) for k in W}, share=0.35)
    total = sum(len((t or "").split()) for _, t in rows)
    given = out.agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0]
    assert given <= 0.35 * total and out.count() == len(rows)
    # Texts told apart fill the budget up to one text.
    assert given > 0.35 * total - 11 or len(set(rows)) < 9 or not total


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    out = mixing.mixed(docs, F.lit("d"), F.col("lang"), F.col("source"), {k: F.lit(1) for k in W})
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
