import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from etlkit.llm import nbsvm, toxicity

BAD = ["idiot", "scum", "trash", "moron"]
SEEDS = {"insult": ("idiot", "moron"), "contempt": ("scum", "trash")}


def prose(rnd, n):
    return [rnd.choice("the of and to in alder birch cedar elm fir oak pine yew ash".split()) + rnd.choice(["", "s", "en"]) for _ in range(n)]


def toxic_corpus(n=400, seed=1):
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        words = prose(rnd, rnd.randrange(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                words.insert(rnd.randrange(len(words)), rnd.choice(BAD).upper() if i % 10 else "grob" + rnd.choice(["ian", "heit", "er", "es"]))
        docs.append((i, " ".join(words), "en", 1.5))
        labels.append((i, int(toxic)))
    return docs, labels


def test_indicators_do_not_depend_on_chunks():
    text = "Some TEXT with ümlauts and %%% signs " * 50
    assert np.array_equal(nbsvm.indicators(text), nbsvm.indicators(text, chunk=64))
    assert len(nbsvm.indicators("")) == len(nbsvm.indicators(None)) == 0


def test_dual_coordinate_descent_separates():
    rows = [np.array([0, 1]), np.array([0]), np.array([2]), np.array([2, 3])]
    w, b = nbsvm.dual_coordinate_descent(rows, [np.ones(len(r)) for r in rows], np.array([1.0, 1, -1, -1]), 4, np.full(4, 10.0), 200, 0)
    margins = [y * (w[r].sum() + b) for r, y in zip(rows, (1, 1, -1, -1))]
    assert min(margins) >= 0.99


def test_quality_is_learnt_and_held_out(spark, table):
    remainder = lambda c: F.crc32(F.col(c).cast("string")) % 3
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = nbsvm.fit_quality(docs, labels, "quality", remainder("__id") != 1)
    got = {r.doc_id: r for r in nbsvm.scored(docs, model).collect()}
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(p == q for p, q in held) / len(held) >= 0.93
    # Labels of held-out rows change nothing.
    flipped = labels.withColumn("quality", F.when(remainder("doc_id") == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = nbsvm.fit_quality(docs, flipped, "quality", remainder("__id") != 1)
    assert np.array_equal(model.weights, again.weights) and model.slope == again.slope


def test_quality_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = nbsvm.fit_quality(empty, none, "quality", F.lit(True))
    assert nbsvm.scored(empty, model).count() == 0
    odd = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "x" * 300_000, 5)], "doc_id long, text string, score int")
    rows = nbsvm.scored(odd, model).collect()
    assert [r.score for r in rows] == [0.5] * 3 and len(rows) == 3
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert nbsvm.scored(odd, nbsvm.fit_quality(odd, one, "quality", F.lit(True))).first().predicted == 1


def test_toxicity_chain(spark):
    docs, labels = toxic_corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, p_insult double")
    labelled = spark.createDataFrame(labels[:250], "doc_id long, toxic int")
    chain = toxicity.fit_toxicity(d, labelled, "toxic", SEEDS)
    assert [link.category for link in chain.links] == ["insult", "contempt", "toxic"]
    assert [len(link.earlier) for link in chain.links] == [0, 1, 2]
    got = {r.doc_id: r for r in toxicity.scored(d, chain).collect()}
    held = [(got[i].rejected, bool(t)) for i, t in labels[250:]]
    assert sum(a == b for a, b in held) / len(held) >= 0.93
    assert not any(a for a, b in held if not b)
    assert toxicity.scored(d, chain).columns == ["doc_id", "text", "lang", "p_insult", "p_contempt", "p_toxic", "rejected"]


def test_earlier_probabilities_are_out_of_fold():
    # The first category is noise that only a rote learner could know; a later copy of it must not trust it.
    rnd = np.random.default_rng(0)
    rows = [{f"w{i}", f"x{rnd.integers(5)}"} for i in range(200)]
    noise = rnd.random(200) < 0.5
    chain = toxicity.fit_chain(toxicity.Rows(rows), {"a": noise, "b": noise}, least_rows=1)
    assert abs(chain.links[1].earlier[0]) < 3


def test_features_in_short_and_long_texts():
    assert toxicity.features(None) == set()
    assert {"ab", "abcd", "abc*", "abcd*"} <= toxicity.features("Ab ABCD")
    text = "grobian groberes " + "the " * 150
    assert {"gro*", "gro**"} <= toxicity.features(text)
    assert "gro*" not in toxicity.features(text + "of " * 5000)
    assert toxicity.features(text * 4) == toxicity.features(text * 4, chunk=10)


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "idiot", 1), (2, "a " * 200_000, 1)], "doc_id long, text string, rejected int")
    chain = toxicity.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"), "toxic", SEEDS)
    out = toxicity.scored(docs, chain)
    assert out.count() == 4 and not any(r.rejected for r in out.collect())
    empty = docs.filter("doc_id = 99")
    assert toxicity.scored(empty, chain).count() == 0
