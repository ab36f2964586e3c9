import random
import re

import pytest
from pyspark.sql import functions as F

from etlkit.llm import licenses as L

SCHEMA = "doc_id long, text string, words string, at int, places int"


def brute(text, share=0.8):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    base, other, scores = [], set(), [0.0]
    for phrase, label in L.PHRASES.items():
        parts = phrase.split()
        base += [(k, label) for k in range(len(words)) if words[k : k + len(parts)] == parts]
    for t in L.TEMPLATES:
        parts = t.text.split()
        must = {at + k for key in t.keys for at in [L._key_positions(parts, [key])[0]] for k in range(len(key.split()))}
        for start in range(-len(parts), len(words)):
            same = {k for k in range(len(parts)) if 0 <= start + k < len(words) and words[start + k] == parts[k]}
            if must <= same and len(same) >= share * len(parts):
                other.add(t.label), scores.append(len(same) / len(parts))
    places = sorted(k for k, _ in base)
    labels = {label for _, label in base}
    return (len(words), len(base), places[0] if places else None, places[-1] if places else None, ",".join(sorted(labels)),
            ",".join(sorted(labels | other)), max([1.0] * bool(base) + scores))


def corpus():
    rnd = random.Random(5)
    texts = [None, "", "MIT License", "the mit\nLICENSE. Apache-License gnu/general public license; cc by cc by", "licensK mit licenseé", "license " * 2_000,
             "x " * 50_000 + "Apache License", "émit license", "by cc by-nc cc by mit.license"]
    for t in L.TEMPLATES:
        words = t.text.split()
        for n in range(6):
            changed = list(words)
            for k in rnd.sample(range(len(words)), min(n, len(words))):
                changed[k] = "Other"
            texts.append("Some words, " * n + " * ".join(changed).upper() + " and MIT license" * (n % 2))
        texts += [" ".join(words[3:]), " ".join(words[:3] + ["inserted"] + words[3:])]
    return [(i, t, "license", 1, 2) for i, t in enumerate(texts)]


def report(spark, rows, **options):
    out = L.license_report(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert out.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return out


def test_matches_brute_force(spark):
    rows = corpus()
    found = {r[0]: tuple(r)[1:] for r in report(spark, rows).collect()}
    assert found == {i: pytest.approx(brute(t)) for i, t, *_ in rows} | {}
    assert {"apache", "bsd", "isc", "mpl", "lgpl,gpl"} & {r[5] for r in found.values()} and len({r[6] for r in found.values()}) > 4


@pytest.mark.parametrize("rare", [1, 9])
def test_number_of_rare_words_changes_no_place(spark, rare):
    rows = corpus()
    assert sorted(report(spark, rows, rare=rare).collect(), key=str) == sorted(report(spark, rows).collect(), key=str)


def test_rare_words_come_from_all_rows(spark):
    rows = [(i, "license", "", 0, 0) for i in range(5)] + [(9, "mit mit", "", 0, 0), (10, None, "", 0, 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert L.document_frequencies(frame, "text", ["mit", "license", "gnu"]) == {"license": 5, "mit": 1}
    first = {f.label: f.words[f.keys[0]] for f in L.filed(L.PHRASES, (), 0.8, {"license": 5, "mit": 1})}
    assert first["mit"] == "mit" and first["gpl"] == "general"


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, "mit license", "x", 0, 0)] * 3 + [(1, None, "x", 0, 0)]
    assert sorted((str(r.doc_id), r.n_base, r.score) for r in report(spark, rows).collect()) == [("1", 0, 0.0)] + [("None", 1, 1.0)] * 3
    assert report(spark, []).count() == 0


def test_own_templates_and_no_python_in_the_plan(spark):
    mine = (L.Template("own", "you must keep this notice", ("keep this notice",)),)
    out = report(spark, [(1, "You shall keep this notice", "", 0, 0), (2, "keep that notice", "", 0, 0)], phrases={"all rights reserved": "closed"}, templates=mine)
    assert {r.doc_id: (r.labels, r.score) for r in out.collect()} == {1: ("own", 0.8), 2: ("", 0.0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "").replace("REPARTITION", "")
    with pytest.raises(ValueError):
        L.filed({}, (L.Template("bad", "a b", ("c",)),), 0.8, {})
    assert F is not None
