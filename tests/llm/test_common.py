import contextlib
import random

import pyarrow as pa
import pytest

from etlkit.llm import common, decontam, near_texts, toxicity
from etlkit.llm.common import components


def test_components_of_chain_star_and_noise(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(300, 300), (None, 5), (400, 401), (401, 400)]
    edges += [(1000 + rnd.randrange(30), 1000 + rnd.randrange(30)) for _ in range(25)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in parent}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


@pytest.mark.parametrize("held", [40, 1_000_000])
def test_rounds_begin_with_forests(spark, monkeypatch, held):
    """A group in which all are linked goes into the rounds as a tree, and no round makes two rows of an edge."""
    kept, plans, real = {}, [], common.materialize

    def noted(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        out = real(df, label)
        kept.setdefault(label, out.count())
        return out

    monkeypatch.setattr(common, "materialize", noted)
    monkeypatch.setattr(common, "FOREST_EDGES", held)
    edges = [(i, j) for i in range(40) for j in range(i)] + [(i, i + 1) for i in range(100, 160)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").coalesce(1), "a", "b").collect()}
    assert got == {i: 0 for i in range(40)} | {i: 100 for i in range(100, 161)}
    assert not [p for p in plans if "Generate" in p]
    assert kept["edges"] <= 39 + 60 or held == 40


@pytest.mark.parametrize("call", [
    lambda d: toxicity.scored(d, toxicity.Chain((toxicity.Link("toxic", {}, (), 0.0),))),
    near_texts.near_text_groups,
    lambda d: decontam.contaminated(d, d.selectExpr("doc_id AS item_id", "text")),
])
def test_texts_go_to_python_in_bounded_batches(spark, call, monkeypatch):
    class Planned(Exception):
        pass

    def planned(*_):
        raise Planned

    for module in (near_texts, decontam):
        monkeypatch.setattr(module, "materialize", planned)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(64).selectExpr("id AS doc_id", "repeat(id || ' word ', 30000) AS text").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["n_bytes", "n"])

    spark.conf.unset(name)
    try:
        with contextlib.suppress(Planned):
            call(docs)
        seen = docs.mapInArrow(sizes, "n_bytes long, n long").collect()
        assert sum(r.n for r in seen) == 64 and max(r.n_bytes for r in seen) < common.BATCH_BYTES + 300_000
        spark.conf.set(name, "1m")
        common.bound_batches(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)
