"""The stages and registered queries, against brute force or their SQL."""

import pytest

import corpus_pipeline
import harness
from etlkit.llm.queries import ORACLES, QUERIES
from test_near_texts import brute as brute_groups


@pytest.fixture(scope="module")
def db(data):
    return harness.connect(data)


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, db, data, name):
    got = QUERIES[name](spark, data).toArrow()
    assert not harness.compare(got, db.sql(ORACLES[name]).to_arrow_table())
    assert got.num_rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_for_each_input_row(spark, data, name):
    rows = QUERIES[name](spark, data).count()
    source = {"op1": "pages", "op10": "embeddings", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    whole = spark.read.parquet(f"{data}/{source}.parquet").count() * (32 if name.startswith("op13") else 1)
    assert rows == whole if not name.startswith("op5") else rows >= 0


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "secrets", "mixing"]

    kept = stages["toxicity"](spark, docs, sf_dir)
    insults = "idiot|moron|stupid|clown|loser|trash|scum|worthless|pathetic|disgusting"
    assert kept.columns == columns
    hard = docs.filter(f"size(regexp_extract_all(lower(text), '{insults}', 0)) >= 6").count()
    left = kept.filter(f"size(regexp_extract_all(lower(text), '{insults}', 0)) >= 6").count()
    assert hard and left <= 0.2 * hard

    single = stages["near_dedup"](spark, docs, sf_dir)
    assert single.columns == columns
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    labels, _ = brute_groups([r.text for r in rows])
    gone = {r.doc_id for r in rows} - {r.doc_id for r in single.select("doc_id").collect()}
    later = {r.doc_id for k, r in enumerate(rows) if labels[k] != k}
    assert gone <= later and len(gone) >= 0.97 * len(later)

    clean = stages["decontamination"](spark, docs, sf_dir)
    assert clean.columns == columns and 0 < docs.count() - clean.count() < 100

    safe = stages["secrets"](spark, docs, sf_dir)
    assert safe.columns == columns and safe.count() == docs.count()
    assert safe.filter("lower(text) rlike 'token = \"[0-9a-f]{40}'").count() == 0
    assert safe.filter("contains(text, '[SECRET]')").count() > 0

    mix = stages["mixing"](spark, docs, sf_dir)
    assert mix.columns == [*columns, "n_tokens", "copies"]
    total = docs.selectExpr("sum(regexp_count(text, '[^ \\t\\n]+'))").first()[0]
    held = mix.selectExpr("sum(n_tokens * copies)").first()[0]
    assert 0.8 * total <= held <= total


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "src1", 0, 1), (1, "", "en", "src1", 0, 1), (2, "word " * 50_000, "en", "src1", 250_000, 1),
            (3, "word " * 50_000, None, "src2", 250_000, 1), (4, "a quiet text of a few words", "fr", None, 27, 1), (None, "another text", "fr", "x", 12, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, item_id int")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for frame in (docs, docs.filter("doc_id = 99")):
        at = frame
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, str(tmp_path))
            assert at.columns[: len(docs.columns)] == docs.columns
        got = [r.doc_id for r in at.collect()]
        assert got.count(3) == 0 and got.count(1) == 0
    single = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, str(tmp_path))
    assert sorted(str(r.doc_id) for r in single.collect()) == ["1", "2", "4", "None"]
