import random

import pytest

from etlkit.llm import tokens

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")


def texts():
    rnd = random.Random(1)
    parts = ["the", " ", "  ", "\n", "\n\n", "\t", "é", "ﬁ", "　", "▁", "<s>", "</s>", "x" * 70, "中文字", "🙂", "a", ".", "\r\n", "0x1F", " ", "\x00"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    return ["", " ", "   ", "\n", " \n ", "a b  c", "word " * 5000, "z" * 20_000, *made]


def test_counts_equal_the_library(spark, table):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(i, t, 0, 0) for i, t in enumerate([*texts(), *(r.text for r in table("documents").select("text").collect())])]
    rows += [(10**6, None, 0, 0), (None, "no id", 0, 0), (0, "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_bytes int").repartition(4)
    got = sorted(((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(docs).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        n = len(sp.encode(t or ""))
        want.append((i is None, i, len((t or "").encode()), n, n > 4096))
    assert got == sorted(want, key=str)


def test_long_texts_and_small_caches_change_nothing(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = " ".join(f"word{i % 5000} \n" for i in range(120_000))
    assert len(text) > 1 << 20
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert tokens.token_counts(docs, room=50).first().n_tokens == len(sp.encode(text))


def test_empty_table(spark):
    assert tokens.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
