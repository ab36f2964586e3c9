import html
import re

import numpy as np
import pytest

from etlkit.llm import html_blocks as H


def expected(page):
    """Text of the one article of a test page, taken by pattern."""
    inner = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", page, re.S).group(1))
    parts = (" ".join(html.unescape(p).split()) for p in re.split(r"</?(?:p|h1|br)[^>]*>", inner))
    return " ".join(p for p in parts if p)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return H.fit_pages(pages)


def test_every_page_of_the_table(pages, model):
    got = {r.page_id: r for r in H.extracted(pages, model).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == expected(r.html)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_other_builds(model):
    rng, wrong, n = np.random.default_rng(77), 0, 0
    texts = ["The river ran high that spring, and the mill stood idle.", "Nobody saw the ferry leave.", "Later the council met again to vote on the bridge, as it had before."]
    for _ in range(150):
        page, _ = H._wrapped(texts, rng)
        blocks = H.blocks_of(page)
        p = H.probabilities(model, [H.Encoder().page(blocks)])[0]
        wrong += int(((p >= 0.5) != np.array([H._block_label(b) for b in blocks])).sum())
        n += len(blocks)
    assert wrong / n < 0.01


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    h = 3
    parts = [rng.normal(size=s) * 0.3 for s in ((2, H.INPUTS, 4 * h), (2, h, 4 * h), (2, 4 * h), (2 * h,), (1,))]
    x, mask = H._padded([rng.normal(size=(4, H.INPUTS)), rng.normal(size=(2, H.INPUTS))])
    x, y = x.astype(float), (rng.random(mask.shape) < 0.5) * mask

    def loss(parts):
        z = H._run(H.Labeller(*parts), x, mask)[0]
        p = 1 / (1 + np.exp(-z))
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    for k, g in enumerate(H._gradients(H.Labeller(*parts), x, mask, y)):
        flat = parts[k].reshape(-1)
        for i in rng.integers(0, flat.size, 6):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss(parts)
            flat[i] = old - 1e-5
            down = loss(parts)
            flat[i] = old
            assert abs((up - down) / 2e-5 - g.reshape(-1)[i]) < 1e-5


def test_padding_changes_nothing(model):
    rng = np.random.default_rng(1)
    pages = [rng.normal(size=(n, H.INPUTS)).astype(np.float32) for n in (1, 7, 30)] + [np.zeros((0, H.INPUTS), np.float32)]
    together = H.probabilities(model, pages)
    for k, p in enumerate(pages):
        assert np.allclose(together[k], H.probabilities(model, [p])[0], atol=1e-5)


def test_blocks_of_broken_markup():
    page = "<p>One &amp; two<p>three<br>four <b>bo</b>ld</b></div><ul><li>a<li>b</ul><script>var x='</p>';</script><!-- <p>no</p> --><style>p{}</style>5 < 6"
    assert [b.text for b in H.blocks_of(page)] == ["One & two", "three", "four bold", "a", "b", "5 < 6"]
    assert H.blocks_of(None) == H.blocks_of("") == H.blocks_of("<p>  </p><!-- open") == []
    assert [b.text for b in H.blocks_of("a<script>never closed")] == ["a"]
    assert [b.text for b in H.blocks_of("<p title='a>b'>x&nbsp;\n y&#233;</p>")] == ["x yé"]


def test_edge_cases(spark, model):
    rows = [(1, None, "u", "t"), (1, "", None, "t"), (None, "<article><p>Only this text stands here.</p></article>", "u", "t"), (2, "<p>w</p>" * 30_000, "u", "t")]
    got = H.extracted(spark.createDataFrame(rows, "page_id long, html string, url string, text string"), model).collect()
    assert len(got) == 4 and [r.text for r in got[:2]] == ["", ""] and got[2].text == "Only this text stands here."
    empty = spark.createDataFrame([], "page_id long, html string, url string")
    assert H.extracted(empty, H.fit_pages(empty, rows=2, variants=2)).count() == 0


@pytest.mark.parametrize("unit", ["<a ", "<", "<!", "<a \"", "<a '\"", "<div>x", "<p title=\">\">y", "<script", "</", "<a b='", "&lt;<b>"])
def test_broken_markup_takes_linear_time(unit):
    import time

    start = time.process_time()
    H.blocks_of(unit * 200_000)
    assert time.process_time() - start < 12


def test_unclosed_tags_and_quotes():
    texts = lambda page: [b.text for b in H.blocks_of(page)]
    assert texts("a <b and <c") == ["a <b and <c"]
    assert texts("<p class=\"x>one</p><p>two</p>") == ["one", "two"]
    assert texts("<p a='>' b=\">\">one</p>") == ["one"]
    assert texts("1 < 2 <i>x</i> <! y") == ["1 < 2 x <! y"]


def test_the_last_words_of_a_block_tell():
    start = "the same opening words stand here before all of what tells these apart " * 5
    one, two = (H.Encoder().page([H.Block(start + last, (("p",),), 0)]) for last in ("subscribe now", "river ran high"))
    assert len(start + "subscribe now") != len(start + "river ran high") or not np.array_equal(one, two)
    assert not np.array_equal(one[:, H.PATH_SLOTS : -H.MEASURES], two[:, H.PATH_SLOTS : -H.MEASURES])


def test_late_words_can_be_learned():
    rng = np.random.default_rng(3)
    filler = [f"w{k}" for k in range(300)]
    pages, labels = [], []
    for _ in range(120):
        blocks, y = [], []
        for _ in range(6):
            main = rng.random() < 0.5
            words = list(rng.choice(filler, 40)) + (["chapter", "narrative", "story"] if main else ["subscribe", "newsletter", "cookie"])
            blocks.append(H.Block(" ".join(words), (("div",),), 0)), y.append(float(main))
        pages.append(H.Encoder().page(blocks)), labels.append(np.array(y))
    model = H.fit(pages[:90], labels[:90], epochs=40)
    right = sum(int(((p >= 0.5) == y).sum()) for p, y in zip(H.probabilities(model, pages[90:]), labels[90:]))
    assert right / (30 * 6) > 0.8
