"""Main-text extraction by a recurrent block labeller.

A page is cut in leaf blocks, the runs of text between block-level tags. Each block is a vector of
its hashed tag path (tags, class and id words), its hashed words and a few measures. A bidirectional
LSTM in numpy reads all blocks of a page in both directions and labels every block, so each decision
sees the whole document. It is trained on blocks whose place in the markup tells what they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import require

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
# What may follow in a tag, up to its end or a quote.
WITHIN = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
# Elements whose content is no text, elements without content, and elements inside a line.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video select textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
# A start tag of the first ends an open element of the second, as browsers do.
CLOSES = {"li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
P_ENDERS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

# Places that tell what a block is, for training only.
MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset("nav header footer aside form button dialog menu".split())
OTHER_WORDS = frozenset(
    "nav menu navbar breadcrumb breadcrumbs header footer sidebar side widget related ad ads advert advertisement banner promo sponsored "
    "cookie cookies consent notice notices alert popup modal newsletter subscribe share social comment comments reply replies "
    "disqus login search form pagination tags copyright legal toolbar".split())

PATH_SLOTS, WORD_SLOTS, MEASURES = 96, 48, 6
# Elements nested deeper count as content of the last one, as in browsers.
DEEPEST = 512
INPUTS = PATH_SLOTS + WORD_SLOTS + MEASURES


@dataclass(frozen=True)
class Block:
    """Text of one block; its path from the root, each step a tag with its class and id words; text inside links."""

    text: str
    path: tuple[tuple[str, ...], ...]
    linked: int


def _steps(tag: str, attributes: str) -> tuple[str, ...]:
    words = [tag]
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role", "itemprop"):
                words.extend(re.split(r"[^a-z0-9]+", unescape(value.strip("\"'")).lower()))
            elif name in ("hidden",) or "true" in value.lower() or re.search(r"display\s*:\s*none", value, re.I):
                words.append("hidden")
    return tuple(w for w in words if w)


class _Scanner:
    """Tags and texts of a page, in one pass.

    Whatever is not closed is known after one search to the end of the page: places of the next ``>``, and kinds of
    quotes that come no more, are remembered.
    """

    def __init__(self, page: str) -> None:
        self.page, self.end = page, len(page)
        self.after = -1  # the first ``>`` at or after the last place asked for, or the end
        self.unclosed: dict[str, int] = {}

    def _next_end(self, at: int) -> int:
        if self.after < at:
            found = self.page.find(">", at)
            self.after = self.end if found < 0 else found
        return self.after

    def _tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, quoted ones passed over; a quote without an end is a character like others."""
        first = self._next_end(at)
        if first == self.end:
            return -1
        begin = at
        while True:
            at = WITHIN.match(self.page, at).end()
            if at >= self.end:
                # All that follow stand in quotes: the tag ends at the first of them.
                return self._next_end(begin)
            mark = self.page[at]
            if mark == ">":
                return at
            closed = -1 if self.unclosed.get(mark, self.end) <= at else self.page.find(mark, at + 1)
            if closed < 0:
                self.unclosed[mark] = min(at, self.unclosed.get(mark, at))
            at = max(closed, at) + 1

    def __call__(self, at: int) -> tuple[int, str | None, bool, str, str]:
        """The part at a place: its end, its text (None for markup), whether an end tag, its name (empty: none), its attributes."""
        page = self.page
        if page[at] != "<":
            to = page.find("<", at)
            to = self.end if to < 0 else to
            return to, page[at:to], False, "", ""
        if page.startswith("<!--", at):
            to = page.find("-->", at + 4)
            return (self.end if to < 0 else to + 3), None, False, "", ""
        if page.startswith(("<!", "<?"), at):
            to = self._next_end(at)
            return (at + 1, "<", False, "", "") if to == self.end else (to + 1, None, False, "", "")
        tag = TAG.match(page, at) if self._next_end(at) < self.end else None
        to = self._tag_end(tag.end()) if tag else -1
        if to < 0:
            return at + 1, "<", False, "", ""
        return to + 1, None, bool(tag.group(1)), tag.group(2), page[tag.end() : to]


def blocks_of(page: str | None) -> list[Block]:
    """Blocks of a page in order. Broken markup is read as browsers do; a missing page has none.

    Scripts, styles, titles and other silent elements, comments and declarations hold no text.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, at, end = 0, 0, len(page)
    scan, paths = _Scanner(page), []

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            # The path is made anew only when the open elements have changed.
            if not paths:
                paths.append(tuple(step for tag, step in stack if tag not in INLINE))
            out.append(Block(text, paths[0], min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(tags: Sequence[str], scope: frozenset[str] = frozenset()) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in tags:
                del stack[k:]
                paths.clear()
                return
            if stack[k][0] in scope:
                return

    while at < end:
        at, raw, slash, tag, attributes = scan(at)
        if raw is not None:
            text = unescape(raw) if raw != "<" else raw
            parts.append(text)
            if any(t == "a" for t, _ in stack[-4:]):
                linked += len(text.strip())
        if not tag:
            continue
        tag = tag.lower()
        if not slash and tag in SILENT:
            if tag not in ("iframe", "object") or not attributes.rstrip().endswith("/"):
                done = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = done.end() if done else end
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if slash:
            if tag in INLINE:
                close((tag,), scope=P_ENDERS | {"li", "td"})
            else:
                close((tag,))
            continue
        if tag in P_ENDERS:
            close(("p",), scope=frozenset(("div", "article", "section", "td", "li", "main", "body")))
        if tag in CLOSES:
            close(CLOSES[tag], scope=frozenset(("ul", "ol", "table", "dl", "select", "div", "article", "section", "body")))
        if not attributes.rstrip().endswith("/") and len(stack) < DEEPEST:
            stack.append((tag, _steps(tag, attributes)))
            paths.clear()
    flush()
    return out


def _slot(kind: str, word: str, slots: int) -> tuple[int, float]:
    h = crc32(f"{kind}:{word}".encode("utf-8", "surrogatepass"))
    return h % slots, 1.0 if h >> 16 & 1 else -1.0


class Encoder:
    """Vectors of blocks. Slots of paths and words are remembered, as pages share most of them."""

    def __init__(self) -> None:
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, tuple[int, float]] = {}

    def path(self, path: tuple[tuple[str, ...], ...]) -> np.ndarray:
        v = self.paths.get(path)
        if v is None:
            v = np.zeros(PATH_SLOTS, dtype=np.float32)
            for word in {w for step in path for w in step}:
                k, sign = _slot("path", word, PATH_SLOTS)
                v[k] += sign
            if path:
                for word in path[-1]:
                    k, sign = _slot("leaf", word, PATH_SLOTS)
                    v[k] += 0.5 * sign
            if len(self.paths) < 20_000:
                self.paths[path] = v
        return v

    def word(self, word: str) -> tuple[int, float]:
        found = self.words.get(word)
        if found is None:
            found = _slot("word", word.lower(), WORD_SLOTS)
            if len(self.words) < 100_000:
                self.words[word] = found
        return found

    def page(self, blocks: Sequence[Block]) -> np.ndarray:
        x = np.zeros((len(blocks), INPUTS), dtype=np.float32)
        rows: list[int] = []
        slots: list[tuple[int, float]] = []
        for i, b in enumerate(blocks):
            # Every word once, all of a block together as strong as sixteen words: long blocks are like short ones.
            found = [self.word(w) for w in dict.fromkeys(b.text.split(" "))]
            share = 4 / np.sqrt(max(16, len(found)))
            rows += [i] * len(found)
            slots += [(k, sign * share) for k, sign in found]
            n = len(b.text)
            stops = b.text.count(".") + b.text.count(",")
            x[i, :PATH_SLOTS] = self.path(b.path)
            x[i, -MEASURES:] = (np.log1p(n) / 6, b.linked / n, min(1.0, 8 * stops / n), len(b.path) / 10, (i + 1) / len(blocks), 1.0)
        if slots:
            columns, signs = zip(*slots)
            np.add.at(x, (rows, np.array(columns) + PATH_SLOTS), np.array(signs, dtype=np.float32) * np.float32(0.25))
        return x


@dataclass(frozen=True)
class Labeller:
    """A bidirectional LSTM: input and state weights of both directions, and the output layer."""

    w: np.ndarray  # 2 x INPUTS x 4h
    u: np.ndarray  # 2 x h x 4h
    b: np.ndarray  # 2 x 4h
    v: np.ndarray  # 2h
    c: np.ndarray  # 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(model: Labeller, x: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """Logits of a padded batch ``(pages, blocks, INPUTS)``; with ``keep`` also what training needs."""
    n, steps, _ = x.shape
    h_size, hs, kept = model.u.shape[1], [], []
    for d in (0, 1):
        z_all = x @ model.w[d] + model.b[d]
        h, c = np.zeros((n, h_size), x.dtype), np.zeros((n, h_size), x.dtype)
        out, saved = np.zeros((n, steps, h_size), x.dtype), []
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            z = z_all[:, t] + h @ model.u[d]
            i, f, o = _sigmoid(z[:, :h_size]), _sigmoid(z[:, h_size : 2 * h_size]), _sigmoid(z[:, 2 * h_size : 3 * h_size])
            g, m = np.tanh(z[:, 3 * h_size :]), mask[:, t, None]
            c_new = (f * c + i * g) * m  # padding leaves no state behind
            tc = np.tanh(c_new)
            h_new = o * tc * m
            if keep:
                saved.append((t, i, f, o, g, m, c, tc, h))
            h, c = h_new, c_new
            out[:, t] = h
        hs.append(out)
        kept.append(saved)
    both = np.concatenate(hs, axis=2)
    return both @ model.v + model.c[0], [both, kept]


def _gradients(model: Labeller, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    logits, (both, kept) = _run(model, x, mask, keep=True)
    d_logit = (_sigmoid(logits) - y) * mask / max(1.0, mask.sum())
    h_size = model.u.shape[1]
    gv, gc = np.einsum("nt,nth->h", d_logit, both), np.array([d_logit.sum()])
    gw, gu, gb = np.zeros_like(model.w), np.zeros_like(model.u), np.zeros_like(model.b)
    for d in (0, 1):
        d_out = d_logit[:, :, None] * model.v[d * h_size : (d + 1) * h_size]
        dh, dc = np.zeros((x.shape[0], h_size)), np.zeros((x.shape[0], h_size))
        for t, i, f, o, g, m, c_old, tc, h_old in reversed(kept[d]):
            dh = (dh + d_out[:, t]) * m
            dc = (dc + dh * o * (1 - tc * tc)) * m
            dz = np.concatenate([dc * g * i * (1 - i), dc * c_old * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            gw[d] += x[:, t].T @ dz
            gu[d] += h_old.T @ dz
            gb[d] += dz.sum(axis=0)
            dh, dc = dz @ model.u[d].T, dc * f
    return [gw, gu, gb, gv, gc]


def _padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, INPUTS), dtype=np.float32), np.zeros((len(pages), steps), dtype=np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)], mask[k, : len(p)] = p, 1
    return x, mask


def fit(pages: Sequence[np.ndarray], labels: Sequence[np.ndarray], hidden: int = 16, epochs: int = 14, batch: int = 32, rate: float = 0.02, seed: int = 4) -> Labeller:
    """Train by Adam on the mean log-loss of blocks, on whole pages."""
    rng = np.random.default_rng(seed)
    some = [(p, np.asarray(y, dtype=np.float32)) for p, y in zip(pages, labels) if len(p)]
    parts = [rng.normal(0, 0.15, (2, INPUTS, 4 * hidden)), rng.normal(0, 0.15, (2, hidden, 4 * hidden)), np.zeros((2, 4 * hidden)), rng.normal(0, 0.3, 2 * hidden), np.zeros(1)]
    parts[2][:, hidden : 2 * hidden] = 1.0
    first, second, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(epochs if some else 0):
        order = sorted(rng.permutation(len(some)), key=lambda k: len(some[k][0]) // 8)
        for at in rng.permutation(range(0, len(order), batch)):
            pick = order[at : at + batch]
            x, mask = _padded([some[k][0] for k in pick])
            y = np.zeros_like(mask)
            for row, k in enumerate(pick):
                y[row, : len(some[k][1])] = some[k][1]
            step += 1
            for k, g in enumerate(_gradients(Labeller(*parts), x, mask, y)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                parts[k] = parts[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Labeller(*[p.astype(np.float32) for p in parts])


def probabilities(model: Labeller, pages: Sequence[np.ndarray], cells: int = 4_096) -> list[np.ndarray]:
    """Probability of main text for every block. Pages of like length share a padded batch of bounded size."""
    out: list[np.ndarray] = [np.empty(0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        many = at
        while many < len(order) and (many == at or (many - at + 1) * len(pages[order[many]]) <= cells):
            many += 1
        x, mask = _padded([pages[k] for k in order[at:many]])
        p = _sigmoid(_run(model, x, mask)[0])
        for row, k in enumerate(order[at:many]):
            out[k] = p[row, : len(pages[k])]
        at = many
    return out


def place_label(block: Block) -> float | None:
    """1 in an article or main element, 0 in a place for other things, none where the markup does not tell."""
    main = False
    for step in block.path:
        if step[0] in OTHER_TAGS or "hidden" in step[1:] or not OTHER_WORDS.isdisjoint(step[1:]):
            return 0.0
        main = main or step[0] in MAIN_TAGS
    return 1.0 if main else None


def _wrapped(texts: Sequence[str], rng: np.random.Generator) -> tuple[str, list[str]]:
    """A page of another build around given texts: its markup and the texts that are its article."""
    take = lambda n: [texts[int(k)] for k in rng.integers(0, len(texts), n)]
    # Cut at a space, as menus and notices are short.
    short = lambda n: [" ".join(t.split()[: int(rng.integers(1, 9))]) or "Text" for t in take(n)]
    one = lambda *options: str(rng.choice(options))
    links = lambda n: "<ul>" + "".join(f"<li><a href='#'>{t}</a></li>" for t in short(n)) + "</ul>"
    body = take(int(rng.integers(1, 9)))
    extra = [
        f"<nav class='{one('menu', 'navbar', 'breadcrumbs')}'>{links(4)}</nav>", f"<header class='site-header'><h2>{short(1)[0]}</h2>{links(2)}</header>",
        f"<aside class='{one('sidebar', 'related', 'widget')}'><h3>{short(1)[0]}</h3><p>{take(1)[0]}</p>{links(3)}</aside>",
        f"<div class='{one('ad', 'ads', 'advert', 'banner', 'promo', 'sponsored')}'>{take(1)[0]}</div>",
        f"<div class='{one('cookie', 'consent', 'notice', 'alert', 'newsletter')}'><p>{take(1)[0]}</p><button>{short(1)[0]}</button></div>",
        f"<form class='{one('search', 'login', 'subscribe')}'><label>{short(1)[0]}</label><p>{short(1)[0]}</p><button>{short(1)[0]}</button></form>",
        f"<div class='{one('share', 'social', 'tags', 'pagination')}'>{links(3)}</div>",
    ]
    after = [f"<{one('section', 'div')} {one('class', 'id')}='comments'><h3>{short(1)[0]}</h3>" + "".join(f"<div class='{one('comment', 'reply')}'><p>{t}</p></div>" for t in take(2)) + "</" + "section>",
             f"<footer>{short(1)[0]}<p>{short(1)[0]}</p></footer>"]
    rng.shuffle(extra)
    cut = int(rng.integers(0, len(extra)))
    tags = one("<article>|</article>", "<main>|</main>", "<main><article>|</article></main>", "<div id='content' class='post entry article'>|</div>", "<article class='post'><div class='content body'>|</div></article>").split("|")
    inner = f"<h1>{short(1)[0]}</h1>" if rng.random() < 0.6 else ""
    inner += "".join(f"<{t}>{x}</{t}>" for t, x in ((one("p", "p", "p", "p", "h2", "blockquote", "li", "div"), x) for x in body))
    if rng.random() < 0.3:
        inner += extra.pop(0)
    page = "<html><body>" + "".join(extra[:cut]) + tags[0] + inner + tags[1] + "".join(extra[cut:]) + "".join(after) + "</body></html>"
    return page, body


def _block_label(block: Block) -> float:
    """Labels of the pages of ``_wrapped``, whose article may be a plain div."""
    known = place_label(block)
    if known is None:
        known = float(any("content" in step[1:] for step in block.path))
    return known


def training_set(pages: Sequence[str], variants: int, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Encoded pages with block labels: the given pages by their markup, and other builds around their texts."""
    encoder, rng = Encoder(), np.random.default_rng(seed)
    x, y, texts = [], [], []
    for page in pages:
        blocks = blocks_of(page)
        labels = [place_label(b) for b in blocks]
        texts += [b.text.replace("<", " ").replace("&", " ") for b, t in zip(blocks, labels) if t]
        if any(t is not None for t in labels):
            # Where the markup does not tell, a block counts as other.
            x.append(encoder.page(blocks)), y.append(np.array([t or 0.0 for t in labels]))
    texts = [t for t in texts if t.strip()] or ["Text of a page without any."]
    for _ in range(variants):
        blocks = blocks_of(_wrapped(texts, rng)[0])
        x.append(encoder.page(blocks)), y.append(np.array([_block_label(b) for b in blocks]))
    return x, y


def fit_pages(pages: DataFrame, page_id: str = "page_id", html: str = "html", rows: int = 160, variants: int = 360, longest: int = 100_000, seed: int = 4) -> Labeller:
    """A labeller from at most ``rows`` pages of at most ``longest`` characters, picked by a hash of the id.

    Both bounds hold for training only and bound what reaches the driver (16 MB as used, far less in
    practice). The labels come from the markup, where an element or its class tells what it holds.
    """
    require(pages, page_id, html)
    ids = pages.select(F.col(page_id).alias("__id")).filter("__id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    found = pages.select(F.col(page_id).alias("id"), F.col(html).alias("html")).filter(F.char_length(html) <= longest)
    found = found.join(F.broadcast(ids), F.col("id") == F.col("__id")).groupBy("id").agg(F.min("html").alias("html"))
    picked = sorted((r.id, r.html) for r in found.collect())
    return fit(*training_set([page for _, page in picked], variants, seed))


def extracted(pages: DataFrame, model: Labeller, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row for each row of ``pages``.

    The text joins the blocks that the labeller takes for main text, in page order, by one space;
    references are decoded and white space inside a block is one space. A null, empty or textless page
    has the empty text. Pages of any length are labelled whole; repeated rows stay; extra columns play no part.
    """
    require(pages, page_id, url, html)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                blocks = [blocks_of(v.as_py()) for v in batch.column(2)]
                found = probabilities(shared.value, [encoder.page(b) for b in blocks])
                texts = [" ".join(b.text for b, p in zip(page, ps) if p >= 0.5) for page, ps in zip(blocks, found)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema[page_id].dataType.simpleString()
    picked = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return picked.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
