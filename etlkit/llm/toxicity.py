"""Toxicity categories by a chain of linear classifiers.

Categories are predicted in a fixed order. Each is a logistic regression on indicators of words and
of dense word beginnings, and on the probabilities of the categories before it. In training those
probabilities are out-of-fold, so a later model learns how far an earlier one can be trusted on
texts it has not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import bound_batches, materialize
from etlkit.llm.nbsvm import training_rows
from etlkit.runtime import require

WORD = re.compile(r"[^\W\d_]+")
SKETCHES = 6


# Lengths of word beginnings, and the shares of a text's words at which one counts as dense.
STEMS = (3, 4, 5, 6)
DENSE, DENSER = 200, 100


def features(text: str | None, known: Container[str] | None = None, chunk: int = 1 << 20) -> set[str]:
    """Words of a whole text, lower-cased, and word beginnings that are dense in it.

    ``ab*`` stands for a beginning of 1 in 200 words or more, ``ab**`` for two words and 1 in 100 or
    more. Invented and inflected words share a beginning where they share no whole word, and a share
    of the text means the same in a short and a very long one. ``known`` limits the beginnings that
    are counted. Texts above ``chunk`` characters are read as a stream.
    """
    text = text or ""
    found = WORD.findall(text.lower()) if len(text) <= chunk else (m.group().lower() for m in WORD.finditer(text))
    counts = Counter(found)
    total, stems = counts.total(), Counter()
    for word, n in counts.items():
        for k in STEMS:
            if len(word) >= k and (known is None or word[:k] in known):
                stems[word[:k]] += n
    out = set(counts)
    out.update(f"{s}*" for s, n in stems.items() if n * DENSE >= total)
    out.update(f"{s}**" for s, n in stems.items() if n > 1 and n * DENSER >= total)
    return out


@dataclass(frozen=True)
class Link:
    """One category: its features with their weights, the weights of earlier probabilities, the bias."""

    category: str
    weights: Mapping[str, float]
    earlier: tuple[float, ...]
    bias: float


@dataclass(frozen=True)
class Chain:
    links: tuple[Link, ...]

    def probabilities(self, words: set[str]) -> list[float]:
        out: list[float] = []
        for link in self.links:
            hit = words & link.weights.keys()
            z = link.bias + sum(link.weights[w] for w in sorted(hit)) + sum(a * p for a, p in zip(link.earlier, out))
            out.append(float(1 / (1 + np.exp(-max(-30.0, min(30.0, z))))))
        return out


class Rows:
    """Feature sets of training rows as sorted arrays of numbers: a few bytes a feature."""

    def __init__(self, sets: Iterable[Iterable[str]]) -> None:
        number: dict[str, int] = {}
        self.items = [np.array(sorted({number.setdefault(w, len(number)) for w in words}), dtype=np.int32) for words in sets]
        self.names = list(number)

    def __len__(self) -> int:
        return len(self.items)

    def counts(self, pick: np.ndarray) -> np.ndarray:
        """How many of the picked rows have each feature."""
        some = [self.items[i] for i in pick]
        return np.bincount(np.concatenate(some), minlength=len(self.names)) if some and self.names else np.zeros(len(self.names), dtype=np.int64)

    def matrix(self, features: np.ndarray) -> np.ndarray:
        """Indicators of the given features, one column each."""
        column = np.full(len(self.names), -1, dtype=np.int64)
        column[features] = np.arange(len(features))
        x = np.zeros((len(self), len(features)))
        for i, row in enumerate(self.items):
            at = column[row]
            x[i, at[at >= 0]] = 1
        return x


def _signals(rows: Rows, y: np.ndarray, pick: np.ndarray, most: int, least_rows: int) -> np.ndarray:
    """Features whose log-odds between the classes differ from 0 by more than chance among as many features."""
    with_, without = pick[y[pick] > 0], pick[y[pick] == 0]
    a, b = rows.counts(with_), rows.counts(without)
    n1, n0 = max(1, len(with_)), max(1, len(without))
    tested = np.flatnonzero(a + b >= least_rows)
    a, b = a[tested], b[tested]
    odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
    z = np.abs(odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5) + 1 / (n1 - a + 0.5) + 1 / (n0 - b + 0.5)))
    # The largest of as many independent standard normal deviates seldom exceeds this.
    kept = np.flatnonzero(z >= np.sqrt(2 * np.log(max(2, len(tested)))))
    return tested[sorted(kept, key=lambda k: (-z[k], rows.names[tested[k]]))[:most]] if len(kept) else np.empty(0, dtype=np.int64)


def _regress(x: np.ndarray, y: np.ndarray, words: int, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the bias.

    The first ``words`` columns are held lightly, as a rare word may decide alone; earlier
    probabilities are held ten times as hard.
    """
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], 10 * ridge)
    keep[:words], keep[-1] = ridge, 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-3:
            break
    return w


def fit_chain(
    rows: Rows, targets: Mapping[str, np.ndarray], folds: int = 5, most_words: int = 256, least_rows: int = 5, seed: int = 3,
) -> Chain:
    """Fit the categories of ``targets`` in their order, passing out-of-fold probabilities along."""
    n, fold = len(rows), np.random.default_rng(seed).integers(0, folds, len(rows))
    passed, links = np.zeros((n, 0)), []
    for category, target in targets.items():
        y = np.asarray(target, dtype=float)
        if n == 0 or y.min() == y.max():
            # Nothing to tell apart: the base rate, kept off 0 and 1; without any row, next to 0.
            rate = (y.sum() + 0.5) / (n + 1) if n else 1e-6
            links.append(Link(category, {}, (0.0,) * passed.shape[1], float(np.log(rate / (1 - rate)))))
            passed = np.column_stack([passed, np.full(n, rate)])
            continue
        held = np.zeros(n)
        for k in [*range(folds), None]:
            inside = np.flatnonzero(fold != k) if k is not None else np.arange(n)
            used = _signals(rows, y, inside, most_words, least_rows)
            x = np.column_stack([rows.matrix(used), passed, np.ones(n)])
            w = _regress(x[inside], y[inside], len(used))
            if k is not None:
                outside = fold == k
                held[outside] = 1 / (1 + np.exp(-np.clip(x[outside] @ w, -30, 30)))
        weights = dict(zip((rows.names[j] for j in used), w[: len(used)].tolist()))
        links.append(Link(category, weights, tuple(w[len(used) : -1].tolist()), float(w[-1])))
        passed = np.column_stack([passed, held])
    return Chain(tuple(links))


def _sketch(text: str) -> list[int]:
    """Smallest hashes of a text's 3-word shingles, one for each of a few seeds."""
    tokens = WORD.findall(text.lower())
    shingles = {" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))}
    return [min(xxhash.xxh64_intdigest(s, seed=k) for s in shingles) >> 1 for k in range(SKETCHES)]


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str, categories: Mapping[str, Sequence[str]], final: str = "toxic",
    usable: Column | None = None, doc_id: str = "doc_id", text: str = "text", rows: int = 6_000, longest: int = 200_000,
) -> Chain:
    """A chain over ``categories`` and then ``final``, from at most ``rows`` labelled texts.

    ``label`` marks toxic rows. A category's own label is weak: a toxic row that holds one of the
    category's seed words. Training leaves out texts above ``longest`` characters and near copies of
    a text it already has (a common smallest hash of 3-word shingles), so that a large group of
    copies does not teach its own words. Both bounds hold for training only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(2)]
            found = [features(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sorted(w) for w in found], pa.list_(pa.string())),
                 pa.array([_sketch(t) for t in texts], pa.list_(pa.int64()))],
                names=["doc_id", "label", "words", "sketch"])

    chosen = training_rows(docs, labels, label, usable if usable is not None else F.lit(True), doc_id, text, rows)
    chosen = chosen.filter(F.coalesce(F.char_length("text"), F.lit(0)) <= longest)
    kind = docs.schema[doc_id].dataType.simpleString()
    made = chosen.mapInArrow(run, f"doc_id {kind}, label int, words array<string>, sketch array<long>")
    made = materialize(made, "toxic-rows")
    kept, seen = [], set()
    for row in sorted(made.select("doc_id", "label", "sketch").collect(), key=lambda r: (r.doc_id, r.label)):
        slots = set(enumerate(row.sketch))
        if not slots & seen:
            kept.append((row.doc_id, row.label))
        seen |= slots
    place, sets = {k: i for i, k in enumerate(kept)}, [()] * len(kept)
    number: dict[str, str] = {}
    for row in made.select("doc_id", "label", "words").toLocalIterator():
        if (row.doc_id, row.label) in place:
            sets[place[row.doc_id, row.label]] = tuple(number.setdefault(w, w) for w in row.words)
    toxic = np.array([label > 0 for _, label in kept], dtype=bool)
    targets = {c: toxic & np.array([not set(seeds).isdisjoint(w) for w in sets], dtype=bool) for c, seeds in categories.items()}
    return fit_chain(Rows(sets), targets | {final: toxic})


def scored(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Every column of ``docs`` with ``p_<category>`` for each category and ``rejected``.

    ``rejected`` is true when the last category's probability reaches ``threshold``. Whole texts are
    read; null and empty texts have the base rate. A column of ``docs`` that has the name of an added
    one is replaced. Rows, whatever their ids, are neither dropped nor merged.
    """
    require(docs, text)
    bound_batches(docs.sparkSession)
    names = [f"p_{link.category}" for link in chain.links]
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most 256 words a category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        known = {w.rstrip("*") for link in chain.links for w in link.weights if w.endswith("*")}
        for batch in batches:
            made = [chain.probabilities(features(t.as_py(), known)) for t in batch.column(body)]
            new = {name: pa.array([m[k] for m in made], pa.float64()) for k, name in enumerate(names)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])

    kept = docs.drop(*names, "rejected")
    body = next(c for c in kept.columns if c.lower() == text.lower())
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), *(f"`{n}` double" for n in names)])
    return kept.mapInArrow(run, schema).withColumn("rejected", F.col(names[-1]) >= threshold)
