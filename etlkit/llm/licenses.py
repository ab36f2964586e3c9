"""Licence scans by a positional index of rare words. DataFrame functions only.

Templates are short passages of licence texts. Each is filed in an index under the words of its key
phrases that are rarest in the corpus, with their positions. Where a file holds the rarest such word,
the difference of the two positions is a place where the template may start; the template's other
rare words must ask for the same place. What is left is verified: all key phrases stand whole, and
enough of the template's words stand at their places. As key phrases are mandatory, the index loses
no place, whichever words are rare.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import require

# Runs of digits, ASCII letters of either case and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    label: str
    text: str
    keys: tuple[str, ...]


# Phrases that name a licence, and opening passages of public licence texts with the
# phrases that no copy lacks.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
TEMPLATES = (
    Template("apache", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    Template("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("applicable law or agreed to in writing",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("is free software", "gnu general public license")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee",)),
    Template("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


class Filed(NamedTuple):
    """A template as filed: label, whether a base phrase, words, least equal words, positions of key phrases (rarest first)."""

    label: str
    base: bool
    words: tuple[str, ...]
    need: int
    keys: tuple[int, ...]


def _key_positions(words: Sequence[str], keys: Sequence[str]) -> list[int]:
    out: set[int] = set()
    for key in keys:
        parts = key.split()
        at = next((k for k in range(len(words) - len(parts) + 1) if list(words[k : k + len(parts)]) == parts), None)
        if at is None or not parts:
            raise ValueError(f"{key!r} is no part of its template")
        out.update(range(at, at + len(parts)))
    return sorted(out)


def filed(phrases: Mapping[str, str], templates: Sequence[Template], share: float, seen: Mapping[str, int]) -> list[Filed]:
    """Phrases and templates with key positions ordered by inverse document frequency, ties by the word."""
    out = []
    for text, label in phrases.items():
        words = tuple(text.split())
        out.append((label, True, words, len(words), list(range(len(words)))))
    for label, text, keys in templates:
        words = tuple(text.split())
        if not keys:
            raise ValueError(f"the template of {label!r} has no key phrase")
        need = -(-len(words) * round(share * 1000) // 1000)
        out.append((label, False, words, need, _key_positions(words, keys)))
    rarest = lambda words: lambda k: (seen.get(words[k], 0), words[k], k)
    return [Filed(label, base, words, need, tuple(sorted(keys, key=rarest(words)))) for label, base, words, need, keys in out]


def document_frequencies(docs: DataFrame, text: str, words: Sequence[str]) -> dict[str, int]:
    """In how many of all rows each of some words occurs; at most as many counts as words reach the driver."""
    known = F.array(*[F.lit(w) for w in sorted(words)])
    held = F.array_intersect(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), known)
    return {r.word: r.n for r in docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def _words_at(words: Column, start: Column, template: Column, positions: Column) -> Column:
    """How many of a template's ``positions`` hold their word when it starts at ``start``; places outside the text hold none."""
    equal = lambda k: F.get(words, start + k) == F.get(template["words"], k)
    return F.size(F.filter(positions, lambda k: F.when(start + k >= 0, F.coalesce(equal(k), F.lit(False))).otherwise(F.lit(False))))


def scanned(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[Template] = TEMPLATES, share: float = 0.8, rare: int = 3,
) -> DataFrame:
    """``(doc_id, n_words, places)`` of every row; ``places`` has ``label, base, start, score`` of each place found.

    A phrase is found wherever its words stand in a row. A template is found where at least ``share``
    of its words (``score``) stand at their places, all key phrases among them. A-Z count as a-z, words are runs of digits, letters and
    anything beyond ASCII, ``start`` counts words from 0. Whole texts are read; a null text is empty.
    Repeated rows and null ids come back as they are; extra columns play no part; an empty table gives no rows.

    No row is shuffled: the index is a literal of ``phrases`` and ``templates``, and only their words' document
    frequencies, counted over all rows, reach the driver.
    """
    require(docs, doc_id, text)
    keys = {w for f in filed(phrases, templates, share, {}) for w in (f.words[k] for k in f.keys)}
    index = filed(phrases, templates, share, document_frequencies(docs, text, keys))
    known = F.array(*[F.struct(
        F.lit(f.label).alias("label"), F.lit(f.base).alias("base"), F.array(*map(F.lit, f.words)).alias("words"), F.lit(f.need).alias("need"),
        F.array(*map(F.lit, f.keys)).alias("keys"), F.array(*map(F.lit, f.keys[:rare])).alias("rare"),
        F.array(*map(F.lit, range(len(f.words)))).alias("all"), F.lit(len(f.words)).alias("size")) for f in index])
    postings: dict[str, list[Column]] = {}
    for n, f in enumerate(index):
        postings.setdefault(f.words[f.keys[0]], []).append(F.struct(F.lit(n).alias("t"), F.lit(f.keys[0]).alias("at")))
    lookup = F.create_map(*[part for word, found in sorted(postings.items()) for part in (F.lit(word), F.array(*found))])
    leads = F.array(*[F.lit(w) for w in sorted(postings)])

    body = F.coalesce(F.col(text), F.lit(""))
    lowered = lambda w: F.translate(w, string.ascii_uppercase, string.ascii_lowercase)
    # A text without any rare word, which is nearly all of them, is never cut in words.
    some = body.rlike("(?i)" + "|".join(sorted(postings)))
    cut = F.transform(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), lowered)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_words"), F.when(some, cut).alias("words"))
    at = F.filter(F.transform("words", lambda w, i: F.when(F.array_contains(leads, w), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("at", F.when(F.col("words").isNotNull(), at))
    starts = F.flatten(F.transform("at", lambda i: F.transform(F.element_at(lookup, F.get("words", i)), lambda p: F.struct(
        p["t"].alias("t"), (i - p["at"]).alias("start")))))
    template = lambda c: F.get(known, c["t"])
    whole = lambda c, positions: _words_at(F.col("words"), c["start"], template(c), template(c)[positions]) == F.size(template(c)[positions])
    met = F.filter(F.filter(starts, lambda c: whole(c, "rare")), lambda c: whole(c, "keys"))
    measured = F.transform(met, lambda c: F.struct(
        template(c)["label"].alias("label"), template(c)["base"].alias("base"), c["start"].cast("long").alias("start"),
        _words_at(F.col("words"), c["start"], template(c), template(c)["all"]).alias("equal"), template(c)["need"].alias("need"), template(c)["size"].alias("size")))
    rows = rows.withColumn("met", F.when(F.size("at") > 0, measured))
    places = F.transform(F.filter("met", lambda p: p["equal"] >= p["need"]), lambda p: F.struct(
        p["label"].alias("label"), p["base"].alias("base"), p["start"].alias("start"), (p["equal"] / p["size"]).alias("score")))
    return rows.select("doc_id", "n_words", places.alias("places"))


def license_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)``, one row for each row of ``docs``.

    ``n_base``, ``first_word`` and ``last_word`` are of the places of base phrases (null without any);
    labels are distinct, sorted and joined by commas, empty without any; ``score`` is the largest of a place,
    0 without any. Nulls, repeats and extra columns are handled as in ``scanned``.
    """
    found = scanned(docs, doc_id, text, **options)
    empty = F.array().cast("array<struct<label:string,base:boolean,start:bigint,score:double>>")
    found = found.withColumn("places", F.coalesce("places", empty)).withColumn("base", F.filter("places", lambda p: p["base"]))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform("base", lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("places").alias("labels"), F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"))
