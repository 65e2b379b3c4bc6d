"""License scans: an exact set-similarity join of text blocks with license templates.

Every text is cut into blocks of `BLOCK` words, each begun `BLOCK` / 2 words after
the one before it, so a run of up to `BLOCK` / 2 words lies whole in some block. A
template matches a block that holds at least its threshold's share of its
different words (containment). One of fewer than `SHORT` different words must be
there whole, the word that names its license included: without one word, it would
be any sentence about licenses. A template longer than `BLOCK` / 2 words, such as
a whole license text, is looked for in parts of even length, and each part that
meets the threshold gives its label.

Tokens are ordered by their frequency over the whole corpus, rarest first. A
block with at least k of a template's n words must hold one of its n - k + 1
rarest (prefix filter); it must hold k words of the templates' vocabulary in all
(length filter); and from the first word they share, at least k - 1 must be left
on both sides (positional filter). What passes is verified word by word, so the
join finds all matches and nothing else.

The base phrases are templates with containment 1 whose blocks are then searched
for the words in a row.

Defined results: null and empty texts have no words, no labels and score 0; a very
long text is joined block by block, wherever the match stands; a word in several
templates counts for each, and equal matches of a label are one label;
repeated rows are scanned alike; overlapping blocks report a place once; an empty
table gives no rows; columns named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.llm.common import append_columns, slices, small_batches, texts_of
from stormgrid.llm.decontaminate import HASHED_BYTES, WordHasher

BLOCK = 64
THRESHOLD = 0.8
#: Templates of fewer different words than this must be there whole.
SHORT = 10


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Words must stand in a row; all of them are needed.
    phrase: bool = False


#: Base phrases and their labels.
BASE = [
    Template("cc-by", "cc by", phrase=True),
    Template("gpl", "general public license", phrase=True),
    Template("reserved", "all rights reserved", phrase=True),
]
#: Sentences by which public licenses are known, and whole texts of short licenses.
TEMPLATES = [
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template(
        "mit",
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution",
    ),
]


def words_of(templates: list[Template]) -> list[list[str]]:
    return [t.text.split() for t in templates]


def in_parts(templates: list[Template], block: int = BLOCK) -> list[Template]:
    """The templates, those of more than `block` / 2 words cut into the fewest parts of even length."""
    out = []
    for t in templates:
        words = t.text.split()
        number = 1 if t.phrase else max(-(-len(words) // (block // 2)), 1)
        cuts = [len(words) * i // number for i in range(number + 1)]
        out += [Template(t.label, " ".join(words[a:b]), t.phrase) for a, b in zip(cuts, cuts[1:], strict=False)]
    return out


def least_share(template: Template, threshold: float) -> float:
    """The share of its different words that a block must hold to match."""
    return 1.0 if template.phrase or len(set(template.text.split())) < SHORT else threshold


def frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How often each word of the templates stands in the corpus; as many rows as the templates have words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        codes = hasher([w.encode() for w in vocabulary])[0]
        order = np.argsort(codes)
        counts = np.zeros(len(codes), dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text", HASHED_BYTES):
                place = _places(hasher(texts_of(batch, "text"))[0], codes[order])
                counts[order] += np.bincount(place[place >= 0], minlength=len(codes))
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "word string, n bigint")
    return dict.fromkeys(vocabulary, 0) | {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _places(hashes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The place of each hash in a sorted list, -1 if it has none."""
    at = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
    return np.where(ordered[at] == hashes, at, -1)


class Join:
    """The join of the blocks of one text with all templates."""

    def __init__(self, templates: list[Template], counts: dict[str, int], threshold: float, block: int) -> None:
        ranked = sorted(counts, key=lambda w: (counts[w], w))
        rank = {w: i for i, w in enumerate(ranked)}
        self.hasher, self.half = WordHasher(), block // 2
        codes = self.hasher([w.encode() for w in ranked])[0]
        order = np.argsort(codes)
        self.codes, self.ranks = codes[order], order
        self.templates = templates
        self.phrases = [np.array([rank[w] for w in words]) for words in words_of(templates)]
        self.sets = [sorted(set(p.tolist())) for p in self.phrases]
        self.least = [int(np.ceil(round(least_share(t, threshold) * len(s), 9))) for t, s in zip(templates, self.sets, strict=True)]
        self.by_prefix: dict[int, list[int]] = {}
        for i, (words, least) in enumerate(zip(self.sets, self.least, strict=True)):
            for w in words[: len(words) - least + 1]:
                self.by_prefix.setdefault(w, []).append(i)
        self.in_prefix = np.zeros(len(ranked) + 1, dtype=bool)
        self.in_prefix[list(self.by_prefix)] = True

    def ranks_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The rank of every word of the texts (-1 outside the vocabulary), and their numbers of words."""
        hashes, counts = self.hasher(texts)
        at = _places(hashes, self.codes)
        return np.where(at >= 0, self.ranks[at], -1), counts

    def matches(self, ranks: np.ndarray) -> list[tuple[int, int, float]]:
        """(template, first word of the block or of the phrase, containment) of every match in one text."""
        hits = np.flatnonzero(self.in_prefix[ranks])
        if not len(hits):
            return []
        number = hits // self.half
        found: set[tuple[int, int, float]] = set()
        for b in np.unique(np.concatenate([number, number - 1])).tolist():
            start = max(b, 0) * self.half
            block = ranks[start : start + 2 * self.half]
            held = np.unique(block[block >= 0]).tolist()
            places = {w: i for i, w in enumerate(held)}
            for t in {t for w in held for t in self.by_prefix.get(w, ())}:
                words, least = self.sets[t], self.least[t]
                if len(held) < least:
                    continue
                i, j = next((i, places[w]) for i, w in enumerate(words) if w in places)
                if 1 + min(len(words) - i - 1, len(held) - j - 1) < least:
                    continue
                shared = sum(w in places for w in words[i:])
                if shared < least:
                    continue
                if self.templates[t].phrase:
                    found.update((t, start + p, 1.0) for p in self.in_a_row(block, self.phrases[t]))
                else:
                    found.add((t, start, shared / len(words)))
        return sorted(found)

    @staticmethod
    def in_a_row(block: np.ndarray, phrase: np.ndarray) -> list[int]:
        n = len(block) - len(phrase) + 1
        if n <= 0:
            return []
        same = np.ones(n, dtype=bool)
        for k, w in enumerate(phrase):
            same &= block[k : k + n] == w
        return np.flatnonzero(same).tolist()


def scan(docs: DataFrame, text: str = "text", base: list[Template] = BASE, templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """All columns of `docs` but the text, with counts, places, labels, score and `matches`.

    `matches` names for each template match the label, the word at which the block
    (or the phrase) begins and the containment; `score` is the largest containment.
    """
    every = [*base, *in_parts(templates, block)]
    for t, words in zip(every, words_of(every), strict=True):
        if not 0 < len(words) <= block // 2:
            raise ValueError(f"a template has a word, a phrase at most {block // 2}: {t.text!r}")
    counts = frequencies(docs, sorted({w for words in words_of(every) for w in words}), text)
    match = T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType()), T.StructField("containment", T.DoubleType())])
    fields = [
        T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("matches", T.ArrayType(match)),
    ]

    def make():
        join = Join(every, counts, threshold, block)

        def work(texts):
            ranks, sizes = join.ranks_of(texts)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            rows = []
            for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                found = join.matches(ranks[a:b])
                starts = [w for t, w, _ in found if t < len(base)]
                first = {every[t].label for t, _, _ in found if t < len(base)}
                rows.append((
                    b - a, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(first)),
                    ",".join(sorted(first | {every[t].label for t, _, _ in found})), max((c for _, _, c in found), default=0.0),
                    [{"label": every[t].label, "word": w, "containment": c} for t, w, c in found],
                ))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in fields]

        return work

    return append_columns(docs, text, make, fields, drop=(text,))
