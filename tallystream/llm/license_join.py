"""License scans: an exact set-similarity join of word windows with license templates.

A block is a window of a text's words, wherever its lines break. A template is
found in a window if at least ``threshold`` of the template's distinct words are in
it; windows are as long as the template has words, over the threshold. Words are
ordered by how many texts of the whole corpus hold them, rarest first. To reach the
needed overlap a text must hold one of a template's first words (its prefix), and
enough of those from the first shared word on (positional filter); windows must hold
enough words (length filter). What passes is counted in full, so that every pair at
the threshold is found.

Where several templates share words of one place, only that of the best fit there and, if
equal, of the most words gives its label: a notice's own license. The fit is the share of
the template's words that the window holds, times the share of its stretch of text that
they are, times the share of its pairs of words that follow one another there, so that two
notices side by side are not taken for a third one. Templates equal in both are all named.

Null texts are empty: no words, no labels, score 0. Repeated documents each get
a row. Very long texts are read whole: a window's cost does not depend on the text's
length. An empty table gives no rows. Only doc_id and text are read; other columns may
have any name. The templates may have up to ``MAX_TEMPLATE_WORDS`` different words, as
they are sent to each task; more are refused.
"""

from __future__ import annotations

import math
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import raw_text, slices, words

# Phrases that name a license at any place of a text.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences by which texts are licensed, and their labels.
TEMPLATES = (
    ("Licensed under the Apache License, Version 2.0.", "apache"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("Licensed under CC BY-ND 4.0.", "cc-by-nd"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa"),
    ("Licensed under CC BY-NC-ND 4.0.", "cc-by-nc-nd"),
    ("Licensed under CC BY 4.0.", "cc-by"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "agpl"),
    ("Released under the MIT License.", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
     "without fee is hereby granted", "isc"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written "
     "permission", "bsd"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of "
     "the License at http://www.apache.org/licenses/LICENSE-2.0", "apache"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files, to deal in the Software without "
     "restriction", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
)

MAX_TEMPLATE_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    ranked: tuple[bytes, ...]  # distinct words, rarest in the corpus first
    needed: int
    span: int  # words of a window
    pairs: frozenset[tuple[bytes, bytes]] = frozenset()  # words that follow one another

    def prefix(self) -> tuple[bytes, ...]:
        return self.ranked[: len(self.ranked) - self.needed + 1]


def block_frequency(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many texts of the corpus each word of the templates is; counted in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                for raw in part.column("raw").to_pylist():
                    counts.update(vocabulary.intersection(words(raw)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    counted = docs.select(raw_text()).mapInArrow(run, "word binary, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()  # of the vocabulary
    return {bytes(r.word): r.n for r in rows}


def ranked_templates(docs: DataFrame, templates, threshold: float) -> list[Template]:
    listed = [(label, words(text.encode())) for text, label in templates]
    listed = [(label, ws) for label, ws in listed if ws]
    vocabulary = set().union(*(ws for _, ws in listed))
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates have more than {MAX_TEMPLATE_WORDS} words; join in parts")
    frequency = block_frequency(docs, vocabulary)
    return [
        Template(
            label,
            tuple(sorted(set(ws), key=lambda w: (frequency.get(w, 0), w))),
            max(1, math.ceil(threshold * len(set(ws)) - 1e-9)),
            math.ceil(len(ws) / min(1.0, max(threshold, 0.1)) - 1e-9),
            frozenset(zip(ws, ws[1:])),
        )
        for label, ws in listed
    ]


class Index:
    """Templates by the words of their prefixes, with positions."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.at: dict[bytes, list[tuple[int, int]]] = {}
        for k, template in enumerate(templates):
            for position, word in enumerate(template.prefix()):
                self.at.setdefault(word, []).append((k, position))
        self.prefixes = set(self.at)

    def found(self, tokens: list[bytes], distinct: set[bytes]) -> Iterator[tuple]:
        """(template, first word, last word, distinct words shared) of windows of a text."""
        first: dict[int, int] = {}
        for word in self.prefixes & distinct:
            for k, position in self.at[word]:
                first[k] = min(first.get(k, position), position)
        for k, position in first.items():
            t = self.templates[k]
            if sum(w in distinct for w in t.ranked[position:]) < t.needed:
                continue
            for start, end, shared in windows(t, tokens):
                yield t, start, end, shared


def windows(t: Template, tokens: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(first word, last word, distinct words shared) of the windows that reach what is needed."""
    wanted = set(t.ranked)
    hits = [at for at, word in enumerate(tokens) if word in wanted]
    held: Counter = Counter()
    left = shared = 0
    for right, at in enumerate(hits):
        shared += not held[tokens[at]]
        held[tokens[at]] += 1
        # A first word that comes again adds nothing to this window or a later one.
        while hits[left] <= at - t.span or held[tokens[hits[left]]] > 1:
            held[tokens[hits[left]]] -= 1
            shared -= not held[tokens[hits[left]]]
            left += 1
        if right - left + 1 >= t.needed and shared >= t.needed:
            yield hits[left], at, shared


def notices(found: list[tuple], tokens: list[bytes]) -> set[str]:
    """Labels of the windows that no better one overlaps."""
    ordered = []
    for t, start, end, shared in found:
        stretch = tokens[start : end + 1]
        follow = sum(pair in t.pairs for pair in zip(stretch, stretch[1:]))
        # Shares of the template, of the stretch, and of the template's pairs of words.
        fit = shared / len(t.ranked) * min(1.0, shared / len(stretch))
        fit *= (1 + min(follow, len(t.pairs))) / (1 + len(t.pairs))
        ordered.append(((fit, len(t.ranked)), start, end, t.label))
    ordered.sort(key=lambda x: (x[0], -x[1]), reverse=True)
    labels: set[str] = set()
    starts, taken = [], {}  # of windows apart from each other
    for rank, start, end, label in ordered:
        before = bisect_right(starts, end) - 1
        if before < 0 or taken[starts[before]][0] < start:
            insort(starts, start)
            taken[start] = end, rank
            labels.add(label)
        elif taken[starts[before]][1] == rank:
            labels.add(label)
    return labels


def phrase_places(tokens: list[bytes], phrases: list[tuple[tuple[bytes, ...], str]]):
    """(start, label) of every place where a phrase's words stand one after another."""
    heads: dict[bytes, list] = {}
    for phrase, label in phrases:
        heads.setdefault(phrase[0], []).append((phrase, label))
    for head, group in heads.items():
        at = -1
        for _ in range(tokens.count(head)):
            at = tokens.index(head, at + 1)
            for phrase, label in group:
                if tuple(tokens[at : at + len(phrase)]) == phrase:
                    yield at, label


def license_scan(
    docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] | None = None, threshold: float = 0.8
) -> DataFrame:
    """Per document: words, places of the phrases, labels of phrases and of notices, score.

    The score is the highest containment of a template found in a window, else 0.
    """
    index = Index(ranked_templates(docs, templates, threshold))
    named = PHRASES if phrases is None else phrases
    spelled = [(tuple(words(p.encode())), label) for p, label in named.items()]
    spelled = [x for x in spelled if x[0]]
    last_words = {p[-1] for p, _ in spelled}

    def judge(raw: bytes) -> tuple:
        tokens = words(raw)
        distinct = set(tokens)
        places = [] if last_words.isdisjoint(distinct) else list(phrase_places(tokens, spelled))
        base, found = {label for _, label in places}, []
        if not index.prefixes.isdisjoint(distinct):
            found = list(index.found(tokens, distinct))
        labels = notices(found, tokens)
        score = max((shared / len(t.ranked) for t, *_, shared in found), default=0.0)
        starts = [at for at, _ in places]
        return (
            len(tokens), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), score,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]
        names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
        for batch in batches:
            for part in slices(batch):
                columns = zip(*map(judge, part.column("raw").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
                )

    return docs.select(F.col("doc_id").cast("long"), raw_text()).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
