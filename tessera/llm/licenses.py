r"""License scans with a generalised suffix automaton of licence templates.

The words of all templates make one suffix automaton.  A text's words stream
through it and give matching statistics: at every word the longest run of words ending
there that occurs in some template, and the automaton's state.  A run that the
next word does not extend is a match; a match of ``LONG`` words or more occurs at the
template places that its state names.  Matches of one template are chained:
the next one begins at most ``GAP`` words later in the text and further on in the
template, and overlaps count once.  A chain that covers ``COVERED`` of its
template is a span with the template's label.  A phrase must be whole: it is
found where a state's match ends with it, which the suffix links tell.

A word that no template holds empties the match, so only stretches of template
words are followed; the work is linear in the text, and the chains that are open at a
word are bounded by ``GAP`` and the templates.

Defined cases: null and empty texts have no words, no spans and score 0; rows
are independent, so repeated rows and rows without id are scanned alike; an
empty table gives none; columns other than id and text are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import plain_words, slices, text_bytes

LONG, GAP, COVERED = 4, 24, 0.75

# Phrases that are reported wherever they stand.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)

# Wording of common public licence notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
     Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
     an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
     specific language governing permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
     the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
     conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
     this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
     distribution."""),
    ("boost-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights
     to this software to the public domain worldwide. This software is distributed without any warranty."""),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
     later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
     the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
     more details."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
     rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
     persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
     and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
     not distributed with this file, You can obtain one at"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
     publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
     purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
     liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
     for any purpose, including commercial applications, and to alter it and redistribute it freely."""),
)


class Match(NamedTuple):
    """Words ``end - length + 1`` to ``end`` of the text stand in templates; ``state`` names where."""
    end: int
    length: int
    state: int


class Span(NamedTuple):
    label: str
    start: int
    end: int  # exclusive
    share: float
    base: bool


class Automaton:
    """Generalised suffix automaton of several word sequences."""

    def __init__(self, texts: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]  # (text, last word) of the prefixes that end in a state
        for number, words in enumerate(texts):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                while len(ends) < len(self.next):
                    ends.append([])
                ends[last].append((number, at))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]].extend(ends[state])
        self.ends = ends  # every place at which a state's words end

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of exactly ``state``'s longest words and ``word``, parted from longer ones if need be."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        short = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = short
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = short
            state = self.link[state]
        return short

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, state = self._new(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """Matching statistics one word on."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        following = self.next[state].get(word)
        return (0, 0) if following is None else (following, length + 1)


class Scanner:
    """Labels of phrases and templates in texts."""

    def __init__(self, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES):
        self.vocabulary: dict[bytes, int] = {}
        both = [*phrases, *templates]
        self.labels = [label for label, _ in both]
        texts = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in plain_words(t.encode())] for _, t in both]
        self.sizes = [len(t) for t in texts]
        self.n_phrases = len(phrases)
        self.automaton = Automaton(texts)
        self.shortest = min([self.sizes[k] for k in range(self.n_phrases)] + [LONG])
        # Phrases that a state's words end with: those of its own and of all states on its suffix links.
        exact = {}
        for k in range(self.n_phrases):
            state = length = 0
            for word in texts[k]:
                state, length = self.automaton.step(state, length, word)
            exact.setdefault(state, []).append(k)
        self.endings: list[tuple[int, ...]] = []
        for state in range(len(self.automaton.next)):
            found, up = [], state
            while up > 0:
                found += exact.get(up, [])
                up = self.automaton.link[up]
            self.endings.append(tuple(found))

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, end) of the runs of template words that are long enough to hold anything."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= self.shortest:
                yield start, end

    def statistics(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place, length, state): the longest template words that end at a place, a length of 0 after each stretch."""
        step = self.automaton.step
        for start, end in self.stretches(ids):
            state = length = 0
            for at, word in enumerate(ids[start:end].tolist(), start):
                state, length = step(state, length, word)
                yield at, length, state
            yield end, 0, 0

    def scan(self, text: bytes) -> tuple[int, list[Span], float]:
        """(words, spans by start, greatest covered share of a phrase or template)."""
        words = plain_words(text)
        get = self.vocabulary.get
        ids = np.fromiter([get(w, 0) for w in words], np.int32, len(words))
        phrases: list[Span] = []
        chains = Chains(self)
        before = (0, 0, 0)
        for at, length, state in self.statistics(ids):
            if before[1] >= LONG and length != before[1] + 1:
                chains.add(Match(*before))
            for k in self.endings[state]:
                if length >= self.sizes[k]:
                    phrases.append(Span(self.labels[k], at - self.sizes[k] + 1, at + 1, 1.0, True))
            before = (at, length, state)
        spans = sorted([*phrases, *chains.spans()], key=lambda s: (s.start, s.end, s.label))
        return len(words), spans, 1.0 if phrases else chains.best


class Chain(NamedTuple):
    start: int  # in the text
    end: int
    place: int  # next word of the template
    words: int  # template words covered


class Chains:
    """Collinear chains of matches, per template, in the order of the text."""

    def __init__(self, scanner: Scanner):
        self.scanner = scanner
        self.open: dict[int, list[Chain]] = {}
        self.full: dict[int, list[Chain]] = {}
        self.best = 0.0

    def add(self, match: Match) -> None:
        start = match.end - match.length + 1
        extended: list[tuple[int, Chain]] = []
        for number, last in self.scanner.automaton.ends[match.state]:
            place = last - match.length + 1
            if place < 0:  # a shorter text that the longest words of the state contain
                continue
            chain = Chain(start, match.end + 1, last + 1, match.length)
            for old in self.open.get(number, ()):
                new = match.length - max(0, old.end - start, old.place - place)
                if start - old.end <= GAP and new > 0 and old.words + new > chain.words:
                    chain = Chain(old.start, match.end + 1, last + 1, old.words + new)
            extended.append((number, chain))
        for number, chain in extended:
            live = [c for c in self.open.get(number, ()) if start - c.end <= GAP]
            self.open[number] = [*live, chain]
            if number < self.scanner.n_phrases:
                continue
            share = chain.words / self.scanner.sizes[number]
            self.best = max(self.best, share)
            if share >= COVERED:
                self.full.setdefault(number, []).append(chain)

    def spans(self) -> list[Span]:
        """Per label, the full chains that cover most and do not overlap."""
        by_label: dict[str, list[Span]] = {}
        for number, chains in self.full.items():
            label = self.scanner.labels[number]
            by_label.setdefault(label, []).extend(
                Span(label, c.start, c.end, c.words / self.scanner.sizes[number], False) for c in chains)
        out = []
        for found in by_label.values():
            # Spans of a label in the order of their starts; of overlapping ones the one of the largest share stays.
            kept: list[Span] = []
            for span in sorted(found, key=lambda s: (s.start, s.end)):
                if kept and span.start < kept[-1].end:
                    if (span.share, span.end - span.start) > (kept[-1].share, kept[-1].end - kept[-1].start):
                        kept[-1] = span
                else:
                    kept.append(span)
            out += kept
        return out


@functools.lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


_FOUND = ("doc_id bigint, n_words bigint, "
          "spans array<struct<label:string,start:bigint,end:bigint,share:double,base:boolean>>, score double")


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, spans, score) of every row; spans count words from 0, their ends are exclusive."""
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner()
        for batch in slices(batches, "text"):
            got = [own.scan(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([[s._asdict() for s in g[1]] for g in got], pa.list_(span)), pa.array([g[2] for g in got], pa.float64())],
                ["doc_id", "n_words", "spans", "score"])

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _FOUND)
    return found.withColumnRenamed("doc_id", id_col)


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def label_list(spans: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
