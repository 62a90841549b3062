"""Licence scans: matching statistics from a generalised suffix automaton of licence tokens.

The automaton has every run of words of every template. A text streams through it once: at each
word the state and the length of the longest run that ends there and stands in a template. Long
runs are chained, template by template, into spans that cover most of the template.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import sliced, words_of

# Phrases whose every place counts, and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Sentences that licence notices use, and their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by 4 0": "cc-by-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc0 1 0 universal": "cc0-1.0",
    "this work is licensed under the gnu general public license version 2": "gpl-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this library is licensed under the gnu lesser general public license": "lgpl",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "mpl-2.0",
    "all rights reserved": "reserved",
}
#: Shortest run that is chained, words between chained runs, share of a template a span covers.
LONG = 2
GAP = 3
COVERED = 0.8


class Automaton:
    """Generalised suffix automaton over word numbers (0: in no template)."""

    def __init__(self, templates: dict[str, str], base: dict[str, str]) -> None:
        self.templates = [(t.encode().split(), label) for t, label in templates.items()]
        phrases = [(t.encode().split(), label) for t, label in base.items()]
        phrases = [x for x in phrases if x[0]]
        strings = [x for x, _ in self.templates + phrases]
        known = sorted({w for s in strings for w in s})
        self.numbers = {w: i + 1 for i, w in enumerate(known)}
        self.size, self.link, self.next = [0], [-1], [{}]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, string in enumerate(strings):
            last = 0
            for i, word in enumerate(string):
                last = self._add(last, self.numbers[word], ends)
                if t < len(self.templates):
                    ends[last].add((t, i))
        for v in sorted(range(1, len(self.size)), key=lambda v: -self.size[v]):
            ends[self.link[v]] |= ends[v] if self.link[v] else set()
        self.ends = [sorted(x) for x in ends]
        self.base: list[list[tuple[int, str]]] = [[] for _ in self.size]
        for string, label in phrases:
            v = 0
            for word in string:
                v = self.next[v][self.numbers[word]]
            if len(string) > 1:
                self.base[v].append((len(string), label))
        for v in sorted(range(1, len(self.size)), key=lambda v: self.size[v]):
            self.base[v] = self.base[self.link[v]] + self.base[v]
        #: words that are a phrase by themselves, and all their labels
        self.alone = {self.numbers[s[0]]: [] for s, _ in phrases if len(s) == 1}
        for string, label in phrases:
            if len(string) == 1:
                self.alone[self.numbers[string[0]]].append(label)
        self.pairs = np.zeros((len(known) + 1, len(known) + 1), bool)
        for string in strings:
            for a, b in zip(string, string[1:], strict=False):
                self.pairs[self.numbers[a], self.numbers[b]] = True

    def _state(self, size: int, link: int, follow: dict, ends: list) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(follow)
        ends.append(set())
        return len(self.size) - 1

    def _add(self, last: int, word: int, ends: list) -> int:
        """The state of the string so far and a word, new or there already."""
        new, v = None, last
        if word not in self.next[last]:
            new = self._state(self.size[last] + 1, 0, {}, ends)
            while v >= 0 and word not in self.next[v]:
                self.next[v][word] = new
                v = self.link[v]
            if v < 0:
                return new
        q = self.next[v][word]
        if self.size[q] != self.size[v] + 1:
            # shorter runs of q end in more places than its longest: they get a state of their own
            copy = self._state(self.size[v] + 1, self.link[q], dict(self.next[q]), ends)
            self.link[q] = copy
            while v >= 0 and self.next[v].get(word) == q:
                self.next[v][word] = copy
                v = self.link[v]
            q = copy
        if new is None:
            return q
        self.link[new] = q
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple]]:
        """(start, label) of all base places; spans (template, label, first, last, covered)."""
        get = self.numbers.get
        numbers = np.array([get(w, 0) for w in words], np.int64)
        places: list[tuple[int, str]] = []
        if self.alone:
            single = np.flatnonzero(np.isin(numbers, list(self.alone)))
            places += [(i, label) for i in single.tolist() for label in self.alone[int(numbers[i])]]
        if len(numbers) < 2:
            return places, []
        runs: dict[int, list[tuple[int, int, int]]] = {}
        # a run of two words or more is made of pairs that stand in a template
        pair = np.flatnonzero(self.pairs[numbers[:-1], numbers[1:]])
        if not len(pair):
            return places, []
        cut = np.flatnonzero(np.diff(pair) > 1)
        begin = pair[np.concatenate([[0], cut + 1])].tolist()
        end = (pair[np.concatenate([cut, [len(pair) - 1]])] + 1).tolist()
        for first, last in zip(begin, end, strict=True):
            state = size = 0
            for i in range(first, last + 1):
                word = int(numbers[i])
                while state and word not in self.next[state]:
                    state = self.link[state]
                    size = self.size[state]
                state = self.next[state].get(word, 0)
                size = size + 1 if state else 0
                for n, label in self.base[state]:
                    if n <= size:
                        places.append((i - n + 1, label))
                grows = i < last and int(numbers[i + 1]) in self.next[state]
                if size >= LONG and not grows:
                    for t, e in self.ends[state]:
                        runs.setdefault(t, []).append((i - size + 1, i, e))
        return places, self._chained(runs)

    def _chained(self, runs: dict[int, list[tuple[int, int, int]]]) -> list[tuple]:
        """Chains of runs that go forward in text and template, one after the other."""
        spans = []
        for t, found in runs.items():
            words, label = self.templates[t]
            best: list[tuple[int, int]] = []  # words covered up to a run, start of the chain
            for j, (a, b, e) in enumerate(found):
                covered, start = b - a + 1, a
                i = j - 1
                while i >= 0 and found[i][1] >= a - 1 - GAP - len(words):
                    before = found[i]
                    gap, skipped = a - before[1] - 1, e - (b - a) - before[2] - 1
                    over = max(0, -gap, -skipped)
                    if gap <= GAP and over < b - a + 1 and before[2] < e and before[1] < b:
                        if best[i][0] + b - a + 1 - over > covered:
                            covered, start = best[i][0] + b - a + 1 - over, best[i][1]
                    i -= 1
                best.append((covered, start))
                share = covered / len(words)
                if share >= COVERED:
                    if spans and spans[-1][:3] == (t, label, start):
                        spans.pop()
                    spans.append((t, label, start, b, min(1.0, share)))
        return spans


def scanned(
    docs: DataFrame, templates: dict[str, str] | None = None, base: dict[str, str] | None = None
) -> DataFrame:
    """doc_id, n_words, places (start, label) and spans (template, label, first, last, covered).

    A null text counts as empty and has none; repeated rows are scanned each for itself; words are
    counted from 0 over the whole text; other columns are not read. `templates` and `base` map
    phrases, in lower case and with single blanks, to labels.
    """
    automaton = Automaton(TEMPLATES if templates is None else templates, BASE if base is None else base)
    place = pa.struct([("start", pa.int64()), ("label", pa.string())])
    span = pa.struct(
        [
            ("template", pa.int64()),
            ("label", pa.string()),
            ("first", pa.int64()),
            ("last", pa.int64()),
            ("covered", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, places, spans = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found, covered = automaton.scan(words)
                sizes.append(len(words))
                places.append([dict(zip(("start", "label"), x, strict=True)) for x in found])
                names = ("template", "label", "first", "last", "covered")
                spans.append([dict(zip(names, x, strict=True)) for x in covered])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(places, pa.list_(place)),
                    pa.array(spans, pa.list_(span)),
                ],
                ["doc_id", "n_words", "places", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run,
        "doc_id long, n_words long, places array<struct<start: long, label: string>>,"
        " spans array<struct<template: long, label: string, first: long, last: long,"
        " covered: double>>",
    )
