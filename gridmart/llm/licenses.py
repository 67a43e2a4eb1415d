"""Licence scan with a generalised suffix automaton over the words of licence templates.

Every text is streamed through the automaton word by word. The state tells the longest suffix read so
far that occurs in some template (the matching statistic); where the last ``MIN_MATCH`` words stand, in every template
and at every place, hangs on one of its suffix ancestors. Words that go on matching at one place are a segment: a maximal match
of ``MIN_MATCH`` words or more. Segments are chained per template: in text order, ascending in the template and at most
``MAX_GAP`` words apart in the text; what overlaps counts once. The best chain that ends in each segment comes from
dynamic programming; a template is found where a chain covers ``MIN_COVER`` of its words, and of chains that
overlap in the text the one that covers most is told.
Phrases whose every place counts (the base) are templates too: a phrase ends at a word exactly if its own
state is the current one, matched at full length, or one of its suffix ancestors.

The templates are a parameter of bounded size (short notices here, whole texts in the folder ``licences``); their automaton
is built once in each worker process. Documents are never shuffled.

Edge cases: NULL and empty texts have no words, no places and score 0. Empty templates are ignored, equal
templates under two labels give both labels. Templates shorter than ``MIN_MATCH`` words are not found. Repeated rows
are scanned each for itself.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame

from gridmart.llm.rows import map_texts
from gridmart.llm.words import alnum_words

MIN_MATCH = 4
MAX_GAP = 8
MIN_COVER = 0.5

#: Phrases and their labels; all their places are reported.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

_FOLDER = Path(__file__).parent / "licences"

#: Short notices, whole licences and standard notices of longer ones, with this scan's own labels.
TEMPLATES = [
    *((f"{path.stem}-whole", path.read_text(encoding="utf-8")) for path in sorted(_FOLDER.glob("*.txt"))),
    ("mit-notice", "released under the mit license"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    (
        "gpl-3.0-notice",
        "this work is licensed under the gnu general public license version 3",
    ),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files to deal in the software without restriction",
    ),
    (
        "apache-2.0-text",
        "you may not use this file except in compliance with the license you may obtain a copy of "
        "the license at",
    ),
    (
        "gpl-text",
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation",
    ),
    (
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    (
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
]

FOUND = """n_words bigint, n_base bigint, first_word bigint, last_word bigint,
base_labels array<string>, covered array<struct<label:string,first:int,stop:int,share:double>>"""


class SuffixAutomaton:
    """All factors of several word sequences. ``ends[state]``: all places (template, word) they end at."""

    def __init__(self, templates: Iterable[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        self.last: list[int] = []
        for k, words in enumerate(templates):
            state = 0
            for at, word in enumerate(words):
                state = self._extend(state, word)
                self.ends[state].add((k, at))
            self.last.append(state)
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state]:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, transitions: dict[bytes, int], link: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, parent: int, word: bytes, child: int) -> int:
        """The state of exactly those factors of ``child`` that ``parent`` reaches by ``word``."""
        if self.length[child] == self.length[parent] + 1:
            return child
        clone = self._state(self.length[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = clone
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, {}, 0)
        parent = last
        while parent >= 0 and word not in self.next[parent]:
            self.next[parent][word] = new
            parent = self.link[parent]
        if parent >= 0:
            self.link[new] = self._split(parent, word, self.next[parent][word])
        return new

    def ancestors(self, state: int) -> Iterable[int]:
        while state > 0:
            yield state
            state = self.link[state]


class Scanner:
    def __init__(self, base: list[tuple[str, str]], templates: list[tuple[str, str]]):
        self.phrases = [(alnum_words(p.encode()), label) for p, label in base]
        self.phrases = [(words, label) for words, label in self.phrases if words]
        own = [(label, alnum_words(t.encode())) for label, t in templates]
        self.own = [(label, words) for label, words in own if words]
        self.automaton = a = SuffixAutomaton(
            [words for words, _ in self.phrases] + [words for _, words in self.own]
        )
        self.known = set(a.next[0])
        by_state: dict[int, list[int]] = {}
        for p in range(len(self.phrases)):
            by_state.setdefault(a.last[p], []).append(p)
        #: Phrases that may end in a state: with the length the match must have.
        self.ending = [
            [(p, len(self.phrases[p][0])) for s in a.ancestors(state) for p in by_state.get(s, ())]
            for state in range(len(a.link))
        ]
        #: Where in templates the last MIN_MATCH words of a state stand.
        self.places = [self._places(state) for state in range(len(a.link))]

    def _places(self, state: int) -> list[tuple[int, int]]:
        a, found = self.automaton, 0
        for s in a.ancestors(state):
            if a.length[s] >= MIN_MATCH:
                found = s
        return sorted((k, at) for k, at in a.ends[found] if found and k >= len(self.phrases))

    def statistics(self, words: list[bytes]):
        """(index, state, matching length) wherever something matches."""
        a, state, size = self.automaton, 0, 0
        step, link, length, known = a.next, a.link, a.length, self.known
        for i, word in enumerate(words):
            if word not in known:
                state = size = 0
                continue
            while state and word not in step[state]:
                state = link[state]
                size = length[state]
            state = step[state][word]
            size += 1
            yield i, state, size

    def scan(self, words: list[bytes]):
        places: list[tuple[int, str]] = []
        segments: dict[int, list[tuple[int, int, int]]] = {}
        if not self.known.isdisjoint(words):
            going: dict[tuple[int, int], int] = {}  # (template, diagonal) -> first word of the text
            last = -1
            for i, state, size in self.statistics(words):
                for p, n in self.ending[state]:
                    if size >= n:
                        places.append((i - n + 1, self.phrases[p][1]))
                here = self.places[state] if size >= MIN_MATCH else ()
                if going or here:
                    if i != last + 1:
                        self._close(segments, going, going, last)
                        going = {}
                    now = {(k, i - at): going.get((k, i - at), i - MIN_MATCH + 1) for k, at in here}
                    self._close(segments, going, going.keys() - now.keys(), last)
                    going = now
                last = i
            self._close(segments, going, going, last)
        found = [c for k, own in sorted(segments.items()) for c in self._chains(k, own)]
        return places, found

    @staticmethod
    def _close(segments: dict, going: dict, ended, last: int) -> None:
        for k, diagonal in ended:
            first = going[k, diagonal]
            segments.setdefault(k, []).append((first, last + 1, first - diagonal))

    def _chains(self, k: int, segments: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of one template that cover enough, apart from each other in the text.

        A segment is (first, stop, begin): words of the text, and the word of the template that it begins with.
        """
        label, words = self.own[k - len(self.phrases)]
        segments = sorted(segments, key=lambda s: (s[1], s[0], s[2]))
        stops = [s[1] for s in segments]
        best: list[tuple[int, int]] = []  # covered words, first word of the text
        for j, (first, stop, begin) in enumerate(segments):
            upto = begin + stop - first
            covered, start = stop - first, first
            for i in range(j - 1, -1, -1):
                if stops[i] < first - MAX_GAP:
                    break
                own_first, own_stop, own_begin = segments[i]
                own_upto = own_begin + own_stop - own_first
                if own_stop >= stop or own_upto >= upto or own_first >= first or own_begin >= begin:
                    continue
                more = stop - first - max(0, own_stop - first, own_upto - begin)
                if more > 0 and best[i][0] + more > covered:
                    covered, start = best[i][0] + more, best[i][1]
            best.append((covered, start))
        enough = [j for j, (covered, _) in enumerate(best) if covered >= MIN_COVER * len(words)]
        if not enough:
            return []
        # The best chain first, then others apart from those taken.
        taken: list[tuple[int, int, int]] = []
        for j in sorted(enough, key=lambda j: (-best[j][0], stops[j])):
            span = best[j][1], stops[j], best[j][0]
            at = bisect_right(taken, span)
            if (not at or taken[at - 1][1] <= span[0]) and (at == len(taken) or span[1] <= taken[at][0]):
                taken.insert(at, span)
        return [
            dict(label=label, first=first, stop=stop, share=min(1.0, covered / len(words)))
            for first, stop, covered in taken
        ]


_scanners: dict[tuple, Scanner] = {}


def scanner(base: list[tuple[str, str]], templates: list[tuple[str, str]]) -> Scanner:
    """One scanner for a set of templates in each worker process, kept between tasks."""
    key = tuple(base), tuple(templates)
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(base, templates)
    return _scanners[key]


def scan(
    docs: DataFrame,
    text: str = "text",
    base: list[tuple[str, str]] = BASE,
    templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """``row`` (the document) and ``out``: places of base phrases and covered template spans."""

    def make():
        own = scanner(base, templates)

        def function(texts):
            columns: list[list] = [[] for _ in range(6)]
            for t in texts:
                words = alnum_words(t)
                places, covered = own.scan(words)
                at = [i for i, _ in places]
                values = (
                    len(words),
                    len(places),
                    min(at, default=None),
                    max(at, default=None),
                    sorted({label for _, label in places}),
                    covered,
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            return columns

        return function

    return map_texts(docs, make, FOUND, text)


def digest(found: DataFrame) -> DataFrame:
    """One row per document: base places, all labels, and the largest covered share."""
    return found.selectExpr(
        "row.doc_id",
        "out.n_words",
        "out.n_base",
        "out.first_word",
        "out.last_word",
        "array_join(out.base_labels, ',') AS base_labels",
        "array_join(array_sort(array_distinct(concat(out.base_labels, out.covered.label))), ',') "
        "AS labels",
        "CASE WHEN out.n_base > 0 THEN 1.0D ELSE coalesce(array_max(out.covered.share), 0.0D) END "
        "AS score",
    )
