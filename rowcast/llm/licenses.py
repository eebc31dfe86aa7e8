"""License scan with a generalised suffix automaton over licence words.

All template texts go into one automaton of words. A file's words run through
it one by one: the state after a word is the longest run of words, ending
there, that some template contains, and its length is the matching statistic.
Runs of at least ``LEAST`` words are chained per template: in file order and
in template order, with gaps up to ``GAP`` words. A template whose chained
words cover enough of it gives its label and a span, one for every place where
the notice stands.

Only words of the templates move the automaton; at any other word it returns
to its start. So the words of a whole batch are first looked up together, and
only runs of at least ``LEAST`` template words are walked. The result is that
of walking every word.

Words are runs of digits, letters a-z (A-Z lower-cased) and all bytes above
ASCII. A set of base phrases is searched besides, as exact runs of words.
NULL and empty texts have no words and no labels. Repeated rows and NULL ids
are scanned as they are; other columns are not looked at. Texts are processed
whole, in windows cut between words.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.shingles import WINDOW, byte_view, groups, mix

LEAST = 3
GAP = 6
COVERED = 0.6

# Phrases and labels that the scan must report.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as projects put them into their files; a label may have several.
TEMPLATES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
]

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _word_bytes() -> np.ndarray:
    inside = np.zeros(256, bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


_IN_WORD = _word_bytes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)


class SuffixAutomaton:
    """All runs of words of several texts; states know every place of their run."""

    def __init__(self, texts: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        # Per state: the texts that have its longest run, with all places where it ends.
        self.ends: list[dict[int, set[int]]] = [{}]
        for number, text in enumerate(texts):
            last = 0
            for place, word in enumerate(text):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, set()).add(place)
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            above = self.link[state]
            for number, places in self.ends[state].items():
                if above > 0:
                    self.ends[above].setdefault(number, set()).update(places)

    def _state(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        copy = self._state(self.length[before] + 1, dict(self.next[state]), self.link[state])
        self.link[state] = copy
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            fits = self.length[known] == self.length[last] + 1
            return known if fits else self._split(last, word, known)
        state, at = self._state(self.length[last] + 1, {}, 0), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            other = self.next[at][word]
            fits = self.length[other] == self.length[at] + 1
            self.link[state] = other if fits else self._split(at, word, other)
        return state

    def statistics(self, words: list[int]) -> list[tuple[int, int]]:
        """After every word: length of the longest known run ending there, and its state."""
        state, size, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            out.append((size, state))
        return out


class Scanner:
    """Templates, phrases and the words they are made of."""

    def __init__(self, templates=None, phrases=None, least: int = LEAST, gap: int = GAP, covered: float = COVERED):
        templates = TEMPLATES if templates is None else templates
        phrases = BASE_PHRASES if phrases is None else phrases
        self.least, self.gap, self.covered = least, gap, covered
        texts = [text.split() for _, text in templates]
        names = sorted({word for text in [*texts, *map(str.split, phrases)] for word in text})
        number = {word: i for i, word in enumerate(names)}
        self.labels = [label for label, _ in templates]
        self.sizes = [len(text) for text in texts]
        self.automaton = SuffixAutomaton([[number[word] for word in text] for text in texts])
        self.phrases = [([number[word] for word in text.split()], label) for text, label in phrases.items()]
        hashes = word_hashes(np.frombuffer(" ".join(names).encode(), np.uint8), np.zeros(0, np.int64))[0]
        order = np.argsort(hashes)
        self.known, self.numbers = hashes[order], order

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words that no template or phrase has."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.numbers[at], -1)

    def places(self, words: np.ndarray, stops: np.ndarray) -> list[tuple[int, str]]:
        """``(start, label)`` of every phrase; ``stops[i]`` is where the text of word i ends."""
        found = []
        for phrase, label in self.phrases:
            starts = np.flatnonzero(words == phrase[0])
            starts = starts[starts + len(phrase) <= stops[starts]]
            for shift, word in enumerate(phrase[1:], 1):
                starts = starts[words[starts + shift] == word]
            found += [(start, label) for start in starts.tolist()]
        return found

    def spans(self, words: np.ndarray, offset: int = 0) -> list[tuple[int, int, int, int]]:
        """Long matches in one run of known words: (template, its place, start, words)."""
        out = []
        stats = self.automaton.statistics(words.tolist())
        for i, (size, state) in enumerate(stats):
            longest = i + 1 == len(stats) or stats[i + 1][0] <= size
            if size >= self.least and longest:
                for number, places in self.automaton.ends[state].items():
                    out += [(number, place - size + 1, offset + i - size + 1, size) for place in sorted(places)]
        return out

    def chained(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, float, int, int]]:
        """``(label, share covered, first word, end)`` of the chains of every template.

        The best chain is given whatever it covers; of the others those that
        cover enough and overlap none that is better.
        """
        by: dict[int, list[tuple[int, int, int]]] = {}
        for number, place, start, size in matches:
            by.setdefault(number, []).append((start, place, size))
        out = []
        for number, own in by.items():
            least, taken = 0.0, []
            own.sort()
            while own:
                found = self._best_chains(number, own, least, taken)
                if not found:
                    break
                for words, first, end in found:
                    out.append((self.labels[number], min(1.0, words / self.sizes[number]), first, end))
                # What lies beside the chains may hold one that reached into them before.
                edges = np.array(sorted((first, end) for _, first, end in taken))
                starts, stops = (np.array(c) for c in zip(*((s, s + size) for s, _, size in own)))
                at = np.searchsorted(edges[:, 0], stops, "left") - 1
                free = (at < 0) | (edges[np.maximum(at, 0), 1] <= starts)
                own = [match for match, apart in zip(own, free) if apart]
                least = self.covered
        return out

    def _best_chains(self, number: int, own: list, least: float, taken: list) -> list[tuple[int, int, int]]:
        """``(words, first, end)`` of chains that do not overlap, best first; they are added to ``taken``."""
        best: list[tuple[int, int]] = []  # (words, first) of chains ending here
        low = 0
        for i, (start, place, size) in enumerate(own):
            gain, first = size, start
            while own[low][0] + self.sizes[number] + self.gap < start:
                low += 1
            for j in range(low, i):
                before, at, long = own[j]
                jump, step = start - before - long, place - at - long
                if 0 <= jump <= self.gap and 0 <= step <= self.gap and best[j][0] + size > gain:
                    gain, first = best[j][0] + size, best[j][1]
            best.append((gain, first))
        chains = sorted((-words, first, own[i][0] + own[i][2]) for i, (words, first) in enumerate(best))
        found, edges = [], sorted((first, end) for _, first, end in taken)
        for words, first, end in chains:
            if found and -words < self.covered * self.sizes[number] or -words < least * self.sizes[number]:
                break
            at = bisect_left(edges, (end, -1))
            if at and edges[at - 1][1] > first:
                continue
            edges.insert(at, (first, end))
            found.append((-words, first, end))
        taken += found
        return found


def word_hashes(content: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start of every word of a window; words also end at ``breaks``."""
    inside = _IN_WORD[content]
    opened = inside.copy()
    opened[1:] &= ~inside[:-1]
    breaks = breaks[breaks < len(content)]
    opened[breaks] = inside[breaks]
    first = np.flatnonzero(opened)
    if not len(first):
        return np.zeros(0, np.uint64), first
    steps = np.full(len(content), _BASE, np.uint64)
    steps[0] = 1
    back = np.full(len(content), _INVERSE, np.uint64)
    back[0] = 1
    values = mix((_LOWER[content].astype(np.uint64) + _U(1)) * _BASE) * np.multiply.accumulate(steps)
    values[~inside] = 0
    return mix(np.add.reduceat(values, first) * np.multiply.accumulate(back)[first]), first


def _words_of(content: np.ndarray, low: int, high: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, places, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], low
    while at < high:
        end = min(at + WINDOW, high)
        while end < high:
            gaps = np.flatnonzero(~_IN_WORD[content[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + WINDOW, high)
        own = cuts[(cuts >= at) & (cuts < end)] - at
        h, p = word_hashes(content[at:end], own)
        hashes.append(h)
        places.append(p + at)
        at = end
    return np.concatenate(hashes), np.concatenate(places)


def scan_column(column: pa.Array, scanner: Scanner):
    """Rows (n_words, n_base, first_word, last_word, base_labels, labels, score, spans) per text."""
    content, starts, ends = byte_view(column)
    for part in groups(starts, ends):
        low, high = int(starts[part.start]), int(ends[part.stop - 1])
        cuts = np.unique(np.concatenate([starts[part], ends[part]]))
        hashes, places = _words_of(content, low, high, cuts)
        words = scanner.look_up(hashes)
        first = np.searchsorted(places, starts[part])
        last = np.searchsorted(places, ends[part])
        stops = np.zeros(len(words), np.int64)
        for a, b in zip(first.tolist(), last.tolist()):
            stops[a:b] = b
        base: dict[int, list] = {}
        for start, label in scanner.places(words, stops):
            base.setdefault(int(stops[start]), []).append((start, label))
        # Runs of known words, cut at the ends of texts.
        known = words >= 0
        opened = known.copy()
        opened[1:] &= ~known[:-1]
        opened[first[first < len(words)]] = known[first[first < len(words)]]
        edges = np.flatnonzero(opened)
        closed = np.minimum(_run_ends(known, edges), stops[edges]) if len(edges) else edges
        long = closed - edges >= scanner.least
        edges, closed = edges[long], closed[long]
        at = np.searchsorted(edges, first)
        until = np.searchsorted(edges, last)
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist())):
            matches = []
            for k in range(at[i], until[i]):
                matches += scanner.spans(words[edges[k] : closed[k]], int(edges[k]) - a)
            shares = scanner.chained(matches)
            spans = sorted((s, e, label, share) for label, share, s, e in shares if share >= scanner.covered)
            own = sorted((start - a, label) for start, label in base.get(b, ())) if b > a else []
            base_labels = sorted({label for _, label in own})
            labels = sorted({*base_labels, *(label for _, _, label, _ in spans)})
            score = 1.0 if own else max((share for _, share, _, _ in shares), default=0.0)
            yield (
                part.start + i, b - a, len(own), own[0][0] if own else None, own[-1][0] if own else None,
                ",".join(base_labels), ",".join(labels), float(score), spans,
            )


def _run_ends(known: np.ndarray, edges: np.ndarray) -> np.ndarray:
    stops = np.append(np.flatnonzero(~known), len(known))
    return stops[np.searchsorted(stops, edges)]


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    with_spans: bool = True,
) -> DataFrame:
    """Per row: id, word and phrase counts, labels, score, and ``spans`` (start, end, label, share)."""
    schema = (
        "id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    ) + (", spans array<struct<start:long,end:long,label:string,share:double>>" if with_spans else "")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))
    types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64()] + [span] * with_spans
    names = [part.split()[0] for part in schema.split(", spans")[0].split(", ")] + ["spans"] * with_spans

    def scan(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for row, *values in scan_column(batch.column(1), scanner):
                *plain, spans = values
                shown = [{"start": s, "end": e, "label": label, "share": share} for s, e, label, share in spans]
                rows.append((ids[row], *plain) + ((shown,) if with_spans else ()))
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(scan, schema).withColumnRenamed("id", id_col)
