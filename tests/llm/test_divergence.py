"""Measures against plain counting, distances against their formula, verdicts on good and odd texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rowcast.llm import divergence

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, kept int"


def plain(text):
    """The base measures, counted one by one."""
    words = WORD.findall(text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if often[run] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e a b c d e", "a a a a a a a a a a a a", "A b c d e a b c d e f g h i j k l",
    "x\ny\nx\n \n \nx ", "é ü ß   漢字\x0b\x0c# $%", "line one two\nline one two\nline one two \n" * 4, "w" * 300, "a|b <c> *&",
]


@pytest.mark.parametrize("window", [16, 64, divergence.WINDOW])
def test_measures(window):
    draw = random.Random(window)
    texts = TEXTS + ["".join(draw.choice("ab \n#é\t") for _ in range(draw.randrange(400))) for _ in range(60)]
    column = pa.array(texts, pa.string())
    got = []
    for chunk in (column, column[7:40]):
        got = []
        for block in divergence.measured(chunk, window):
            got += list(zip(*(x.tolist() for x in (block.n_words, block.word_chars, block.n_symbols, block.n_dup_lines, block.n_repeat_words))))
        assert got == [plain(text)[:5] for text in chunk.to_pylist()]


def jensen_shannon(p, q):
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def corpus(count=60):
    draw = random.Random(3)
    common = {"en": ["the", "of", "and", "to"], "de": ["der", "und", "die", "zu"]}
    rows = []
    for i in range(count):
        lang = "en" if i % 2 else "de"
        rare = ["".join(draw.choice("abcdefgh" if lang == "en" else "mnopqrst") for _ in range(6)) for _ in range(90)]
        words = [draw.choice(common[lang]) if draw.random() < 0.4 else draw.choice(rare) for _ in range(150)]
        rows.append((i, " ".join(words).capitalize() + ".", lang, 7))
    return rows


def test_references_and_distances(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    known = divergence.fit_references(docs)
    assert known.languages == ["de", "en"]
    counted = Counter()
    for _, text, lang, _ in rows:
        for token in re.findall("[a-z]+", text.lower()):
            counted[lang, token] += 1
    for i, lang in enumerate(known.languages):
        total = sum(n for (own, _), n in counted.items() if own == lang)
        want = sorted(n / total for (own, _), n in counted.items() if own == lang and n >= total / 500)
        assert np.allclose(sorted(x for x in known.shares[i] if x), want)
    hashes = {}
    for token in {token for _, token in counted}:
        block = next(divergence.measured(pa.array([token])))
        hashes[int(block.tokens[0])] = token
    names = [hashes[int(x)] for x in known.words]
    texts = [rows[0][1], rows[1][1], "the the the", "zzz", "THE! of?"]
    block = next(divergence.measured(pa.array(texts)))
    chars, words = divergence.distances(block, known)
    for t, text in enumerate(texts):
        tokens = re.findall("[a-z]+", text.lower())
        own = [tokens.count(name) / len(tokens) for name in names]
        kinds = Counter("upper" if c.isupper() else "lower" if c.islower() else "blank" if c == " " else "shout" if c in "!?" else "mark" for c in text)
        share = [kinds[name] / len(text) for name in divergence.CLASSES]
        for i in range(2):
            q = known.shares[i].tolist()
            assert words[t, i] == pytest.approx(jensen_shannon([*own, 1 - sum(own)], [*q, 1 - sum(q)]), abs=1e-9)
            assert chars[t, i] == pytest.approx(jensen_shannon(share, known.classes[i]), abs=1e-9)


def test_verdicts(spark):
    good = corpus()
    loud = " ".join(f"{'QXYZ'[i % 4]}{i}!!" for i in range(150))
    listed = " | ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    odd = [(1000, loud, "en", 1), (1001, listed, "de", 1), (1002, None, None, 1), (1003, "", "en", 1), (1004, "short text", None, None)]
    odd += [(1005, "a few odd words that are too short to judge by", "xx", 1), (None, good[3][1], "en", 1), (3, good[3][1], "en", 1)]
    rows = good + odd
    out = divergence.judged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text, _, _ in rows:
        for r in by_id[doc_id]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text)
    kept = {doc_id: {r.kept for r in found} for doc_id, found in by_id.items()}
    assert all(kept[doc_id] == {True} for doc_id, *_ in good) and kept[None] == kept[1005] == {True}
    assert all(kept[i] == {False} for i in (1000, 1001, 1002, 1003, 1004))
    assert {r.nearest for r in by_id[2]} == {"de"} and {r.nearest for r in by_id[3]} == {"en"}


def test_empty_and_blank_corpora(spark):
    docs = spark.createDataFrame([(1, None, None, 0), (2, " ", "en", 0)], SCHEMA)
    assert divergence.judged(docs.limit(0)).count() == 0
    assert [(r.kept, r.word_distance) for r in divergence.judged(docs).collect()] == [(False, None)] * 2
