"""License scans: matching statistics and base phrases against brute force."""

from __future__ import annotations

import random
import re

import pyarrow as pa

from rowcast.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def test_statistics_equal_brute_force():
    draw = random.Random(1)
    texts = [[draw.randrange(3) for _ in range(draw.randrange(1, 12))] for _ in range(6)]
    automaton = L.SuffixAutomaton(texts)
    known = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    for _ in range(200):
        words = [draw.randrange(4) for _ in range(20)]
        for i, (size, state) in enumerate(automaton.statistics(words)):
            assert size == max(k for k in range(i + 2) if k == 0 or tuple(words[i - k + 1 : i + 1]) in known)
            run = words[i - size + 1 : i + 1]
            want = {(n, k) for n, t in enumerate(texts) for k in range(size - 1, len(t)) if t[k - size + 1 : k + 1] == run}
            if size:
                assert {(n, k) for n, places in automaton.ends[state].items() for k in places} == want


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    own = []
    for phrase, label in L.BASE_PHRASES.items():
        parts = phrase.split()
        own += [(k, label) for k in range(len(words) - len(parts) + 1) if words[k : k + len(parts)] == parts]
    own.sort()
    return len(words), len(own), own[0][0] if own else None, own[-1][0] if own else None, ",".join(sorted({x for _, x in own}))


TEXTS = [
    None, "", "...", "CC-BY", "cc", "by cc", "Under the MIT license. Apache_License; the mit-license", "x GNU General  Public\nLicense",
    "gnu general public", "all rights reserved", "é cc\tby ñ", "cc by cc by", "the apache", "license apache license",
]


def test_base_phrases_over_all_texts():
    draw = random.Random(5)
    parts = "gnu general public license apache cc by mit é Ünder the x1".split()
    texts = TEXTS + [" ".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(300)]
    rows = list(L.scan_column(pa.array(texts), L.Scanner()))
    assert [r[0] for r in rows] == list(range(len(texts)))
    for row, text in zip(rows, texts):
        assert row[1:6] == base(text), text
        assert set(filter(None, row[5].split(","))) <= set(filter(None, row[6].split(","))) and 0 <= row[7] <= 1


def test_templates_with_changes(monkeypatch):
    notice = L.TEMPLATES[6][1].split()
    del notice[9]
    notice.insert(5, "really")
    text = "code\n// " + "\n// ".join(notice) + "\nmore code of the project"
    row = next(L.scan_column(pa.array([text]), L.Scanner()))
    assert row[6] == "mit" and row[7] > 0.8
    start, end, label, share = row[8][0]
    words = WORD.findall(text.translate(LOWER))
    assert label == "mit" and words[start] == "permission" and words[end - 1] == "files"
    # Windows cut between words change nothing.
    monkeypatch.setattr(L, "WINDOW", 64)
    texts = TEXTS + [text]
    assert [r[1:] for r in L.scan_column(pa.array(texts), L.Scanner())][:-1] == [
        (*base(t), *r[6:]) for t, r in zip(TEXTS, L.scan_column(pa.array(texts), L.Scanner()))
    ]


def test_every_notice_has_a_span():
    """Copies apart and side by side, whole and changed; a run that stands twice in its template."""
    notice = L.TEMPLATES[6][1]
    words = notice.split()
    changed = " ".join(words[:8] + ["indeed"] + words[9:])
    text = f"start {notice} code code code code code code code {notice} {changed} " + "end " * 9 + notice
    row = next(L.scan_column(pa.array([text]), L.Scanner()))
    size = len(words)
    assert [(s, e) for s, e, *_ in row[8]] == [(1, 1 + size), (8 + size, 8 + 2 * size), (8 + 2 * size, 8 + 3 * size), (17 + 3 * size, 17 + 4 * size)]
    assert {label for _, _, label, _ in row[8]} == {"mit"} and row[8][2][3] < 1.0 == row[8][0][3]
    twice = L.Scanner(templates=[("t", "a b c x y a b c z w")], phrases={})
    found = next(L.scan_column(pa.array(["q a b c x y a b c z w q q q q q q q a b c z w"]), twice))
    assert found[8][0][:2] == (1, 11) and found[8][0][3] == 1.0
    many = next(L.scan_column(pa.array([(notice + " . word word word word word word word ") * 400]), L.Scanner()))
    assert len(many[8]) == 400 and all(share == 1.0 for *_, share in many[8])
    starts = [s for s, *_ in many[8]]
    assert starts == sorted(starts) and all(b - a == size + 7 for a, b in zip(starts, starts[1:]))


def test_tables(spark):
    frame = spark.createDataFrame([(1, "mit license", 1), (None, None, 2), (1, "mit license", 1)], "doc_id long, text string, labels int")
    rows = L.scan_licenses(frame).collect()
    assert [r.labels for r in rows] == ["mit", "", "mit"]
    assert L.scan_licenses(frame.limit(0)).count() == 0
