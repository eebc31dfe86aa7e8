"""Near-duplicates against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rowcast.llm.components import components
from rowcast.llm.near_dedup import near_duplicates
from rowcast.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = {}
    for key, text in rows:
        sets.setdefault(key, []).append(shingles(text))
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            for x in sets[a]:
                for y in sets[b]:
                    if x and y and 100 * len(x & y) >= 75 * len(x | y):
                        one, two = sorted((find(a), find(b)))
                        root[two] = one
    return {key: find(key) for key in keys}


def check(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(frame, **options).collect()
    want = brute([row for row in rows if row[0] is not None])
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert row.component_id == want[row.doc_id], row
            assert row.kept == (row.doc_id == row.component_id)
    assert Counter(r.n_shingles for r in got) == Counter(len(shingles(t)) for _, t in rows)


def family(draw, base, copies, edits, first):
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(draw.randrange(edits + 1)):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
        rows.append((first + i, " ".join(words)))
    return rows


def test_families_passages_and_edges(spark):
    draw = random.Random(7)
    word = lambda: f"w{draw.randrange(4000)}"
    passage = [word() for _ in range(40)]
    rows = []
    for f in range(6):
        rows += family(draw, [word() for _ in range(90)], 15, 6, 1000 * f)
    rows += [(9000 + i, " ".join(passage + [word() for _ in range(40)])) for i in range(60)]
    rows += [(9900 + i, " ".join(passage)) for i in range(5)]
    rows += [(20, None), (21, ""), (22, " \t\n"), (23, "One two"), (24, "one TWO"), (25, "one two three"), (None, "x"), (None, None)]
    rows += [(9000, rows[90][1]), (0, rows[0][1])]
    draw.shuffle(rows)
    # Short lists and blocks of any length give the same.
    check(spark, rows)
    check(spark, rows, short_list=2, block=7)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    clash = spark.createDataFrame([(1, "a b c d e f", 5, "x", 1), (2, "a b c d e f", 5, "y", 2)], "doc_id long, text string, n int, id string, component long")
    assert {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(clash).collect()} == {(1, 1, True), (2, 1, False)}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(5, 6), (6, 5), (8, 9), (None, 1)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in root and b in root and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root


def _template(draw, count, shared, own):
    """Texts with a common template and a part of their own; similarity about shared / (shared + 2 * own)."""
    base = [f"t{k}" for k in range(shared)]
    return [" ".join(base + [f"o{draw.randrange(10**9)}" for _ in range(own)]) for _ in range(count)]


def test_a_common_template_below_the_bound_meets_nowhere(spark, monkeypatch):
    """All texts have one hub and none is linked: nothing is dealt into blocks, and pairs of true copies are still found."""
    from rowcast.llm import near_dedup

    draw = random.Random(11)
    texts = _template(draw, 300, 164, 36)
    dealt = []
    whole = near_dedup._in_blocks
    monkeypatch.setattr(near_dedup, "_in_blocks", lambda placed, share, block: dealt.append(placed.count()) or whole(placed, share, block))
    rows = list(enumerate(texts))
    check(spark, rows)
    assert dealt == [0]
    # Each text once more with a few changes: the copies share rare shingles, so lists stay short.
    copies = [(1000 + i, text.replace(" t20 ", f" c{i} ")) for i, text in enumerate(texts[:150])]
    check(spark, rows[:150] + copies)
    assert dealt == [0, 0]


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_components_of_long_chains_and_stars_in_few_tables(spark, monkeypatch, few):
    """Rounds don't follow the length of a chain of nodes named in no order, and a round is one table."""
    from rowcast.llm import components as module

    written = []
    whole = module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or whole(df, name))
    monkeypatch.setattr(module, "BROADCAST_ROWS", few, raising=False)
    draw = random.Random(5)
    names = draw.sample(range(10**6), 400)
    chain = list(zip(names[:200], names[1:200]))
    stars = [(names[200 + i // 40 * 40], names[200 + i]) for i in range(200)]
    got = {r.node: r.component for r in module.components(spark.createDataFrame(chain + stars, "a long, b long")).collect()}
    groups = [names[:200], *(names[k : k + 40] for k in range(200, 400, 40))]
    assert got == {x: min(group) for group in groups for x in group}
    assert len(written) <= 10, written


def test_tables_written(spark, monkeypatch):
    """A pass over a small corpus is mostly the fixed cost of its tables."""
    from rowcast.llm import components as module
    from rowcast.llm import near_dedup

    written = []
    for place in (near_dedup, module):
        monkeypatch.setattr(place, "stored", lambda df, name, whole=place.stored: written.append(name) or whole(df, name))
    draw = random.Random(3)
    rows = []
    for f in range(4):
        rows += family(draw, [f"w{draw.randrange(4000)}" for _ in range(90)], 15, 6, 1000 * f)
    check(spark, rows + [(9000 + i, text) for i, (_, text) in enumerate(rows[:20])])
    assert len(written) <= 34, written


def test_sets_take_little_memory_and_are_the_same_at_any_window():
    draw = random.Random(4)
    words = [f"word{i}" for i in range(3000)]
    texts = [" ".join(draw.choices(words, k=n)) for n in [8000] * 80 + [400_000, 3, 0]]
    column = pa.array([*texts, None])

    def sets(window):
        kept = []
        for _, hashes, bounds in shingle_sets(column, *window):
            kept += [hashes[a:b].sum().item() for a, b in zip(bounds[:-1], bounds[1:])]
        return kept

    shingle_sets.__globals__["_POWERS"][:] = [np.ones(1, dtype=np.uint64)] * 2
    tracemalloc.start()
    own = sets(())
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    assert own == sets((16 << 20,)) and len(own) == 84 and own[-2:] == [0, 0]
    assert peak < 96, peak
