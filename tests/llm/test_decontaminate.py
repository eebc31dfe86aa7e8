"""Benchmark items in documents, against brute force."""

from __future__ import annotations

import random

from rowcast.llm.decontaminate import clean_rows, contained_items

WORDS = [f"w{i}" for i in range(3000)]


def runs(text, width):
    words = [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}, len(words)


def brute(docs, items):
    """One entry for every row of ``docs`` and item it holds."""
    out = {}
    for item, text in items:
        count = runs(text, 5)[1]
        if item is None or not count:
            continue
        width = min(5, count)
        own = runs(text, width)[0]
        for row, (_, body) in enumerate(docs):
            both = len(own & runs(body, width)[0])
            if 100 * both >= 75 * len(own):
                best = out.get((row, item))
                if best is None or (both / len(own), len(own)) > (best[1] / best[0], best[0]):
                    out[row, item] = (len(own), both)
    return sorted(((docs[row][0], item, *value) for (row, item), value in out.items()), key=str)


def test_whole_partial_and_short_items(spark):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice(WORDS) for _ in range(n))
    items = [(i, text(draw.randrange(5, 50))) for i in range(12)] + [(90, "alpha beta"), (91, "Gamma"), (92, ""), (93, None), (None, text(9)), (94, text(20)), (94, text(8))]
    docs = []
    for i in range(60):
        item = draw.choice([t for _, t in items if t]).split()
        cut = draw.randrange(0, max(1, len(item) // 3))
        body = [text(draw.randrange(0, 30)), " ".join(item[cut:]).title().replace(" ", ", "), text(draw.randrange(0, 300))]
        docs.append((i, ".\n".join(body)))
    docs += [(100, None), (101, ""), (102, "alpha, BETA"), (None, items[0][1]), (103, items[0][1]), (103, items[0][1]), (104, "gamma")]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in contained_items(left, right).collect()), key=str)
    assert got == brute(docs, items)
    assert len(got) > 30 and any(r[0] is None for r in got)
    dirty = {row for row in range(len(docs)) if brute([docs[row]], items)}
    kept = clean_rows(left, right)
    assert kept.columns == ["doc_id", "text"]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((d for row, d in enumerate(docs) if row not in dirty), key=str)


def test_rows_of_one_id_do_not_add_up(spark):
    words = [f"x{i}" for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    halves = [(7, " ".join(words[:22])), (7, " ".join(words[18:])), (8, " ".join(words[:36])), (8, "clean text of the same id as a dirty one")]
    docs = spark.createDataFrame(halves, "doc_id long, text string")
    assert [tuple(r) for r in contained_items(docs, items).collect()] == [(8, 1, 36, 32)]
    assert sorted(r.text for r in clean_rows(docs, items).collect()) == sorted(t for i, t in halves if t != halves[2][1])


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 1, 2)], "doc_id long, text string, item_id long, words long")
    items = spark.createDataFrame([(7, "b c d e f", 1, 2)], "item_id long, text string, doc_id long, key long")
    assert [tuple(r) for r in contained_items(docs, items).collect()] == [(1, 7, 1, 1)]
    assert contained_items(docs.limit(0), items).count() == 0
    none = contained_items(docs, items.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "item_id", "n_item", "n_shared"]


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "b c d e f")], "item_id long, text string")
    plan = contained_items(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
