"""The line model: marginals by enumeration, slopes, held-out accuracy, odd texts."""

from __future__ import annotations

import itertools
import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from rowcast.llm.line_crf import FEATURES, fit_quality, graded, line_features, marginals, quality_scores

FOLDER = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(1)
    bounds = np.array([0, 4, 4, 5, 8])
    unary, pair = draw.normal(size=8), draw.normal(size=(2, 2))
    good, expected, total = marginals(unary, pair, bounds)
    want, pairs, logs = np.zeros(8), np.zeros((2, 2)), 0.0
    for a, b in zip(bounds[:-1], bounds[1:]):
        weights = {}
        for labels in itertools.product((0, 1), repeat=b - a):
            value = sum(unary[a + i] for i, y in enumerate(labels) if y) + sum(pair[x, y] for x, y in zip(labels, labels[1:]))
            weights[labels] = np.exp(value)
        whole = sum(weights.values())
        if b > a:
            logs += np.log(whole)
        for labels, weight in weights.items():
            for i, y in enumerate(labels):
                want[a + i] += y * weight / whole
            for x, y in zip(labels, labels[1:]):
                pairs[x, y] += weight / whole
    assert np.allclose(good, want) and np.allclose(expected, pairs) and np.isclose(total, logs)


def test_windows_and_odd_texts():
    texts = ["One line.\n\nTwo | bars | here\n", None, "", "\n \n", "x", "A" * 100 + "\n" + "b b b b b"]
    parts = list(line_features(pa.array(texts)))
    counts = np.concatenate([np.diff(bounds) for _, bounds, _, _ in parts])
    assert counts.tolist() == [2, 0, 0, 0, 1, 2]
    assert all(f.shape[1] == FEATURES and np.isfinite(f).all() for _, _, _, f in parts)


def _features(texts, window):
    """Per text its lines' lengths and features, whatever groups they come in."""
    out = []
    for _, bounds, length, features in line_features(pa.array(texts), window):
        out += [(length[a:b].tolist(), features[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def test_a_line_is_one_node_at_any_window():
    draw = np.random.default_rng(7)
    signs = np.array(list("aB1 .|!\n\té") + ["the ", "the the ", "word "])
    texts = ["".join(draw.choice(signs, size)) for size in draw.integers(0, 400, 60)]
    texts += ["word word " * 60 + "end.", "a" * 500 + "\n" + "b " * 300, "x " * 200 + "\n\n" + " " * 300 + "\n.", None, "", "Q" * 64 + "\n" + "z" * 63 + "\n"]
    want = _features(texts, 1 << 22)
    for window in (1, 16, 64, 250):
        assert _features(texts, window) == want


def test_features_take_little_memory():
    texts = pa.array(["Some words of a line, and | signs.\n" * 3000] * 80)
    tracemalloc.start()
    lines = sum(len(length) for _, _, length, _ in line_features(texts))
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    assert lines == 240_000
    assert peak < 96, peak


def test_a_line_of_nine_megabytes_scores_alike():
    text = "Good long line, with the usual words. " * 250_000 + "\nshort"
    wide, narrow = _features([text], 4 << 20), _features([text], 64 << 10)
    assert len(wide[0][0]) == 2 and wide == narrow


def test_tables(spark):
    docs = spark.createDataFrame([(1, "good text.\nhere", 5.0), (2, None, 1.0), (None, "", 1.0), (2, "\n\n", 2.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = graded(docs, labels).collect()
    assert [r.score for r in rows] == [0.5] * 4 and [r.predicted for r in rows] == [1] * 4
    assert graded(docs.limit(0), labels).count() == 0
    one_kind = spark.createDataFrame([(1, 1, None), (1, 1, None), (None, 0, None), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in graded(docs, one_kind).collect())
    assert quality_scores(docs, fit_quality(docs, one_kind)).columns == ["doc_id", "text", "score"]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    rows = graded(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)


def test_sample_is_bounded_by_rows(spark, monkeypatch):
    own = [(i, f"Plain words of text {i}.\n" + "A further line. " * n) for i in range(8) for n in range(40)]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(own * 2, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    sizes, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: (sizes.append(len(out := collect(self))), out)[1])
    model = fit_quality(docs, labels, train_docs=4)
    assert sizes and max(sizes) <= 4
    assert (model.scale, model.shift) == (lambda m: (m.scale, m.shift))(fit_quality(spark.createDataFrame(own, schema), labels, train_docs=4))
