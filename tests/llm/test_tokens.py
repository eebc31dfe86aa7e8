"""Packing and the token store, against direct encoding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from rowcast.llm import token_index, tokens
from rowcast.llm.packing import cut_lengths, pack
from rowcast.llm.tokens import Encoder, vocabulary
from rowcast.plans.scratch import scratch_path

tokenizers = pytest.importorskip("tokenizers")

TEXTS = ["Hello, World! it's 42.", None, "", " \n", "É́ côte ﬁ  x\u0085y <|endoftext|>z", "a.b).c", "日本語 text's", "x" * 3000]


def plain(text):
    return tokenizers.Tokenizer.from_file(vocabulary()).encode(text or "", add_special_tokens=False).ids


def test_words_equal_whole_texts(monkeypatch):
    own = Encoder(vocabulary())
    draw = random.Random(2)
    texts = TEXTS + [" ".join("".join(draw.choice("abEé.,!'0 9)(") for _ in range(8)) for _ in range(40)) for _ in range(40)]
    for text, ids in zip(texts, own.encode_many([(t or "").encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text), text
    monkeypatch.setattr("rowcast.llm.tokens.SLICE", 50)
    monkeypatch.setattr("rowcast.llm.tokens.CACHE_WORDS", 5)
    for text in texts:
        assert np.frombuffer(own.encode((text or "").encode()), "<u4").tolist() == plain(text), text


def test_known_words_stay_known(monkeypatch):
    asked = []
    encoded = tokens._Words._encoded
    monkeypatch.setattr(tokens._Words, "_encoded", lambda self, word: asked.append(word) or encoded(self, word))
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    own = Encoder(vocabulary())
    text = "the cat sat on the mat"
    for i in range(300):
        for one in (text, f"rare{chr(97 + i % 26)}{chr(97 + i // 26)}"):
            assert np.frombuffer(own.encode(one.encode()), "<u4").tolist() == plain(one)
    assert asked.count(b"cat") == 1 and len(own.words) + len(own.words.recent) + len(own.words.older) <= 20
    # A mark after any letter is a group of its own.
    asked.clear()
    for text in ("café, naïveté! ÉTÉ.", "e\u0301, x\u0301. \u0301. ½, ²."):
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == plain(text)
    assert "café,".encode() not in asked and "café".encode() in asked


def test_keys_are_unpacked_once(spark):
    path = scratch_path(spark, "store")
    token_index.write_store(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id long, text string"), path, vocabulary())
    entries = token_index._entries(spark, path)
    assert "MapInArrow" not in entries._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.copy) for r in entries.collect()) == [(1, 0), (1, 1), (2, 0)]


def test_another_vocabulary_is_encoded_whole(spark):
    path = vocabulary("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    own = Encoder(path)
    assert own.words is None and Encoder(vocabulary()).words is not None
    texts = ["Hello world, this is a Test.", "", "  two  blanks\n", *[t or "" for t in TEXTS]]
    for text in texts:
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = pack(frame, path, with_ids=True).collect()
    for i, text in enumerate(texts):
        ids = b"".join(bytes(r.ids) for r in sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start))
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("length", [1, 2, 31, 33, 682, 683, 1024, 1025, 2047, 2048, 2049, 100_001])
def test_cuts(length):
    pieces = cut_lengths(length)
    assert sum(pieces) == length and min(pieces) > 0 and max(pieces) <= 2048


def test_packing(spark):
    draw = random.Random(1)
    rows = [(i, " ".join("w%d" % draw.randrange(99) for _ in range(draw.randrange(1500)))) for i in range(200)]
    rows += [(900 + i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (1, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"start": token_index.F.lit(1), "ids": token_index.F.lit("x")})
    got = pack(frame.coalesce(2), vocabulary(), with_ids=True).collect()
    sequences = defaultdict(list)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    for key, text in rows:
        if key != 1:
            own = sorted(pieces[key], key=lambda r: r.start)
            ids = [i for r in own for i in np.frombuffer(r.ids, "<u4").tolist()]
            assert ids == plain(text) + [1] and all(r.doc_tokens == len(ids) for r in own)
    total = sum(r.length for r in got)
    assert 1 - total / (2048 * len(sequences)) < 0.03
    assert pack(frame.limit(0), vocabulary()).count() == 0


def test_perfect_hash():
    draw = np.random.default_rng(4)
    for count in (0, 1, 2, 5000):
        first, second = (draw.integers(0, 2**63, count, dtype=np.int64).view(np.uint64) for _ in range(2))
        levels, slots = token_index.build_hash(first, second)
        assert sorted(slots.tolist()) == list(range(count))
        assert (token_index.find_slots(levels, first, second) == slots).all()
    with pytest.raises(ValueError):
        token_index.build_hash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_store(spark, monkeypatch):
    monkeypatch.setattr(token_index, "BLOCK_BYTES", 64)
    rows = [(i * 7 % 50, TEXTS[i % len(TEXTS)]) for i in range(50)] + [(None, "x"), (None, ""), (3, "again"), (3, "again"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for frame in (frame, frame.withColumn("copy", token_index.F.lit(1)).withColumn("shard", token_index.F.lit("s")), frame.limit(0)):
        path = scratch_path(spark, "store")
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        token_index.write_store(frame, path, vocabulary(), bucket_keys=8)
        got = sorted(token_index.read_by_key(spark, path, token_index.keys_of(frame), with_ids=True).collect(), key=lambda r: r.start)
        want = sorted(frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        assert [r.id for r in got] == [r.doc_id for r in want]
        start = 0
        for r in got:
            assert r.start == start and r.n_tokens * 4 == len(r.ids) and zlib.crc32(r.ids) == r.ids_crc32
            start += r.n_tokens
        ids = lambda t: np.array(plain(t) + [2], "<u4").tobytes()
        assert sorted((r.id or -1, bytes(r.ids)) for r in got) == sorted((r.doc_id or -1, ids(r.text)) for r in want)
    large = [(None, "a"), (7, "b"), (2**53 + 1, "c"), (2**53 + 3, "d"), (2**63 - 1, "e"), (-(2**63), "f"), (None, "g"), (0, "h")]
    path = scratch_path(spark, "large")
    frame = spark.createDataFrame(large, "doc_id long, text string")
    token_index.write_store(frame, path, vocabulary(), bucket_keys=100)
    got = token_index.read_by_key(spark, path, token_index.keys_of(frame), with_ids=True).collect()
    assert sorted((str(r.id), bytes(r.ids)) for r in got) == sorted((str(i), ids(t)) for i, t in large)
    path = scratch_path(spark, "store")
    token_index.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, vocabulary())
    strangers = spark.createDataFrame([(10**6 + i, 0) for i in range(500)] + [(3, 9)], "id long, copy long")
    assert token_index.locate(spark, path, strangers).count() == 0
