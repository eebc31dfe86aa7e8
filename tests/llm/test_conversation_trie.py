"""Tries against brute force: shared beginnings, copies, long conversations cut into segments, few and many ranges."""

from __future__ import annotations

import hashlib
import os
import random
import zlib

import pytest

from compare import connect, difference
from rowcast.llm import conversation_trie as ct
from rowcast.llm.queries import op11_prefix_trie

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, level int"


def ordered(rows):
    said = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            said.setdefault(conv, []).append((turn is not None, turn or 0, role or "", ct_print(role, text), text or ""))
    return {conv: [(t[2], t[4]) for t in sorted(turns)] for conv, turns in said.items()}


def ct_print(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def rebuilt(said):
    out = {}
    for conv, own in said.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = said.get(conv - int(abs(conv) % 100 * (1 if conv >= 0 else -1)), [])
        out[conv] = base[:h] + own[h:]
    return out


def brute(said):
    nodes = {}
    for conv, turns in said.items():
        for depth in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:depth]), []).append(conv)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[b] for b in below) or 1
        saved[path] = sum(saved[b] for b in below) + ((len(nodes[path]) - 1) * len(path[-1][1]) if path else 0)
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(said[c]) == len(path))
        out.append(
            (
                min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children.get(path, [])),
                leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r[c] for c in ct.NODE_COLUMNS) for r in frame.collect()), key=str)


def talks(draw, count, longest, words):
    rows = []
    for conv in range(count):
        rows += [(conv, turn, draw.choice(["user", "bot"]), draw.choice(words), 1) for turn in range(draw.randrange(1, longest))]
    return rows


@pytest.mark.parametrize("segment,ranges", [(1024, 1), (1024, 40), (8, 5), (3, 12)])
def test_tries(spark, segment, ranges):
    draw = random.Random(segment * 100 + ranges)
    rows = talks(draw, 150, 9, ["é", "bb", ""])
    rows += [(200 + i, t, "user", "same", 1) for i in range(40) for t in range(5)]
    rows += [(300, t, "user", "x", 1) for t in range(30)] + [(301, t, "user", "x" if t < 29 else "y", 1) for t in range(35)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    turns = ct.numbered(frame, conv="conv_id", turn="turn", role="role", text="text", stretch=4)
    assert got(ct.trie(turns, segment=segment, ranges=ranges)) == brute(ordered(rows))


@pytest.mark.parametrize("segment", [5, 1024])
def test_odd_rows(spark, tmp_path, segment, monkeypatch):
    monkeypatch.setattr(ct.trie, "__kwdefaults__", {"segment": segment, "ranges": None})
    draw = random.Random(5)
    rows = talks(draw, 260, 8, ["a", "b"])
    rows += [(7, None, None, None, 1), (7, None, None, "z", 1), (7, 3, "user", "tie", 1), (7, 3, "bot", "tie", 1), (7, 3, "bot", "tie", 1)]
    rows += [(None, 0, "user", "lost", 1), (990, 0, "user", "alone", 1), (-105, 0, "u", "minus", 1), (-100, 0, "u", "minus", 1)]
    rows += [(1000, t, "user", "w" * 50, None) for t in range(6)] + [(1000 + i, 0, "user", "short", None) for i in range(1, 100)]
    rows += rows[:5]
    path = f"{tmp_path}/t"
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/conversations.parquet")
    assert got(op11_prefix_trie(spark, path)) == brute(rebuilt(ordered(rows)))


def test_empty(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame([(None, 1, "a", "b", 1)], SCHEMA).write.parquet(f"{path}/conversations.parquet")
    assert op11_prefix_trie(spark, path).collect() == []


def test_a_hot_beginning_and_copies(spark):
    rows = [(c, t, "user", "hello" if t < 2 else f"{c % 7} {t}", 1) for c in range(600) for t in range(4)]
    rows += [(10_000 + c, t, "user", "copy", 1) for c in range(400) for t in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(ct.conversation_trie(frame)) == brute(ordered(rows))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")
def test_sql(spark):
    assert difference(op11_prefix_trie(spark, FOLDER), connect(FOLDER), ct.ORACLE) is None
