"""Prefix trie of conversations: one row per distinct run of first turns.

A turn is 128 bits of a SHA-256 over role and text, so a conversation is a
string of 16-byte letters. Equal strings are counted first, which takes copies
out at any number; distinct ones are sorted over ranges. Within a range every
two neighbours have an edge as deep as their common prefix. Edges are taken in
descending depth by union-find: a merge makes (or widens) the node at its depth,
and what hangs below it is final. The prefixes of a range's first and last
string may go on next door, so they stay open: a range is contracted to those
two spines, with what already hangs at each of their nodes, and the spines of
neighbouring ranges are merged along the common prefix at their boundary, again
by union-find. Only spines meet in that last step, a few rows a range.

Conversations longer than ``segment`` turns are cut there: the segments after a
common prefix form a trie of their own, whose totals go to the node it hangs
from. So neither a row nor a step holds a long conversation, and there is one
round for every ``segment`` turns of the longest.

Rows without a conversation id are left out; NULL roles and texts are empty.
Turns are ordered by number (NULL first), those of one number by role and then
by that hash; repeated rows are turns of their own. An empty table gives no
rows, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowcast.llm.common import small_side, stored

SEGMENT = 1024
# Turn numbers ordered by one task; counts of the stretches before it give the place.
STRETCH = 4096
RANGE_BYTES = 8 << 20
# Firsts of a hundred conversations, some 400 bytes each, that may be broadcast.
FIRSTS = 50_000
LETTER = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODE_COLUMNS = [part.split()[0] for part in NODE.split(", ")]
# What a range hands on: finished nodes, those that wait for an open parent, roots, spine nodes, and the range itself.
_FOREST = (
    f"kind string, part int, side int, level int, start string, tokens long, {NODE}, "
    "low_start string, low binary, high_start string, high binary, trunk int, above long"
)
_FOREST_COLUMNS = [part.split()[0] for part in _FOREST.split(", ")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_KINDS = [_ARROW[part.split()[1]] for part in _FOREST.split(", ")]


def numbered(conversations: DataFrame, *, conv: str, turn: str, role: str, text: str, stretch: int = STRETCH) -> DataFrame:
    """``(conv, place, print, chars)``: turns with their place from 0 in the conversation."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = conversations.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        said[0].alias("role"),
        F.substring(F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256), 1, 2 * LETTER).alias("print"),
        F.char_length(said[1]).cast("long").alias("chars"),
    ).filter("conv IS NOT NULL")
    turns = turns.withColumn("stretch", F.expr(f"turn div {stretch}"))
    before = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counted = turns.groupBy("conv", "stretch").agg(F.count(F.lit(1)).alias("n"))
    skipped = counted.select(F.col("conv").alias("_conv"), F.col("stretch").alias("_stretch"), F.sum("n").over(before).alias("skipped"))
    skipped = small_side(skipped.filter("skipped > 0"))
    within = Window.partitionBy("conv", "stretch").orderBy("turn", "role", "print")
    placed = turns.withColumn("place", F.row_number().over(within) - 1)
    # No turn before a conversation's first stretch, so one that is NULL never needs the join.
    same = (F.col("conv") == F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
    place = (F.coalesce("skipped", F.lit(0)) + F.col("place")).alias("place")
    return placed.join(skipped, same, "left").select("conv", place, "print", "chars")


def rebuilt(turns: DataFrame, *, group: int = 100, shared: int = 6) -> DataFrame:
    """Conversations that begin like the first of their hundred: ``(conv, place, print, chars)``.

    ``h`` (``crc32`` of the id modulo ``shared``) first turns come from
    conversation ``conv - conv % group``, the rest from the own ones after
    ``h``. A conversation without turns keeps one row with a NULL place.
    """
    turn = F.struct("place", "print", "chars")
    firsts = turns.filter((F.col("conv") % group == 0) & (F.col("place") < shared - 1))
    firsts = firsts.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("firsts"))
    own = turns.withColumn("base", F.col("conv") - F.col("conv") % group)
    own = own.withColumn("h", (F.crc32(F.col("conv").cast("string").cast("binary")) % shared).cast("int"))
    joined = own.join(small_side(firsts, FIRSTS), "base", "left")
    joined = joined.withColumn("taken", F.when(F.col("firsts").isNull(), 0).otherwise(F.least("h", F.size("firsts"))))
    nothing = F.array().cast("array<struct<place:bigint,print:string,chars:bigint>>")
    head = F.when((F.col("place") == 0) & (F.col("taken") > 0), F.slice("firsts", 1, F.greatest("taken", F.lit(1)))).otherwise(nothing)
    moved = F.struct((F.col("taken") + F.col("place") - F.col("h")).cast("long").alias("place"), "print", "chars")
    tail = F.when(F.col("place") >= F.col("h"), F.array(moved)).otherwise(nothing)
    every = F.concat(head, tail)
    return joined.filter((F.size(every) > 0) | (F.col("place") == 0)).select("conv", F.explode_outer(every).alias("turn")).select(
        "conv", "turn.place", "turn.print", "turn.chars"
    )


def _weight(at: int) -> Column:
    """Sixty bits of a segment and its number; their running sums tell prefixes apart."""
    whole = F.sha2(F.concat(F.encode(F.col("level").cast("string"), "UTF-8"), F.lit(b":"), F.col("prints")), 256)
    return F.conv(F.substring(whole, at, 15), 16, 10).cast("decimal(38,0)")


def segmented(turns: DataFrame, segment: int) -> DataFrame:
    """``(conv, level, start, prints, chars, next, ended)``: at most ``segment`` turns a row.

    ``start`` stands for all turns before, ``next`` for those and the row's own.
    """
    level = F.expr(f"int(coalesce(place, 0) div {segment})")
    turn = F.when(F.col("place").isNotNull(), F.struct("place", "print", "chars"))
    cut = turns.groupBy("conv", level.alias("level")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    cut = cut.select(
        "conv",
        "level",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["print"]), "")).alias("prints"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )
    cut = stored(cut, "segments")
    if not cut.filter("level > 0").limit(1).count():
        return cut.select("*", F.lit("").alias("start"), F.lit("-").alias("next"), F.lit(True).alias("ended"))
    order = Window.partitionBy("conv").orderBy("level")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(_weight(at)).over(running).cast("string") for at in (1, 16)]
    keyed = cut.withColumn("next", F.concat_ws("-", *sums))
    keyed = keyed.withColumn("start", F.coalesce(F.lag("next").over(order), F.lit("")))
    return stored(keyed.withColumn("ended", F.lead("level").over(order).isNull()), "keyed")


def _end_digests(segments: DataFrame) -> DataFrame:
    """``(key, ends)``: SHA-256 over the ids of the conversations that end in a segment, read in order, never gathered."""
    ended = segments.filter("ended").select(_segment_key().alias("key"), "conv")
    dealt = ended.repartition("key").sortWithinPartitions("key", "conv")

    def digest(batches):
        current, state = None, None
        for batch in batches:
            done = []
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = key, hashlib.sha256(b"%d" % conv)
                else:
                    state.update(b",%d" % conv)
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string())], ["key", "ends"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([state.hexdigest()])], ["key", "ends"])

    return dealt.mapInArrow(digest, "key string, ends string")


def _segment_key() -> Column:
    return F.sha2(F.concat(F.encode(F.concat(F.col("level").cast("string"), F.lit(":"), F.col("start"), F.lit(":")), "UTF-8"), F.col("prints")), 256)


def common_letters(a: bytes, b: bytes) -> int:
    """Whole letters that two strings begin with."""
    low, high = 0, min(len(a), len(b)) // LETTER
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * LETTER : middle * LETTER] == b[low * LETTER : middle * LETTER]:
            low = middle
        else:
            high = middle - 1
    return low


class _Tree:
    """A component: the node at ``top`` on the path of string ``row`` and what is known to hang at it."""

    __slots__ = ("top", "row", "n", "least", "children", "leaves", "saved", "ends", "waiting", "left", "right")

    def __init__(self, top, row, n, least, children, leaves, saved, ends, left, right):
        self.top, self.row, self.n, self.least = top, row, n, least
        self.children, self.leaves, self.saved, self.ends = children, leaves, saved, ends
        self.waiting, self.left, self.right = [], left, right


class _Range:
    """The forest of one sorted range of strings; ``rows`` gives what left it, as columns of ``_FOREST``."""

    def __init__(self, part: int, depth: int, strings: list):
        self.part, self.depth = part, depth
        self.start, self.prints, self.chars = (list(c) for c in zip(*[s[:3] for s in strings]))
        self.above = [s[9] for s in strings]
        self.nodes, self.rows = [], []
        last = len(strings) - 1
        self.parents = list(range(len(strings)))
        self.trees = [
            _Tree(len(s[1]) // LETTER, i, s[3], s[4], s[6] or 0, s[7] or 0, s[8] or 0, s[5], i == 0, i == last) for i, s in enumerate(strings)
        ]
        edges = []
        for i in range(last):
            if self.start[i] == self.start[i + 1]:
                edges.append((-common_letters(self.prints[i], self.prints[i + 1]), i))
        whole = len(edges) == last
        self.trunk = -max((e[0] for e in edges), default=-(len(self.prints[0]) // LETTER)) if whole else -1
        edges.sort()
        for depth, i in edges:
            self.join(i, i + 1, -depth)
        for i, parent in enumerate(self.parents):
            if i == parent:
                self.finish(self.trees[i])

    def find(self, i: int) -> int:
        while self.parents[i] != i:
            self.parents[i] = self.parents[self.parents[i]]
            i = self.parents[i]
        return i

    def join(self, i: int, j: int, depth: int) -> None:
        i, j = self.find(i), self.find(j)
        one, other = self.trees[i], self.trees[j]
        for tree in (one, other):
            if tree.top > depth:
                self.lift(tree, depth)
        if len(one.waiting) < len(other.waiting):
            i, j, one, other = j, i, other, one
        self.parents[j] = i
        one.n += other.n
        one.least = other.least if one.least is None else one.least if other.least is None else min(one.least, other.least)
        one.children += other.children
        one.leaves += other.leaves
        one.saved += other.saved
        one.ends = one.ends or other.ends
        one.waiting.extend(other.waiting)
        one.left |= other.left
        one.right |= other.right
        self.trees[j] = None

    def lift(self, tree: _Tree, depth: int) -> None:
        """Move the top up to ``depth``: nodes between are final, or open on a spine."""
        chars = self.chars[tree.row]
        if tree.left or tree.right:
            for level in range(tree.top, depth, -1):
                self.open(tree, level, chars[level - 1])
        else:
            for place in tree.waiting:
                self.nodes[place][2] = tree.least
            leaves, children, ends = tree.leaves if tree.children else 1, tree.children, tree.ends
            for level in range(tree.top, depth, -1):
                tree.saved += (tree.n - 1) * chars[level - 1]
                self.nodes.append(
                    [tree.least, self.depth + level, tree.least, tree.n, children, leaves, tree.saved, ends or NO_ENDS, None, None]
                )
                children, ends = 1, None
            tree.waiting, tree.children, tree.leaves, tree.ends = [len(self.nodes) - 1], 1, leaves, None
        tree.top = depth

    def open(self, tree: _Tree, level: int, tokens: int) -> None:
        """Record a spine node with what hangs at it, and leave the component bare."""
        side = 0 if tree.left else 1
        above = self.above[tree.row] if not level else None
        for place in tree.waiting:
            self.nodes[place][2] = above
            if above is None:
                self.nodes[place][8:] = side, level
        self.rows.append(
            {
                "kind": "open",
                "part": self.part,
                "side": side,
                "level": level,
                "start": self.start[tree.row],
                "tokens": tokens,
                "above": above,
                "conv_id": tree.least,
                "n_convs": tree.n,
                "n_children": tree.children,
                "n_leaves": tree.leaves,
                "saved_tokens": tree.saved,
                "ends_sha256": tree.ends,
            }
        )
        tree.waiting = []
        tree.n = tree.children = tree.leaves = tree.saved = 0
        tree.least = tree.ends = None

    def finish(self, tree: _Tree) -> None:
        if tree.top:
            self.lift(tree, 0)
        if tree.left or tree.right:
            self.open(tree, 0, 0)
            return
        for place in tree.waiting:
            self.nodes[place][2] = self.above[tree.row]
        self.rows.append(
            {"kind": "root", "start": self.start[tree.row], "n_children": tree.children, "n_leaves": tree.leaves, "saved_tokens": tree.saved}
        )

    def spines(self) -> list[dict]:
        """What is not a finished or waiting node: spine nodes, roots, and the range itself."""
        ends = {"low_start": self.start[0], "low": self.prints[0], "high_start": self.start[-1], "high": self.prints[-1]}
        return [*self.rows, {"kind": "range", "part": self.part, "trunk": self.trunk, "level": self.depth, **ends}]


def _batches(rows: list[dict], size: int = 10_000):
    """Rows as Arrow batches of ``_FOREST``; what a row does not name is NULL."""
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in part], k) for c, k in zip(_FOREST_COLUMNS, _KINDS)], _FOREST_COLUMNS)


def _node_batches(forest: _Range, size: int = 10_000):
    """The nodes of a range, finished ones and those that wait for a spine node."""
    for at in range(0, len(forest.nodes), size):
        columns = dict(zip([*NODE_COLUMNS, "side", "level"], zip(*forest.nodes[at : at + size])))
        count = len(columns["side"])
        columns["kind"] = ["node" if side is None else "waiting" for side in columns["side"]]
        columns["part"] = [forest.part] * count
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[c], k) if c in columns else pa.nulls(count, k) for c, k in zip(_FOREST_COLUMNS, _KINDS)], _FOREST_COLUMNS
        )


def merged_spines(rows: list[dict]) -> list[dict]:
    """Spine nodes of all ranges merged across their boundaries: nodes, roots and, for each spine node, its conversation.

    ``rows`` are the open nodes and ranges in any order. Neighbouring ranges
    share the nodes up to the common prefix of the last string of one and the
    first of the next; the classes are then summed up in descending depth.
    """
    ranges = sorted((r for r in rows if r["kind"] == "range"), key=lambda r: r["part"])
    nodes = {(r["part"], r["side"], r["level"]): r for r in rows if r["kind"] == "open"}
    parents = {key: key for key in nodes}

    def find(key):
        while parents[key] != key:
            parents[key] = parents[parents[key]]
            key = parents[key]
        return key

    trunk = {r["part"]: r["trunk"] for r in ranges}

    def right(part, level):
        return part, 0 if level <= trunk[part] else 1, level

    for one, other in zip(ranges, ranges[1:]):
        if one["high_start"] == other["low_start"]:
            for level in range(common_letters(one["high"], other["low"]), -1, -1):
                parents[find(right(one["part"], level))] = find((other["part"], 0, level))

    classes = {}
    for key, r in nodes.items():
        own = classes.setdefault(find(key), {"n": 0, "least": None, "children": 0, "leaves": 0, "saved": 0, "ends": None, "key": key})
        own["n"] += r["n_convs"]
        own["children"] += r["n_children"]
        own["leaves"] += r["n_leaves"]
        own["saved"] += r["saved_tokens"]
        own["ends"] = own["ends"] or r["ends_sha256"]
        if r["conv_id"] is not None:
            own["least"] = r["conv_id"] if own["least"] is None else min(own["least"], r["conv_id"])

    def above(key):
        part, side, level = key
        return find((part, 0, level - 1)) if side == 0 else find(right(part, level - 1))

    for own in sorted(classes.values(), key=lambda c: -c["key"][2]):
        own["all_leaves"] = own["leaves"] if own["children"] else 1
        own["all_saved"] = own["saved"] + (own["n"] - 1) * nodes[own["key"]]["tokens"]
        if own["key"][2]:
            up = classes[above(own["key"])]
            up["n"] += own["n"]
            up["children"] += 1
            up["leaves"] += own["all_leaves"]
            up["saved"] += own["all_saved"]
            if own["least"] is not None:
                up["least"] = own["least"] if up["least"] is None else min(up["least"], own["least"])

    start_depth = ranges[0]["level"] if ranges else 0
    above_of = {}
    out = []
    for r in rows:
        if r["kind"] == "open" and r["level"] == 0:
            above_of[find((r["part"], r["side"], 0))] = r["above"]
    for own in classes.values():
        level = own["key"][2]
        if not level and start_depth:
            out.append({"kind": "root", "start": nodes[own["key"]]["start"], "n_children": own["children"], "n_leaves": own["leaves"], "saved_tokens": own["saved"]})
            continue
        parent = None
        if level:
            up = above(own["key"])
            parent = classes[up]["least"] if level > 1 or not start_depth else above_of[up]
        out.append(
            {
                "kind": "node",
                "conv_id": own["least"],
                "depth": start_depth + level,
                "parent_conv_id": parent,
                "n_convs": own["n"],
                "n_children": own["children"],
                "n_leaves": own["all_leaves"],
                "saved_tokens": own["all_saved"],
                "ends_sha256": own["ends"] or NO_ENDS,
            }
        )
    for key in nodes:
        out.append({"kind": "spine", "part": key[0], "side": key[1], "level": key[2], "conv_id": classes[find(key)]["least"]})
    return out


def _forest(strings: DataFrame, ranges: int, depth: int) -> DataFrame:
    """The forest of each sorted range of one level's strings, as rows of ``_FOREST``."""
    wanted = ["start", "prints", "chars", "n", "least", "ends", "children", "leaves", "saved", "above"]
    dealt = strings.select(*wanted).repartitionByRange(ranges, "start", "prints").sortWithinPartitions("start", "prints")
    def grow(batches):
        strings = [row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(len(wanted))))]
        if strings:
            forest = _Range(TaskContext.get().partitionId(), depth, strings)
            yield from _node_batches(forest)
            yield from _batches(forest.spines())

    return dealt.mapInArrow(grow, _FOREST)


def _merge(forest: DataFrame) -> DataFrame:
    """The open spines of all ranges, merged by one task: a few rows a range."""
    names = ["kind", "part", "side", "level", "start", "tokens", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    names += ["low_start", "low", "high_start", "high", "trunk", "above"]

    def merge(batches):
        rows = [dict(zip(names, row)) for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(len(names))))]
        yield from _batches(merged_spines(rows))

    return forest.filter("kind IN ('open', 'range')").select(*names).repartition(1).mapInArrow(merge, _FOREST)


def trie(turns: DataFrame, *, segment: int = SEGMENT, ranges: int | None = None) -> DataFrame:
    """Every node of the prefix trie of ``turns`` (``conv, place, print, chars``; a NULL place for no turns).

    ``ranges`` is the least number of sorted ranges; by default the session's
    shuffle partitions. More are made where a range would exceed ``RANGE_BYTES``.
    """
    spark: SparkSession = turns.sparkSession
    segments = segmented(turns, segment)
    digests = _end_digests(segments)
    strings = segments.groupBy("level", "start", "prints", "next").agg(
        F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("least")
    )
    strings = stored(strings.withColumn("key", _segment_key()).join(digests, "key", "left").drop("key"), "strings")
    # One row a level.
    sizes = {r.level: r.bytes for r in strings.groupBy("level").agg(F.sum(F.octet_length("prints")).alias("bytes")).collect()}
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = spark.createDataFrame([], "next string, children long, leaves long, saved long")
    below, found = empty, []
    for level in sorted(sizes, reverse=True):
        own = strings.filter(F.col("level") == level).join(below, "next", "left")
        if level:
            hung = strings.filter(F.col("level") == level - 1).select(F.col("next").alias("start"), F.col("least").alias("above"))
            own = own.join(hung, "start", "left")
        else:
            own = own.withColumn("above", F.lit(None).cast("long"))
        forest = stored(_forest(own, max(ranges, -(-sizes[level] // RANGE_BYTES)), level * segment), "forest")
        spines = stored(_merge(forest), "spines")
        every = forest.unionByName(spines)
        heads = small_side(spines.filter("kind = 'spine'").select("part", "side", "level", F.col("conv_id").alias("head")))
        waiting = forest.filter("kind = 'waiting'").drop("parent_conv_id").join(heads, ["part", "side", "level"])
        found.append(every.filter("kind = 'node'").select(*NODE_COLUMNS))
        found.append(waiting.withColumnRenamed("head", "parent_conv_id").select(*NODE_COLUMNS))
        below = every.filter("kind = 'root'").select(
            F.col("start").alias("next"), F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")
        )
    if not found:
        return spark.createDataFrame([], NODE)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def conversation_trie(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    rebuild: bool = False,
    **options,
) -> DataFrame:
    """The prefix trie of ``conversations``; with ``rebuild`` after giving each the first turns of its hundred's first."""
    turns = numbered(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    if rebuild:
        turns = rebuilt(stored(turns, "turns"))
    return trie(turns, **options)


# DuckDB has no crc32: the table is made from its polynomial, then folded over the digits.
ORACLE = """
WITH crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS entry
), turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
               lambda a, b: xor(a >> 8, entry[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc
), moved AS (
    SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h
), rebuilt AS (
    SELECT c.conv_id, coalesce(list({'role': m.role, 'text': m.text} ORDER BY m.own, m.place) FILTER (m.own IS NOT NULL), []) AS said
    FROM convs c LEFT JOIN moved m USING (conv_id) GROUP BY c.conv_id
), member AS (
    SELECT conv_id, depth, said[:depth] AS path, len(said) = depth AS ended
    FROM rebuilt, LATERAL (SELECT unnest(range(len(said) + 1)) AS depth)
), node AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
    FROM member GROUP BY path, depth
), child AS (
    SELECT path[:-2] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children,
           CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.path[-1].text) END AS saved
    FROM node n LEFT JOIN child c ON n.path = c.path
), up AS (
    SELECT path[:above] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
    FROM counted, LATERAL (SELECT unnest(range(depth + 1)) AS above) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN up u ON u.path = n.path
LEFT JOIN node p ON n.depth > 0 AND p.path = n.path[:-2]
"""
