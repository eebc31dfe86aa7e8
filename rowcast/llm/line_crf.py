"""Document quality from a linear-chain conditional random field over lines.

Every non-empty line is a node, labelled good or bad. Its features describe
the line (length, letter case, digits, symbols, separators, repeated words)
and the same of the lines before and after it; neighbouring labels have
weights of their own. Forward-backward gives each line's probability of being
good; their mean, weighted by line length, goes through a logistic curve and
is the document's score.

There are no labels of lines. Lines start with the label of their document;
after a first fit, lines of bad documents that look good to the model are
relabelled (one stays bad), and it is fitted again. The fit uses a bounded
sample of labelled documents: the ``train_docs`` first in the order of
``md5(id)``, of at most ``train_lines`` lines each. It runs on the driver on
features alone; scoring runs in the tasks and covers every text whole.

NULL and empty texts, and texts of line breaks only, get the share of good
documents in the sample. Without labels of both kinds every document gets
that share, counted with one good and one bad document more. Lines above
4 MB are cut into several. Repeated rows and NULL ids are scored as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.shingles import SMALL_WINDOW, byte_view, groups, word_hashes

TRAIN_DOCS = 4000
TRAIN_LINES = 256
ROUNDS = 2
PENALTY = 1.0
THRESHOLD = 0.3

_LETTER_LOW, _LETTER_UP, _DIGIT, _SPACE, _STOP, _SHOUT, _BAR, _SYMBOL = range(8)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _SYMBOL, np.uint8)
    kinds[97:123], kinds[128:], kinds[65:91], kinds[48:58] = _LETTER_LOW, _LETTER_LOW, _LETTER_UP, _DIGIT
    kinds[[32, 9, 10, 11, 12, 13]] = _SPACE
    kinds[list(b".,;:'\"()-")] = _STOP
    kinds[list(b"!?")] = _SHOUT
    kinds[list(b"|")] = _BAR
    return kinds


_CLASSES = _byte_classes()
_OWN = 16
# Of these, the values of the lines before and after count as well.
_SHARED = [3, 5, 6, 7, 8, 11]
FEATURES = _OWN + 2 * len(_SHARED) + 2


class _Lines:
    """Counts of the lines of a window; a line that goes on in the next window is added up there."""

    def __init__(self, content: np.ndarray, breaks: np.ndarray, base: int):
        ends = np.union1d(np.flatnonzero(content == 10) + 1, breaks)
        starts = np.union1d([0], ends[ends < len(content)]).astype(np.int64)
        kinds = _CLASSES[content]
        self.starts = starts + base
        self.counts = np.stack([np.add.reduceat(kinds == kind, starts, dtype=np.int64) for kind in range(8)], axis=1)
        hashes, places = word_hashes(content, breaks)
        line = np.searchsorted(starts, places, "right") - 1
        self.words = np.bincount(line, minlength=len(starts))
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        self.repeats = np.bincount(line[again], minlength=len(starts))
        stops = np.append(starts[1:], len(content)) - 1
        broken = content[stops] == 10
        self.last = content[np.where(broken & (stops > starts), stops - 1, stops)]
        self.bare = broken & (stops == starts)
        self.first = _CLASSES[content[starts]]
        # The first word of the first line and the last of the last, to see a repeat across the cut.
        self.head = hashes[0] if len(hashes) and line[0] == 0 else None
        self.tail = hashes[-1] if len(hashes) and line[-1] == len(starts) - 1 else None

    def carry(self, after: "_Lines") -> None:
        """Add the first line of ``after`` to the last one here, and take it out there."""
        self.counts[-1] += after.counts[0]
        self.words[-1] += after.words[0]
        self.repeats[-1] += after.repeats[0] + (self.tail is not None and self.tail == after.head)
        # A break alone ends the line with the byte before it.
        if not after.bare[0]:
            self.last[-1] = after.last[0]
        whole = len(after.starts) == 1
        if whole and after.tail is not None:
            self.tail = after.tail
        for name in ("starts", "counts", "words", "repeats", "last", "bare", "first"):
            setattr(after, name, getattr(after, name)[1:])

    def values(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, byte lengths and own features of the lines that hold more than blanks."""
        length = self.counts.sum(axis=1)
        full = length > self.counts[:, _SPACE]
        starts, length, counts = self.starts[full], length[full], self.counts[full]
        words, repeats, last, first = self.words[full], self.repeats[full], self.last[full], self.first[full]
        seen = np.maximum(length - counts[:, _SPACE], 1)
        letters = np.maximum(counts[:, _LETTER_LOW] + counts[:, _LETTER_UP], 1)
        some = np.maximum(words, 1)
        values = np.zeros((len(starts), _OWN))
        values[:, 0] = 1
        values[:, 1] = np.log1p(length) / 8
        values[:, 2] = np.log1p(words) / 6
        values[:, 3] = counts[:, _LETTER_UP] / letters
        values[:, 4] = np.minimum(1, 4 * counts[:, _DIGIT] / seen)
        values[:, 5] = np.minimum(1, 4 * counts[:, _SYMBOL] / seen)
        values[:, 6] = np.minimum(1, 2 * counts[:, _BAR] / some)
        values[:, 7] = np.minimum(1, 2 * counts[:, _SHOUT] / some)
        values[:, 8] = np.minimum(1, 2 * repeats / some)
        values[:, 9] = np.minimum(2, seen / some / 10)
        values[:, 10] = counts[:, _STOP] / some
        values[:, 11] = values[:, 3] > 0.6
        values[:, 12] = values[:, 8] > 0.5
        values[:, 13] = last == 46
        values[:, 14] = first == _LETTER_UP
        values[:, 15] = words < 3
        return starts, length, values


def _window_end(content: np.ndarray, at: int, high: int, window: int) -> int:
    """Where a window from ``at`` is cut: after its last line break, else after its last blank, else it grows."""
    end = min(at + window, high)
    while end < high:
        breaks = np.flatnonzero(content[at:end] == 10)
        if not len(breaks):
            breaks = np.flatnonzero(_CLASSES[content[at:end]] == _SPACE)
        if len(breaks):
            return at + int(breaks[-1]) + 1
        end = min(end + window, high)
    return end


def line_features(column: pa.Array, window: int = SMALL_WINDOW) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Per group of texts: which texts, bounds of their lines, byte lengths, features.

    A line is one node however long it is: its counts are added up over the windows.
    """
    content, begins, ends = byte_view(column)
    for part in groups(begins, ends, window):
        low, high = int(begins[part.start]), int(ends[part.stop - 1])
        edges = np.concatenate([begins[part], ends[part]])
        found, held, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, _OWN)))], None, low
        while at < high:
            end = _window_end(content, at, high, window)
            cuts = np.unique(edges[(edges >= at) & (edges < end)]) - at
            lines = _Lines(content[at:end], cuts, at)
            if held is not None and content[at - 1] != 10 and not (len(cuts) and cuts[0] == 0):
                held.carry(lines)
            if len(lines.starts):
                if held is not None:
                    found.append(held.values())
                held = lines
            at = end
        if held is not None:
            found.append(held.values())
        starts, length, own = (np.concatenate(one) for one in zip(*found))
        bounds = np.append(np.searchsorted(starts, begins[part]), len(starts))
        # Texts without lines have equal bounds.
        bounds = np.maximum.accumulate(bounds)
        yield part, bounds, length, _with_neighbours(own, bounds)


def _with_neighbours(own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros((len(own), FEATURES))
    out[:, :_OWN] = own
    wide = len(_SHARED)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    first, last = bounds[:-1][full], bounds[1:][full] - 1
    out[1:, _OWN : _OWN + wide] = own[:-1, _SHARED]
    out[first, _OWN : _OWN + wide] = 0
    out[:-1, _OWN + wide : _OWN + 2 * wide] = own[1:, _SHARED]
    out[last, _OWN + wide : _OWN + 2 * wide] = 0
    out[first, -2] = 1
    out[last, -1] = 1
    return out


def marginals(unary: np.ndarray, pair: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of label 1 per line, expected label pairs, sum of log partition values.

    ``unary`` is the score of label 1 against 0, ``pair[x, y]`` the score of
    label ``x`` followed by ``y``. All chains go step by step together.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")  # chains longer than t
    ahead, back = np.zeros((len(unary), 2)), np.zeros((len(unary), 2))
    for t in range(longest):
        at = begin[: active[t]] + t
        if t:
            before = ahead[at - 1]
            ahead[at, 0] = np.logaddexp(before[:, 0] + pair[0, 0], before[:, 1] + pair[1, 0])
            ahead[at, 1] = np.logaddexp(before[:, 0] + pair[0, 1], before[:, 1] + pair[1, 1])
        ahead[at, 1] += unary[at]
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        after = back[at + 1].copy()
        after[:, 1] += unary[at + 1]
        back[at, 0] = np.logaddexp(pair[0, 0] + after[:, 0], pair[0, 1] + after[:, 1])
        back[at, 1] = np.logaddexp(pair[1, 0] + after[:, 0], pair[1, 1] + after[:, 1])
    whole = np.logaddexp(ahead[:, 0] + back[:, 0], ahead[:, 1] + back[:, 1])
    good = np.exp(ahead[:, 1] + back[:, 1] - whole)
    inner = np.ones(len(unary), bool)
    inner[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
    to = np.flatnonzero(inner)
    expected = np.zeros((2, 2))
    for x in (0, 1):
        for y in (0, 1):
            expected[x, y] = np.exp(ahead[to - 1, x] + pair[x, y] + y * unary[to] + back[to, y] - whole[to]).sum()
    ends = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    return good, expected, float(whole[ends].sum())


def _minimum(loss, start: np.ndarray, steps: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking."""
    point, past = start, []
    value, slope = loss(point)
    for _ in range(steps):
        way = slope.copy()
        shares = []
        for move, turn in reversed(past):
            shares.append((move @ way) / (move @ turn))
            way -= shares[-1] * turn
        if past:
            way *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        else:
            way /= max(1.0, float(np.abs(way).sum()))
        for (move, turn), share in zip(past, reversed(shares)):
            way += (share - (turn @ way) / (move @ turn)) * move
        size, gain = 1.0, float(slope @ way)
        for _ in range(30):
            other = point - size * way
            less, next_slope = loss(other)
            if less <= value - 1e-4 * size * gain:
                break
            size /= 2
        else:
            break
        move, turn = other - point, next_slope - slope
        if move @ turn > 1e-12:
            past = [*past[-memory + 1 :], (move, turn)]
        done = value - less < 1e-6 * abs(value)
        point, value, slope = other, less, next_slope
        if done:
            break
    return point


@dataclass
class LineModel:
    """Weights of line features, of label pairs, and of the curve from mean to score."""

    weights: np.ndarray
    pair: np.ndarray
    scale: float
    shift: float
    prior: float

    def means(self, features: np.ndarray, bounds: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Length-weighted mean probability of good lines; NaN without lines."""
        good, _, _ = marginals(features @ self.weights, self.pair, bounds)
        out = np.full(len(bounds) - 1, np.nan)
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        if len(full):
            weight = np.add.reduceat(length.astype(float), bounds[:-1][full])
            out[full] = np.add.reduceat(good * length, bounds[:-1][full]) / weight
        return out

    def scores(self, features: np.ndarray, bounds: np.ndarray, length: np.ndarray) -> np.ndarray:
        means = self.means(features, bounds, length)
        score = 1 / (1 + np.exp(-np.clip(self.scale * _logit(means) + self.shift, -30, 30)))
        return np.where(np.isnan(means), self.prior, score)


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 0.005, 0.995)
    return np.log(share / (1 - share))


def fit_lines(features: np.ndarray, bounds: np.ndarray, length: np.ndarray, labels: np.ndarray) -> LineModel:
    """A model from documents' lines and the documents' labels."""
    prior = (labels.sum() + 1) / (len(labels) + 2)
    if not len(features) or labels.min() == labels.max():
        return LineModel(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, float(np.log(prior / (1 - prior))), float(prior))
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(labels)), sizes)
    # Both kinds of documents weigh alike, and long ones no more than short ones.
    given = labels[owner].astype(float)
    target = given.copy()
    inner = np.ones(len(features), bool)
    inner[bounds[:-1][sizes > 0]] = False
    to = np.flatnonzero(inner)
    start = np.zeros(FEATURES + 4)
    for step in range(ROUNDS):
        seen = np.zeros((2, 2))
        np.add.at(seen, (target[to - 1].astype(int), target[to].astype(int)), 1)

        def loss(point, target=target, seen=seen):
            weights, pair = point[:FEATURES], point[FEATURES:].reshape(2, 2)
            unary = features @ weights
            good, expected, total = marginals(unary, pair, bounds)
            value = total - unary @ target - (pair * seen).sum() + PENALTY * (point @ point) / 2
            slope = np.concatenate([features.T @ (good - target), (expected - seen).ravel()]) + PENALTY * point
            return value, slope

        start = _minimum(loss, start)
        weights, pair = start[:FEATURES], start[FEATURES:].reshape(2, 2)
        if step + 1 < ROUNDS:
            good, _, _ = marginals(features @ weights, pair, bounds)
            target = np.where(given == 1, 1.0, (good > 0.5).astype(float))
            for doc in np.flatnonzero((labels == 0) & (sizes > 0)):
                own = slice(bounds[doc], bounds[doc + 1])
                target[bounds[doc] + int(np.argmin(good[own]))] = 0.0
    model = LineModel(weights, pair, 1.0, 0.0, float(prior))
    means = model.means(features, bounds, length)
    full = ~np.isnan(means)
    x, y = _logit(means[full]), labels[full].astype(float)

    def curve(point):
        z = np.clip(point[0] * x + point[1], -30, 30)
        p = 1 / (1 + np.exp(-z))
        value = np.logaddexp(0, z).sum() - (z * y).sum() + (point @ point) / 200
        return value, np.array([((p - y) * x).sum(), (p - y).sum()]) + point / 100

    model.scale, model.shift = (float(v) for v in _minimum(curve, np.array([1.0, 0.0])))
    return model


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_docs: int = TRAIN_DOCS,
    train_lines: int = TRAIN_LINES,
) -> LineModel:
    """Fit on labelled documents that are not held out (``crc32(id) mod 5 <> 0``)."""
    own = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    own = own.filter("id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("id")))
    own = own.groupBy("id").agg(F.max("label").alias("label"))
    chosen = own.orderBy(F.md5(F.col("id").cast("string")), "id").limit(train_docs)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # At most ``train_docs`` ids, safe to broadcast. An id may stand on any number of rows: equal
    # ones are described once, and of what is left only the first ``train_docs`` are collected.
    sample = texts.join(F.broadcast(chosen), "id").select("id", "label", "text").distinct()

    def describe(batches):
        for batch in batches:
            for part, bounds, length, features in line_features(batch.column(2)):
                for i, doc in enumerate(range(part.start, part.stop)):
                    own = slice(bounds[i], bounds[i + 1])
                    if 0 < own.stop - own.start <= train_lines:
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0)[doc : doc + 1],
                                batch.column(1)[doc : doc + 1],
                                pa.array([length[own].astype(np.int32).tobytes()]),
                                pa.array([features[own].astype(np.float32).tobytes()]),
                            ],
                            ["id", "label", "length", "features"],
                        )

    drawn = sample.mapInArrow(describe, "id long, label int, length binary, features binary")
    first = drawn.distinct().orderBy("id", "label", "length", "features").limit(train_docs)
    rows = sorted((r.id, r.label, bytes(r.length), bytes(r.features)) for r in first.collect())
    length = np.concatenate([np.zeros(0, np.int32)] + [np.frombuffer(r[2], np.int32) for r in rows]).astype(np.int64)
    features = np.concatenate([np.zeros((0, FEATURES))] + [np.frombuffer(r[3], np.float32).reshape(-1, FEATURES) for r in rows])
    bounds = np.cumsum([0] + [len(r[2]) // 4 for r in rows])
    return fit_lines(features.astype(float), bounds, length, np.array([r[1] for r in rows], dtype=int))


def held_out(key):
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def quality_scores(docs: DataFrame, model: LineModel, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``score``; an own column of that name is replaced."""
    kept = [c for c in (keep or docs.columns) if c != "score"]
    source = docs.select(*[F.col(c) for c in kept], F.col(text_col).cast("string").alias("_text"))
    out = source.drop("_text").withColumn("score", F.lit(0.0))

    def rate(batches):
        for batch in batches:
            place = batch.num_columns - 1
            for part, bounds, length, features in line_features(batch.column(place)):
                own = batch.slice(part.start, part.stop - part.start)
                score = pa.array(model.scores(features, bounds, length))
                yield pa.RecordBatch.from_arrays([*own.columns[:place], score], [*kept, "score"])

    return source.mapInArrow(rate, out.schema)


def graded(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    model = fit_quality(docs, labels, **options)
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    scored = quality_scores(docs, model, text_col=text_col, keep=[id_col])
    return scored.select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
