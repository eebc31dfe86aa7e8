"""Quality rules: how far a document's histograms lie from those of its language.

Two histograms describe a text: its characters by class, and its words by the
common words of the corpus. References of both kinds are counted per language
over all documents: a word is common in a language if at least one in
``1 / WORD_SHARE`` of the language's words is that word, so a reference holds
at most that many. A language has a reference if it holds ``LANG_SHARE`` of all
words, so there are at most ``1 / LANG_SHARE``. The Jensen-Shannon distance
(base 2, 0 to 1) to the nearest reference decides, once a text has enough
characters or words for its histogram to mean something. A short text's words
scatter more, so the limit of the word distance follows their number.

NULL, empty and blank texts have no words and fail the rule of ten words. A
NULL language counts as a language of its own; without any reference (an empty
corpus) the distances are NULL and the base rules alone decide. Repeated rows
are scored each. Other columns are ignored. Words are told apart by 64-bit
hashes; texts are read whole, in windows, so memory does not follow the length
of a text beyond eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import stored
from rowcast.llm.shingles import WIDTH, WINDOW, byte_values, byte_view, groups, mix, word_hashes

WORD_SHARE = 1 / 500
LANG_SHARE = 1 / 1000
# Texts with fewer characters or words than these are not judged by that histogram.
LEAST_CHARS = 200
LEAST_WORDS = 50
CHAR_LIMIT = 0.27
# The distance a text may have at any length; a sample of n words adds WORD_NOISE / n to its square.
WORD_LIMIT = 0.27
WORD_NOISE = 6.0
# The base rules: too few words, or too many of them in repeated runs of five.
LEAST_BASE_WORDS = 10
REPEAT_PERCENT = 20

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)
_WORD = np.ones(256, dtype=bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_LINE = np.ones(256, dtype=bool)
_LINE[10] = False
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_EXACT = byte_values(fold=False)
_FOLDED = byte_values()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

CLASSES = ("lower", "upper", "digit", "blank", "break", "mark", "shout", "symbol", "wide")


def _class_table() -> np.ndarray:
    """Class of a byte; bytes inside a character have none (one past the last)."""
    table = np.full(256, CLASSES.index("symbol"), dtype=np.int64)
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[[32, 9, 11, 12, 13]], table[10] = 3, 4
    table[list(b".,;:'\"()-")], table[list(b"!?")] = 5, 6
    table[128:192], table[192:] = len(CLASSES), 8
    return table


_CLASS = _class_table()


@dataclass
class Block:
    """Measures of consecutive texts: ``part`` says which of the batch."""

    part: slice
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray
    tokens: np.ndarray
    bounds: np.ndarray


def _repeated(runs: np.ndarray, words: int) -> int:
    """Words covered by runs that occur twice or more."""
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(runs), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(words + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WIDTH, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measured(column: pa.Array, window: int = WINDOW) -> Iterator[Block]:
    """Counts, class histograms and word hashes of whole texts, a few megabytes of text at a time."""
    content, starts, ends = byte_view(column)
    kinds = len(CLASSES) + 1
    for part in groups(starts, ends, window):
        low, high = int(starts[part.start]), int(ends[part.stop - 1])
        data, first, last = content[low:high], starts[part] - low, ends[part] - low
        size = len(first)
        breaks = np.unique(np.concatenate([first, last]))
        classes, chars, symbols = np.zeros((size, kinds), np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for at in range(0, len(data), window):
            piece = data[at : at + window]
            owner = np.searchsorted(first, np.arange(at, at + len(piece)), side="right") - 1
            # Bytes between texts, where a NULL hides some, belong to none.
            own = np.arange(at, at + len(piece)) < last[owner]
            classes += np.bincount(owner[own] * kinds + _CLASS[piece[own]], minlength=size * kinds).reshape(size, kinds)
            chars += np.bincount(owner[own & _WORD[piece] & ((piece & 0xC0) != 0x80)], minlength=size)
            symbols += np.bincount(owner[own & _SYMBOL[piece]], minlength=size)
        words, places = word_hashes(data, breaks, window, _EXACT)
        lines, line_places = word_hashes(data, breaks, window, _EXACT, _LINE)
        tokens, token_places = word_hashes(data, breaks, window, _FOLDED, _LETTER)
        # A line counts if a word starts in it.
        held = np.searchsorted(places, line_places) < np.searchsorted(places, np.append(line_places[1:], len(data)))
        a, b = np.searchsorted(places, first), np.searchsorted(places, last)
        c, d = np.searchsorted(line_places, first), np.searchsorted(line_places, last)
        runs = np.zeros(max(0, len(words) - WIDTH + 1), np.uint64)
        for i in range(WIDTH):
            runs = runs * _STEP + words[i : i + len(runs)]
        runs = mix(runs)
        dup, repeat = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for i in range(size):
            full = lines[c[i] : d[i]][held[c[i] : d[i]]]
            dup[i] = len(full) - len(np.unique(full))
            if b[i] - a[i] > WIDTH:
                repeat[i] = _repeated(runs[a[i] : b[i] - WIDTH + 1], int(b[i] - a[i]))
        # Tokens between texts would be counted twice, so bounds are kept as pairs.
        bounds = np.stack([np.searchsorted(token_places, first), np.searchsorted(token_places, last)])
        yield Block(part, b - a, chars, symbols, dup, repeat, classes[:, :-1], tokens, bounds)


@dataclass
class References:
    """Per language: shares of character classes, and of the words in ``words`` (sorted hashes)."""

    languages: list[str] = field(default_factory=list)
    classes: np.ndarray = field(default_factory=lambda: np.zeros((0, len(CLASSES))))
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    shares: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def corpus_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, kind, item, n)``: character classes (kind 0) and folded words (kind 1) of all texts."""
    source = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).cast("string").alias("text")
    )

    def count(batches):
        for batch in batches:
            names, codes = np.unique(np.array(batch.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
            for block in measured(batch.column(1)):
                own = codes[block.part]
                sizes = block.bounds[1] - block.bounds[0]
                for code in np.unique(own):
                    mine = np.flatnonzero(own == code)
                    picked = np.concatenate([block.tokens[block.bounds[0][i] : block.bounds[1][i]] for i in mine]) if sizes[mine].any() else block.tokens[:0]
                    items, n = np.unique(picked, return_counts=True)
                    total = block.classes[mine].sum(axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([names[code]] * (len(items) + len(CLASSES))),
                            pa.array(np.concatenate([np.zeros(len(CLASSES), np.int32), np.ones(len(items), np.int32)])),
                            pa.array(np.concatenate([np.arange(len(CLASSES), dtype=np.int64), items.view(np.int64)])),
                            pa.array(np.concatenate([total, n]).astype(np.int64)),
                        ],
                        ["lang", "kind", "item", "n"],
                    )

    counted = source.mapInArrow(count, "lang string, kind int, item long, n long")
    return counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def fit_references(docs: DataFrame, *, word_share: float = WORD_SHARE, lang_share: float = LANG_SHARE, **columns) -> References:
    """Count the corpus once and keep what is common.

    What reaches the driver is bounded by the two shares, whatever the corpus:
    at most ``1 / lang_share`` languages, each with at most ``1 / word_share`` words.
    """
    counts = stored(corpus_counts(docs, **columns), "corpus_counts")
    totals = counts.filter("kind = 1").groupBy("lang").agg(F.sum("n").alias("total"))
    every = totals.agg(F.sum("total")).first()[0] or 0
    known = totals.filter(F.col("total") >= F.lit(max(1.0, every * lang_share)))
    kept = counts.join(F.broadcast(known), "lang").filter(F.expr("kind = 0") | (F.col("n") >= F.col("total") * F.lit(word_share)))
    rows = kept.select("lang", "kind", "item", "n", "total").collect()
    languages = sorted({r.lang for r in rows})
    found = np.unique(np.array([r.item for r in rows if r.kind == 1], dtype=np.int64).view(np.uint64))
    place = {name: i for i, name in enumerate(languages)}
    classes, shares = np.zeros((len(languages), len(CLASSES))), np.zeros((len(languages), len(found)))
    for r in rows:
        if r.kind == 0:
            classes[place[r.lang], r.item] = r.n
        else:
            at = np.searchsorted(found, np.array([r.item], np.int64).view(np.uint64)[0])
            shares[place[r.lang], at] = r.n / r.total
    return References(languages, classes / np.maximum(classes.sum(axis=1, keepdims=True), 1), found, shares)


def _part(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What one place adds to twice the divergence, in bits."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0)
    return left + right


def distances(block: Block, known: References) -> tuple[np.ndarray, np.ndarray]:
    """Jensen-Shannon distances, texts by languages: of character classes and of common words."""
    size, languages = len(block.n_words), len(known.languages)
    total = block.classes.sum(axis=1, keepdims=True)
    p = block.classes / np.maximum(total, 1)
    chars = np.stack([_part(p, q[None, :]).sum(axis=1) for q in known.classes], axis=1) if languages else np.zeros((size, 0))
    chars[total[:, 0] == 0] = 2.0

    counts = block.bounds[1] - block.bounds[0]
    owner = np.repeat(np.arange(size), counts)
    picked = [block.tokens[a:b] for a, b in zip(*block.bounds.tolist())]
    tokens = np.concatenate(picked) if picked else block.tokens[:0]
    width = len(known.words)
    at = np.searchsorted(known.words, tokens)
    common = at < width
    common[common] = known.words[at[common]] == tokens[common]
    cells, n = np.unique(owner[common] * max(width, 1) + at[common], return_counts=True)
    row, column = cells // max(width, 1), cells % max(width, 1)
    share = n / counts[row]
    rest = 1 - np.bincount(owner[common], minlength=size) / np.maximum(counts, 1)
    words = np.zeros((size, languages))
    for i in range(languages):
        q = known.shares[i][column] if width else np.zeros(0)
        # Where a text has none of a word, the reference's share counts in full.
        seen = np.bincount(row, weights=_part(share, q) - q, minlength=size)
        other = 1 - known.shares[i].sum()
        words[:, i] = seen + known.shares[i].sum() + _part(rest, np.full(size, max(other, 0.0)))
    words[counts == 0] = 2.0
    return np.sqrt(np.clip(chars / 2, 0, 1)), np.sqrt(np.clip(words / 2, 0, 1))


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def quality_rules(
    docs: DataFrame,
    known: References,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_words: int = LEAST_WORDS,
    char_limit: float = CHAR_LIMIT,
    word_limit: float = WORD_LIMIT,
    word_noise: float = WORD_NOISE,
) -> DataFrame:
    """Per document its measures, the nearest language with both distances, and the verdict."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    kind = source.schema[id_col].dataType.simpleString()
    more = "base_failed boolean, nearest string, char_distance double, word_distance double, kept boolean"
    names = [id_col] + [part.split()[0] for part in f"{MEASURES}, {more}".split(", ")]

    def judge(batches):
        for batch in batches:
            for block in measured(batch.column(1)):
                failed = (block.n_words < LEAST_BASE_WORDS) | (100 * block.n_repeat_words > REPEAT_PERCENT * block.n_words)
                size = len(failed)
                tokens = block.bounds[1] - block.bounds[0]
                if known.languages:
                    chars, words = distances(block, known)
                    best = np.argmin(chars + words, axis=1)
                    char, word = chars[np.arange(size), best], words[np.arange(size), best]
                    limit = np.sqrt(word_limit**2 + word_noise / np.maximum(tokens, 1))
                    far = (block.word_chars >= least_chars) & (char > char_limit) | (tokens >= least_words) & (word > limit)
                    near = pa.array(np.array(known.languages, dtype=object)[best], pa.string())
                    measures = [near, pa.array(char), pa.array(word)]
                else:
                    far = np.zeros(size, dtype=bool)
                    measures = [pa.nulls(size, pa.string()), pa.nulls(size, pa.float64()), pa.nulls(size, pa.float64())]
                counts = [block.n_words, block.word_chars, block.n_symbols, block.n_dup_lines, block.n_repeat_words]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[block.part.start : block.part.stop],
                        *[pa.array(c.astype(np.int64)) for c in counts],
                        pa.array(failed),
                        *measures,
                        pa.array(~failed & ~far),
                    ],
                    names,
                )

    return source.mapInArrow(judge, f"`{id_col}` {kind}, {MEASURES}, {more}")


def judged(docs: DataFrame, **options) -> DataFrame:
    """References counted over ``docs``, then every document of ``docs`` held against them."""
    return quality_rules(docs, fit_references(docs), **options)
