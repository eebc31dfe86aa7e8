"""Words, shingles and MinHash signatures of whole texts, computed on Arrow buffers.

A text is its UTF-8 bytes with A-Z lower-cased. Words are runs of bytes other
than space and 0x09-0x0D; since those are ASCII, cutting bytes cuts characters
right. Everything is vectorised over many texts at once, in windows of a few
megabytes, so memory does not follow the size of a batch or of one text. A byte
of a window takes some 30 bytes more while it is worked on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 4 << 20
# Sets and lines go by smaller windows: several workers of one executor hold one each at a time.
SMALL_WINDOW = 1 << 20
WIDTH = 5
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = _U(0xD6E8FEB86659FD93)
_MIX_1 = _U(0xBF58476D1CE4E5B9)
_MIX_2 = _U(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> _U(30))) * _MIX_1
    values = (values ^ (values >> _U(27))) * _MIX_2
    return values ^ (values >> _U(31))


def byte_values(fold: bool = True) -> np.ndarray:
    """A worth for every byte; with ``fold`` A-Z are worth what a-z are."""
    values = mix((np.arange(256, dtype=np.uint64) + _U(1)) * _BASE)
    if fold:
        values[65:91] = values[97:123]
    return values


_VALUES = byte_values()
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < size:
        # As much as the windows at hand ask for, in few steps.
        room = 1 << max(16, (size - 1).bit_length())
        for place, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(room, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[place] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column without a copy: data, starts, ends; NULL is empty."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    starts, ends = bounds[:-1], bounds[1:].copy()
    if column.null_count:
        missing = column.is_null().to_numpy(zero_copy_only=False)
        ends[missing] = starts[missing]
    return content, starts, ends


def groups(starts: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> Iterator[slice]:
    """Consecutive texts of about ``window`` bytes together; a longer text is alone."""
    first, size = 0, 0
    for i, length in enumerate((ends - starts).tolist()):
        if i > first and size + length > window:
            yield slice(first, i)
            first, size = i, 0
        size += length
    if first < len(starts):
        yield slice(first, len(starts))


def _window_words(content: np.ndarray, breaks: np.ndarray, values: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words of one window; ``breaks`` also end words."""
    inside = word_bytes[content]
    opened = inside.copy()
    opened[1:] &= ~inside[:-1]
    breaks = breaks[breaks < len(content)]
    opened[breaks] = inside[breaks]
    first = np.flatnonzero(opened)
    if not len(first):
        return np.zeros(0, np.uint64), first
    # A word ends where the next one opens at the latest; separators add nothing.
    powers, inverse = _powers(len(content))
    terms = values[content] * powers[: len(content)]
    terms[~inside] = 0
    return mix(np.add.reduceat(terms, first) * inverse[first]), first


def word_hashes(
    content: np.ndarray,
    breaks: np.ndarray,
    window: int = WINDOW,
    values: np.ndarray = _VALUES,
    word_bytes: np.ndarray = _IN_WORD,
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and start of every word; words also end at ``breaks`` (sorted).

    ``values`` gives what each byte is worth (equal worth, equal word), ``word_bytes`` which bytes are part of a word.
    """
    if len(content) <= window:
        return _window_words(content, breaks, values, word_bytes)
    hashes, places, at = [], [], 0
    while at < len(content):
        end = min(at + window, len(content))
        while end < len(content):
            gaps = np.flatnonzero(~word_bytes[content[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + window, len(content))
        h, p = _window_words(content[at:end], breaks[(breaks >= at) & (breaks < end)] - at, values, word_bytes)
        hashes.append(h)
        places.append(p + at)
        at = end
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(column: pa.Array, window: int = SMALL_WINDOW) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Per group of texts: which texts, distinct shingle hashes (sorted per text), their bounds.

    Texts of at least five words have all runs of five words; shorter ones
    their whole sequence as one; those without words none.
    """
    content, starts, ends = byte_view(column)
    for part in groups(starts, ends, window):
        low, high = int(starts[part.start]), int(ends[part.stop - 1])
        breaks = np.unique(np.concatenate([starts[part], ends[part]]) - low)
        words, places = word_hashes(content[low:high], breaks, window)
        first = np.searchsorted(places, starts[part] - low)
        last = np.searchsorted(places, ends[part] - low)
        runs = np.zeros(max(0, len(words) - WIDTH + 1), np.uint64)
        for i in range(WIDTH):
            runs = runs * _STEP + words[i : i + len(runs)]
        runs = mix(runs)
        sets, sizes = [], []
        for a, b in zip(first.tolist(), last.tolist()):
            if b - a >= WIDTH:
                own = np.unique(runs[a : b - WIDTH + 1])
            elif b > a:
                own = _U(b - a) * np.ones(1, np.uint64)
                for word in words[a:b]:
                    own = own * _STEP + word
                own = mix(own)
            else:
                own = runs[:0]
            sets.append(own)
            sizes.append(len(own))
        yield part, np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def signature_keys(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * _STEP)
    return seeds[:coordinates], seeds[coordinates:] | _U(1)


def minhash(hashes: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of 32-bit minima per non-empty set."""
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    out = np.zeros((len(full), coordinates), np.uint32)
    if len(full):
        for i, (seed, factor) in enumerate(zip(*signature_keys(coordinates))):
            ranks = ((hashes ^ seed) * factor) >> _U(32)
            out[:, i] = np.minimum.reduceat(ranks, bounds[:-1][full])
    return out


def set_prints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart: two sums of mixed hashes."""
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    prints = np.zeros((2, len(bounds) - 1), np.uint64)
    if len(full):
        for row, seed in enumerate((_BASE, _STEP)):
            prints[row, full] = np.add.reduceat(mix(hashes ^ seed), bounds[:-1][full])
    return prints[0].view(np.int64), prints[1].view(np.int64)
