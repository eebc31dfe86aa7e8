"""Harmonic packing of token sequences into bins of fixed capacity.

Lengths fall into reciprocal classes: class ``j`` holds lengths in
``(capacity / (j + 1), capacity / j]``, and a bin of class ``j`` takes exactly
``j`` of them. A bin is therefore full after a fixed count, without looking at
any other bin, and every task packs its own documents with at most one open
bin per class. Nothing is shuffled.

Documents may be cut. What a document has beyond whole bins is cut so that
its parts nearly fill a class: a length that would leave more than ``slack``
tokens of a bin unused gives its largest exact reciprocal to the next class,
and what remains is treated likewise, at most a few times. At the end of a
task the open bins are merged, longest piece first.

Padding is at most ``slack`` of ``capacity`` in full bins, plus on average
half a bin per task.

Every document ends with ``end_id``. NULL and empty texts are that id alone;
a NULL id of a document is kept as it is, repeated documents are packed each.
An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.tokens import encoder, text_groups

CAPACITY = 2048
SLACK = 32
_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cut_lengths(length: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of a document's pieces, in order."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        fit = capacity // rest
        if capacity - fit * rest <= slack:
            pieces.append(rest)
            break
        part = capacity // (fit + 1)
        pieces.append(part)
        rest -= part
    return pieces


class HarmonicBins:
    """One task's bins; full ones are returned as lists of pieces."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.open: dict[int, list] = {}

    def add(self, length: int, piece) -> list | None:
        kind = self.capacity // length
        own = self.open.setdefault(kind, [])
        own.append((length, piece))
        return self.open.pop(kind) if len(own) == kind else None

    def rest(self) -> list[list]:
        """The open bins' pieces, merged first-fit by falling length."""
        pieces = sorted((one for own in self.open.values() for one in own), key=lambda one: -one[0])
        bins, room, first, last = [], [], 0, 0
        for length, piece in pieces:
            if length != last:
                first, last = 0, length
            while first < len(bins) and room[first] < length:
                first += 1
            if first == len(bins):
                bins.append([])
                room.append(self.capacity)
            bins[first].append((length, piece))
            room[first] -= length
        self.open = {}
        return bins


def pack(
    docs: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it starts in its document, its length, its sequence and offset there.

    ``sequence_id`` is unique over all tasks. ``with_ids`` adds the ids as
    little-endian unsigned 32-bit bytes. Rows should come from a scan, so that
    a task that runs again packs the same documents.
    """
    schema = _SCHEMA + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]
    end = int(end_id).to_bytes(4, "little")

    def fill(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        words, bins = encoder(vocabulary), HarmonicBins(capacity)
        sequence = (context.partitionId() if context else 0) << 33
        rows: list[tuple] = []

        def place(full):
            nonlocal sequence
            offset = 0
            for length, piece in full:
                doc, start, crc, total, ids = piece
                rows.append((doc, start, length, crc, total, sequence, offset) + ((ids,) if with_ids else ()))
                offset += length
            sequence += 1

        def flushed():
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            types = [pa.int64()] * 7 + [pa.binary()] * with_ids
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            rows.clear()
            return out

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for part, texts in text_groups(batch.column(1)):
                for doc, ids in zip(keys[part], words.encode_many(texts)):
                    ids += end
                    view, start = memoryview(ids), 0
                    total = len(ids) // 4
                    for length in cut_lengths(total, capacity, slack):
                        own = view[4 * start : 4 * (start + length)]
                        piece = (doc, start, zlib.crc32(own), total, own.tobytes() if with_ids else None)
                        full = bins.add(length, piece)
                        if full:
                            place(full)
                        start += length
                if len(rows) > (256 if with_ids else 20_000):
                    yield flushed()
        for full in bins.rest():
            place(full)
        yield flushed()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    packed = texts.mapInArrow(fill, schema)
    return packed if id_col == "doc_id" else packed.withColumnRenamed("doc_id", id_col)
