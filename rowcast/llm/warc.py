"""WARC records as a chunked table, for payloads of any size.

An archive is a table of rows ``(record, chunk, last, data, digest)``. The
``data`` of a record's chunks in order are its bytes in a WARC/1.1 file:
chunk 0 holds the header block, the following ones at most ``CHUNK_BYTES`` of
payload each, the last one the closing line breaks. Every chunk carries the
SHA-1 of the payload so far, so a reader can check a record piece by piece and
stop at the first wrong one. Every record has an id of its own, made from its
number in the archive, and the date that the caller gives; page ids are extension
fields beside them. Payload bytes are sliced out of the Arrow buffer
and hashed on the way; a record is never put together in memory, neither when
it is written nor when it is read. Spark's committer writes the table, so a
task that runs twice leaves one copy.

Of records with equal payloads of at least ``least_bytes`` the one with the
smallest page id is a response, the others are revisits that name it and have
no payload of their own. Among rows of one page id the one read first counts
as smaller. A NULL page id counts as larger than all others; a revisit of such
a record has ``refers_to`` NULL. NULL payloads are empty. An empty table gives
an empty archive. Other columns of the input are not looked at. Rows should
come from a scan, as they are read more than once.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.llm.shingles import byte_view

CHUNK_BYTES = 256 << 10
# Stands in every record unless another is given: a date of writing would differ between attempts.
DATE = "2000-01-01T00:00:00Z"
ROWS_BYTES = 4 << 20
CHUNKS = "record long, chunk int, last boolean, data binary, digest binary"
_NAMES = [part.split()[0] for part in CHUNKS.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(record: int) -> str:
    return f"<urn:record:{record}>"


def _header(kind, record, page, uri, date, digest: bytes, size: int, refers, original) -> bytes:
    """The header block; fields that stand for NULL are left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(record)}", f"WARC-Date: {date}"]
    if uri:
        lines.append("WARC-Target-URI: " + "".join(c for c in uri if c >= " "))
    if page is not None:
        lines.append(f"Page-ID: {page}")
    lines.append(f"WARC-Payload-Digest: sha1:{_base32(digest)}")
    lines.append(f"WARC-Payload-Bytes: {size}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {_PROFILE}")
        lines.append(f"WARC-Refers-To: {_record_id(original)}")
        if refers is not None:
            lines.append(f"Refers-To-Page-ID: {refers}")
    lines += ["Content-Type: text/html", f"Content-Length: {size if kind == 'response' else 0}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``(record, refers, revisit)`` (``revisit`` the number of the response) of rows ``(record, page, payload)``, moving digests only."""
    narrow = pages.select("record", "page", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").alias("size"))
    narrow = narrow.filter(F.col("size") >= least_bytes)
    rank = F.struct(F.col("page").isNull().alias("unknown"), "page", "record")
    first = narrow.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    revisits = narrow.join(first, "digest").filter(F.col("record") != F.col("first.record"))
    return revisits.select("record", F.col("first.page").alias("refers"), F.col("first.record").alias("revisit"))


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    payload_col: str = "html",
    uri_col: str | None = "url",
    least_bytes: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    date: str = DATE,
) -> None:
    """Write one WARC record per row of ``pages`` under ``path``."""
    own = pages.select(
        F.col(id_col).cast("long").alias("page"),
        (F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")).alias("uri"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("record", F.monotonically_increasing_id())
    # Record numbers are unique: the join cannot be skewed, whatever repeats.
    rows = own.join(_roles(own, least_bytes), "record", "left").select("record", "page", "uri", "refers", "revisit", "payload")

    def write(batches):
        held, size = [], 0

        def flushed():
            nonlocal held, size
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES)], _NAMES)
            held, size = [], 0
            return out

        for batch in batches:
            content, starts, ends = byte_view(batch.column(5))
            narrow = zip(*(batch.column(i).to_pylist() for i in range(5)))
            for (record, page, uri, refers, revisit), a, b in zip(narrow, starts.tolist(), ends.tolist()):
                whole = hashlib.sha1()
                for at in range(a, b, chunk_bytes):
                    whole.update(content[at : min(at + chunk_bytes, b)])
                kind = "response" if revisit is None else "revisit"
                head = _header(kind, record, page, uri, date, whole.digest(), b - a, refers, revisit)
                so_far = hashlib.sha1()
                cuts = [] if kind == "revisit" else list(range(a, b, chunk_bytes))
                held.append((record, 0, not cuts, head + (b"" if cuts else _END), so_far.digest()))
                for number, at in enumerate(cuts, 1):
                    part = content[at : min(at + chunk_bytes, b)]
                    so_far.update(part)
                    last = number == len(cuts)
                    held.append((record, number, last, part.tobytes() + (_END if last else b""), so_far.digest()))
                    size += len(part)
                    if size >= ROWS_BYTES:
                        yield flushed()
                size += len(head)
                if size >= ROWS_BYTES:
                    yield flushed()
        if held:
            yield flushed()

    rows.mapInArrow(write, CHUNKS).write.mode("overwrite").option("parquet.block.size", 32 << 20).parquet(path)


def _fields(head: bytes) -> dict[str, str]:
    text = head.decode().split("\r\n")
    if text[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in text[1:] if ": " in line)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; payloads are verified.

    Records of one payload chunk or none lie whole in one or two rows; each
    row is checked by itself, as the digest of a first chunk needs no other.
    Only later chunks of oversized payloads are brought together, sorted by
    record and chunk, and hashed as they stream by.
    """
    table = spark.read.schema(CHUNKS).parquet(path)

    def heads(batches):
        names = ["record", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            rows = []
            for record, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                known = _fields(data.as_py())
                page, refers = known.get("Page-ID"), known.get("Refers-To-Page-ID")
                number = lambda value: None if value is None else int(value)
                digest = known["WARC-Payload-Digest"].removeprefix("sha1:")
                rows.append((record, number(page), int(known["WARC-Payload-Bytes"]), digest, known["WARC-Type"], number(refers)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def bodies(batches):
        """``(record, payload, digest)`` of rows ``(record, chunk, last, data, digest)`` in order."""
        record, done, size, running = None, 0, 0, None
        for batch in batches:
            content, starts, ends = byte_view(batch.column(3))
            narrow = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)))
            out = []
            for (own, chunk, last, digest), a, b in zip(narrow, starts.tolist(), ends.tolist()):
                if chunk == 1:
                    record, done, size, running = own, 0, 0, hashlib.sha1()
                if own != record or chunk != done + 1:
                    raise ValueError(f"record {own}: chunk {chunk} does not follow")
                end = b - len(_END) if last else b
                running.update(content[a:end])
                done, size = chunk, size + end - a
                if running.digest() != digest:
                    raise ValueError(f"record {own}: chunk {chunk} is damaged")
                if last:
                    out.append((own, size, _base32(digest)))
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["record", "read_bytes", "read_digest"])

    head = table.filter("chunk = 0").select("record", "data")
    head = head.mapInArrow(heads, "record long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    body = "record long, read_bytes long, read_digest string"
    short = table.filter("chunk = 1 AND last").select(*_NAMES).mapInArrow(bodies, body)
    # A whole payload in one chunk ends with that chunk; others are put in order first.
    long = table.filter("chunk > 1 OR chunk = 1 AND NOT last").repartition("record").sortWithinPartitions("record", "chunk")
    read = short.unionByName(long.select(*_NAMES).mapInArrow(bodies, body))
    joined = head.join(read, "record", "left")
    empty = _base32(hashlib.sha1().digest())
    same = (F.coalesce("read_bytes", F.lit(0)) == F.col("payload_bytes")) & (F.coalesce("read_digest", F.lit(empty)) == F.col("payload_digest"))
    wrong = F.raise_error(F.concat(F.lit("payload differs from its header in record "), F.col("record").cast("string")))
    checked = F.when((F.col("record_type") == "revisit") | same, F.col("record_type")).otherwise(wrong)
    return joined.select("page_id", "payload_bytes", "payload_digest", checked.alias("record_type"), "refers_to")


def export_bytes(chunks: DataFrame) -> DataFrame:
    """Rows of an archive in the order of a WARC file: their ``data`` one after another is the file."""
    return chunks.sort("record", "chunk").select("data")
