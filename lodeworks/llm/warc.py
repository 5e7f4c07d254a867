"""WARC archives: one gzip member per record, revisit records for repeats.

The writer puts each partition's records into one archive in shared storage;
the reader goes through an archive sequentially: it frames each record by its
content length while the member is inflated, and checks length and digest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .minhash import maybe_in
from .storage import open_bytes, scratch, stash, write_bytes

#: Equal payloads of at least this many bytes are written once and revisited.
REVISIT_BYTES = 100
#: Repeated digests that are broadcast.
BROADCAST_DIGESTS = 200_000
#: Bytes of the longest header.
MOST_HEADER = 1 << 20
_BUFFER = 1 << 16


class WarcError(ValueError):
    """An archive that does not hold what its headers say."""


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: tuple[int | None, str | None] | None, place: str = "0-0", date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One gzip member: a response record with its payload, or, if it refers to
    the (key, URL) of a response, a revisit record that has the payload's length
    and digest but no block.  ``place`` (archive and number in it) makes the id
    unique, however often a page occurs."""
    digest = hashlib.sha256(payload).hexdigest()
    revisit = refers_to is not None
    block = b"" if revisit else payload
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:lodeworks:page:{name}:{place}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_quoted(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page: {refers_to[0]}"]
        if refers_to[1] is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_quoted(refers_to[1])}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Page: {name}", f"X-Payload-Length: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _quoted(url: str) -> str:
    return quote(url, safe=":/?#[]@!$&()*+,;=%")


class Member:
    """One gzip member of a stream, inflated as it is read.

    ``rest`` holds compressed bytes that were read but not yet used; after the
    member's end they belong to the next one.
    """

    def __init__(self, stream, rest: bytes):
        self.stream, self.rest, self.inflate, self.ready = stream, rest, zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Inflate some more; false at the member's end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.rest or self.stream.read(_BUFFER)
            self.rest = b""
            try:
                out = self.inflate.decompress(data, _BUFFER)
            except zlib.error:
                raise WarcError("a member is not gzip data") from None
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
            elif not data and not out:
                raise WarcError("archive ends inside a record")
            if out:
                self.ready += out
                return True
        return False

    def until(self, mark: bytes, most: int) -> bytes:
        """What stands before ``mark``, which is passed over."""
        while (at := self.ready.find(mark)) < 0:
            if len(self.ready) > most or not self.more():
                raise WarcError("record has no header")
        found, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return found

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, as they come."""
        while size:
            if not self.ready and not self.more():
                raise WarcError("record is not framed by its content length")
            piece, self.ready = self.ready[:size], self.ready[size:]
            size -= len(piece)
            yield piece


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record; raises :class:`WarcError` where
    framing, length or digest disagree.  A block is framed by its content length
    and hashed while its member is inflated."""
    rest = stream.read(_BUFFER)
    while rest:
        member = Member(stream, rest)
        lines = member.until(b"\r\n\r\n", MOST_HEADER).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError("record has no header")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(headers)
        if missing or not headers["content-length"].isdigit():
            raise WarcError("record lacks a mandatory header")
        digest, block = hashlib.sha256(), []
        for piece in member.pieces(int(headers["content-length"])):
            digest.update(piece)
            block.append(piece)
        if b"".join(member.pieces(4)) != b"\r\n\r\n" or member.ready or member.more():
            raise WarcError("record is not framed by its content length")
        if headers["warc-type"] == "response":
            if "sha256:" + digest.hexdigest() != headers["warc-payload-digest"]:
                raise WarcError("payload digest differs")
            if headers["x-payload-length"] != headers["content-length"]:
                raise WarcError("payload length differs")
        yield headers, b"".join(block)
        rest = member.rest or stream.read(_BUFFER)


def repeated(rows: DataFrame) -> DataFrame:
    """(d, first): the response's (key, URL) of each digest that several rows
    have, from (k, u, d).  Only digests, keys and URLs move."""
    least = F.min(F.struct(F.col("k").isNull().alias("none"), "k", "u"))
    many = rows.groupBy("d").agg(least.alias("x"), F.count("*").alias("times")).where("times > 1")
    return many.select("d", F.struct("x.k", "x.u").alias("first"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", at: datetime | None = None) -> DataFrame:
    """Write every row of ``pages`` as one record; returns (path, records, bytes).

    The row with the smallest key among equal payloads of at least
    ``REVISIT_BYTES`` bytes is a response and the others revisit it; several
    rows that share that smallest key are all responses.  A null payload is
    empty.  A row with a null key is a response unless a row with a key has
    the same payload.  Records are dated ``at``, or now.  Payloads are not moved
    while the repeated digests are few enough to be broadcast; beyond that only
    those that one bitmap of digests lets through.  An empty table gives none or
    empty archives; other columns are not read.
    """
    date = (at or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).cast("string").alias("u"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("h"))
    rows = rows.withColumn("d", F.when(F.octet_length("h") >= REVISIT_BYTES, F.unhex(F.sha2("h", 256))))
    first = stash(repeated(rows.where("d IS NOT NULL").select("k", "u", "d")), "repeated")
    if first.count() <= BROADCAST_DIGESTS:
        marked = rows.join(F.broadcast(first), "d", "left")
    else:
        some = maybe_in(rows.where("d IS NOT NULL"), first, "d").join(first, "d", "left")
        marked = some.unionByName(maybe_in(rows, first, "d", negate=True).withColumn("first", F.lit(None).cast(first.schema["first"].dataType)))
    again = F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first.k"))
    marked = marked.select("k", "u", "h", F.col("first.k").alias("first"), F.col("first.u").alias("first_u"), again.alias("again"))

    def write(batches: Iterable) -> Iterator:
        import pyarrow as pa

        part, done = TaskContext.get().partitionId(), [0]

        def records():
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    for k, u, h, first, first_u, again in zip(*(batch.column(i).slice(lo, 256).to_pylist() for i in range(6))):
                        yield record_bytes(k, u, h.encode(), (first, first_u) if again else None, f"{part}-{done[0]}", date)
                        done[0] += 1

        path = f"{folder}/part-{part:06d}.warc.gz"
        size = write_bytes(path, records())
        yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([done[0]], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return marked.mapInArrow(write, "path string, records long, bytes long")


def _page(name: str | None) -> int | None:
    return int(name) if name else None


def read_archives(paths: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload) of all records of the archives in column ``path``."""

    def read(batches: Iterable) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_bytes(path) as stream:
                    for headers, block in read_records(stream):
                        revisit = headers["warc-type"] == "revisit"
                        uri = headers.get("warc-target-uri")
                        rows.append({"page_id": _page(headers.get("x-page")), "url": None if uri is None else unquote(uri),
                                     "payload_bytes": int(headers["x-payload-length"]), "payload_digest": headers["warc-payload-digest"].partition(":")[2],
                                     "record_type": headers["warc-type"], "refers_to": _page(headers.get("x-refers-to-page")),
                                     "payload": None if revisit else block})
                        held += len(block)
                        if held > 4 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return paths.select("path").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def roundtrip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages and read the archives back, one task an archive."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    index = f"{folder}-index"
    write_archives(pages, folder, key, url, html).write.parquet(index)
    made = spark.read.parquet(index)
    return read_archives(made.repartition(max(1, min(made.count(), 100_000)), "path"))
