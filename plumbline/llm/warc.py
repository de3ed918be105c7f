"""WARC archives: written as one gzip stream each, then normalised to one member a record with an index beside it.

Files go to the shared folder under names that no other attempt of a task uses, and a file counts only once the row
that names it is in a written table. A task that is repeated after a loss leaves an unused file, never a mixed one.
Archives are closed at a bounded size, so no file grows with a partition.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, drop_dir, fresh_dir, tune

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
#: An archive is closed after so many bytes before compression.
ARCHIVE_BYTES = 128 << 20
LEVEL = 4
CHUNK = 1 << 20


class Damaged(ValueError):
    """An archive that breaks the format, or whose payload doesn't have the digest it claims."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None) -> str:
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "about:blank")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit holds the HTTP header alone, which still tells the payload's length."""
    digest = payload_digest(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Record(NamedTuple):
    """A record's headers in lower case, its block, and its bytes as they stand in the archive."""

    headers: dict[str, str]
    block: bytes
    raw: bytes


def records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an uncompressed archive, one in memory at a time."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise Damaged("a record doesn't begin with its version")
        lines, headers = [line], {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise Damaged("a record ends in its headers")
            lines.append(line)
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers.get("content-length", -1))
        block = stream.read(size) if size >= 0 else b""
        if size < 0 or len(block) != size:
            raise Damaged("a record's block is short")
        tail = stream.read(4)
        if tail != b"\r\n\r\n":
            raise Damaged("a record doesn't end in two line breaks")
        yield Record(headers, block, b"".join(lines) + line + block + tail)


class Inflated(io.RawIOBase):
    """The bytes of a gzip file of one or many members, inflated once and in pieces."""

    def __init__(self, source: BinaryIO) -> None:
        self.source, self.rest, self.ready = source, b"", b""
        self.z = zlib.decompressobj(31)
        self.begun = False

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.ready:
            if not self.rest:
                self.rest = self.source.read(CHUNK)
                if not self.rest:
                    if self.begun and not self.z.eof:
                        raise Damaged("the gzip stream is cut off")
                    return 0
            if self.z.eof:
                self.z, self.begun = zlib.decompressobj(31), False
            try:
                self.ready = self.z.decompress(self.rest, CHUNK)
            except zlib.error as e:
                raise Damaged(str(e)) from e
            self.begun = True
            self.rest = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
        n = min(len(buffer), len(self.ready))
        buffer[:n] = self.ready[:n]
        self.ready = self.ready[n:]
        return n


class Entry(NamedTuple):
    """A line of the sidecar index: where a record's member lies, and what the record is."""

    offset: int
    length: int
    kind: str
    ident: str
    digest: str


def normalise(source: BinaryIO, target: BinaryIO, index: BinaryIO, level: int = LEVEL) -> int:
    """Rewrite a gzip archive, whatever its members, as one member a record; returns the number of records.

    The stream is inflated once. index gets a line a record: offset, length, type, identifier and payload digest.
    """
    at = n = 0
    for r in records(io.BufferedReader(Inflated(source), CHUNK)):
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = z.compress(r.raw) + z.flush()
        target.write(member)
        index.write(f"{at} {len(member)} {r.headers['warc-type']} {r.headers['warc-record-id']} {r.headers.get('warc-payload-digest', '-')}\n".encode())
        at += len(member)
        n += 1
    return n


def entries(index: bytes) -> Iterator[Entry]:
    for line in index.decode().splitlines():
        offset, length, *rest = line.split(" ")
        yield Entry(int(offset), int(length), *rest)


def member(source, entry: Entry) -> Record:
    """The record of an index entry, read from its offset alone."""
    source.seek(entry.offset)
    z = zlib.decompressobj(31)
    raw = z.decompress(source.read(entry.length))
    if not z.eof or z.unused_data:
        raise Damaged("an index entry doesn't cover one member")
    (r,) = records(io.BytesIO(raw))
    return r


def payload_of(r: Record) -> tuple[int, str]:
    """(bytes, digest) of a record's full payload; of a response they are taken from the payload itself."""
    head, sep, payload = r.block.partition(b"\r\n\r\n")
    if not sep:
        raise Damaged("a block without an HTTP header")
    claimed = r.headers["warc-payload-digest"].removeprefix("sha1:")
    if r.headers["warc-type"] == "revisit":
        length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return length, claimed
    digest = payload_digest(payload)
    if digest != claimed:
        raise Damaged(f"payload digest {digest}, not {claimed}")
    return len(payload), digest


def _page(urn: str | None) -> int | None:
    text = (urn or "<none>").strip("<>").removeprefix(URN)
    return None if text == "none" else int(text)


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified URI and the path in it."""
    scheme, _, path = uri.partition(":")
    return pafs.FileSystem.from_uri(f"file:///{path.lstrip('/')}" if scheme == "file" else uri)


def plan_revisits(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is the page that holds an equal payload, or null for a response.

    Digests are aggregated before anything moves, and only those of several pages are joined back; a digest that a
    third of all pages share is one row on the small side, and the large side's partition can be split.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"))
    keyed = rows.withColumn("key", F.when(F.length("payload") >= least, F.sha2("payload", 256)))
    twins = keyed.filter("key is not null").groupBy("key").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1")
    twins = scratch.cut(twins.select(F.col("key").alias("k_"), "keeper"))
    if twins.isEmpty():
        return rows.withColumn("refers_to", F.lit(None).cast("long"))
    joined = keyed.join(twins, F.col("key") == F.col("k_"), "left")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("keeper"), F.col("page_id").isNull() & F.col("keeper").isNotNull()), F.col("keeper"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL) -> DataFrame:
    """(archive, records): each partition's pages as archives in `folder`, every archive one gzip stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        fs.create_dir(path, recursive=True)
        name, out, z, size, n = "", None, None, 0, 0

        def close() -> pa.RecordBatch:
            out.write(z.flush())
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "records"])

        for batch in batches:
            for page, url, payload, refers in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, z = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                raw = record(page.as_py(), url.as_py(), payload.as_py(), refers.as_py(), refers.is_valid)
                out.write(z.compress(raw))
                size, n = size + len(raw), n + 1
                if size >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return planned.select("page_id", "url", "payload", "refers_to").mapInArrow(run, "archive string, records long")


def normalise_archives(archives: DataFrame, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """(archive, records): each archive of `source` rewritten in `target` as one member a record, with its .idx file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (fs, old), (_, new) = _store(source), _store(target)
        fs.create_dir(new, recursive=True)
        for batch in batches:
            for name, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                done = f"{uuid.uuid4().hex}.warc.gz"
                with fs.open_input_stream(f"{old}/{name}", compression=None) as a, fs.open_output_stream(f"{new}/{done}", compression=None) as b, fs.open_output_stream(f"{new}/{done}.idx", compression=None) as c:
                    n = normalise(a, b, c, level)
                if n != count:
                    raise Damaged(f"{name} has {n} records, not {count}")
                yield pa.RecordBatch.from_arrays([pa.array([done]), pa.array([n], pa.int64())], names=["archive", "records"])

    return archives.mapInArrow(run, "archive string, records long")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """A row for each record, from the archives' members as their indexes place them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}/{name}.idx", compression=None) as f:
                    index = f.read()
                rows = []
                with fs.open_input_file(f"{path}/{name}") as f:
                    for e in entries(index):
                        r = member(f, e)
                        revisit = r.headers["warc-type"] == "revisit"
                        rows.append((_page(r.headers["warc-record-id"]), *payload_of(r), r.headers["warc-type"], _page(r.headers["warc-refers-to"]) if revisit else None))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(COLUMNS))

    return archives.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every page as a record, normalise the archives, and return what is read back, a row for each row of pages.

    pages: page_id long, url string, html string (null: empty). Of pages with equal payloads of `least` bytes or more
    the one with the largest page_id is a response and the others revisit it. Rows that repeat that page_id are
    responses too; a null page_id never keeps a payload unless all its equals have none, and then all are responses.
    No rows in, no rows out; other columns are ignored.
    """
    spark = pages.sparkSession
    tune(spark)
    scratch = Scratch(spark, "warc")
    raw, done = fresh_dir(spark, "warc-raw"), fresh_dir(spark, "warc")
    written = scratch.cut(write_archives(plan_revisits(pages, scratch, least), raw))
    spread = lambda df: df.repartition(max(1, df.count()))  # noqa: E731  a row is a file's name
    normal = scratch.cut(normalise_archives(spread(written), raw, done))
    drop_dir(spark, raw)  # the normalised archives are named in a written table by now
    return read_archives(spread(normal), done)
