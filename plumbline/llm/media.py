"""Media columns: binary payloads as baseline JPEG files, read back to DC-only thumbnails and hashes.

A payload is written as the luminance of one or more files, a byte a block, so that the DC-only picture is the payload
itself; see jpeg.py. The stored form of a payload is its files one after the other.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm import jpeg
from plumbline.llm.common import tune

#: Payloads are padded with this byte to a positive multiple of UNIT: a picture of 24 x 24 blocks.
PAD, UNIT, SIDE = 255, 576, 24
#: Payloads of more bytes go to a further file.
FILE_BYTES = (jpeg.MOST_BLOCKS // SIDE) * SIDE * (jpeg.MOST_BLOCKS // SIDE) * SIDE
#: The thumbnail hash compares the means of 8 x 9 cells.
CELLS = (8, 9)


def pad(raw: bytes) -> bytes:
    return raw + bytes([PAD]) * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def store(payload: bytes) -> bytes:
    """A padded payload as JPEG files. Pictures are 24 blocks wide, or the least multiple of 24 that keeps them low enough."""
    files = []
    for at in range(0, len(payload), FILE_BYTES):
        part = np.frombuffer(payload, dtype=np.uint8)[at : at + FILE_BYTES]
        wide = SIDE
        while len(part) % wide or len(part) // wide > jpeg.MOST_BLOCKS:
            wide += SIDE
        files.append(jpeg.encode(part.reshape(-1, wide)))
    return b"".join(struct.pack(">Q", len(f)) + f for f in files) if len(files) > 1 else files[0]


def split(stored: bytes) -> list[bytes]:
    """The JPEG files of a stored form; several have their lengths before them."""
    if stored[:2] == b"\xff\xd8":
        return [stored]
    files, at = [], 0
    while at < len(stored):
        (n,) = struct.unpack_from(">Q", stored, at)
        files.append(stored[at + 8 : at + 8 + n])
        at += 8 + n
    return files


def thumbnail_hash(plane: np.ndarray) -> str:
    """64 bits as hex: whether each of 8 x 9 cells is darker than its right neighbour."""
    rows = np.linspace(0, plane.shape[0], CELLS[0] + 1).astype(int)
    cols = np.linspace(0, plane.shape[1], CELLS[1] + 1).astype(int)
    sums = np.pad(np.cumsum(np.cumsum(plane, axis=0, dtype=np.int64), axis=1), ((1, 0), (1, 0)))
    cell = sums[rows[1:]][:, cols[1:]] - sums[rows[:-1]][:, cols[1:]] - sums[rows[1:]][:, cols[:-1]] + sums[rows[:-1]][:, cols[:-1]]
    area = np.maximum(1, np.diff(rows)[:, None] * np.diff(cols)[None, :])
    mean = cell / area
    return np.packbits(mean[:, :-1] < mean[:, 1:]).tobytes().hex()


def read(stored: list[bytes]) -> list[tuple[bytes, str]]:
    """(payload, feature) of each stored form, from its bytes alone: dimensions in pixels and the thumbnail's hash, for each file."""
    files = [split(x) for x in stored]
    decoded = iter(jpeg.decode_many([blob for own in files for blob in own]))
    out = []
    for own in files:
        got = [next(decoded) for _ in own]
        marks = ";".join(f"{f.width}x{f.height}:{thumbnail_hash(plane)}" for plane, f in got)
        out.append((b"".join(plane.tobytes() for plane, _ in got), marks))
    return out


def _runs(values: list[bytes], limit: int = 1 << 21) -> Iterator[list[bytes]]:
    """Neighbouring values of about `limit` bytes in all."""
    run, size = [], 0
    for x in values:
        if run and size + len(x) > limit:
            yield run
            run, size = [], 0
        run.append(x)
        size += len(x)
    if run:
        yield run


def media_column(docs: DataFrame, column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media), a row for each row: the text's UTF-8, padded and stored. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [v.as_py() or b"" for v in batch.column(1)]
            media = pa.array([store(pad(r)) for r in raws], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(r) for r in raws], pa.int64()), media], names=["doc_id", "n_bytes", "media"])

    tune(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col(column).cast("string").cast("binary")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """What the stored bytes say: payload size, digest and tail check sum, the stored form's size and digest, features.

    A row for each row of media (doc_id, n_bytes, media). Repeated rows repeat; no rows in, no rows out. A damaged
    file raises JpegError.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for run_ in _runs(batch.column(2).to_pylist()):
                for stored, (payload, feature) in zip(run_, read(run_)):
                    out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            cols = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=[*batch.schema.names[:2], *NAMES])

    return media.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


NAMES = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
