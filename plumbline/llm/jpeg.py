"""Baseline JPEG in numpy: a decoder of marker segments and Huffman scans to DC-only luminance, and a matching encoder.

The decoder reads any grey or interleaved colour baseline file: it decodes every restart interval of a scan at the
same time, one symbol of each a step, so that a file with many intervals costs few numpy calls. Only DC coefficients
are kept: an eighth-size luminance picture, one sample for each 8x8 block.

The encoder stores a plane of bytes so that this picture is the plane again: each byte becomes one flat 8x8 block.
With a DC quantiser of 8 a block's DC coefficient is its sample less 128, so nothing is lost. Each row of blocks is a
restart interval.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import cache

import numpy as np

#: Baseline limit on either side, in pixels and in blocks.
MOST_PIXELS = 65535
MOST_BLOCKS = MOST_PIXELS // 8

#: DC categories 0 to 8 have codes of 9 to 1 bits: code and magnitude together take nine bits, whatever the difference.
#: The sum of 2**-length is below one, and no code is all ones.
_DC_LENGTHS = np.arange(9, 0, -1)
#: The AC table has one symbol, end of block, of one bit.
_AC_SYMBOLS = b"\x00"


class JpegError(ValueError):
    """A stream that is no baseline JPEG, or a damaged one."""


# --- encoder ---------------------------------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(rows: int, cols: int) -> bytes:
    counts = [int((_DC_LENGTHS == n).sum()) for n in range(1, 17)]
    dc = bytes(counts) + bytes(int(s) for n in range(1, 17) for s in np.flatnonzero(_DC_LENGTHS == n))
    ac = bytes([1] + [0] * 15) + _AC_SYMBOLS
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00"),
            _segment(0xDB, b"\x00" + bytes([8] + [1] * 63)),
            _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, cols * 8, 1) + b"\x01\x11\x00"),
            _segment(0xC4, b"\x00" + dc),
            _segment(0xC4, b"\x10" + ac),
            _segment(0xDD, struct.pack(">H", cols)),
            _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
        )
    )


def _dc_codes() -> np.ndarray:
    """The nine bits of each difference from -255 to 255: the category's code, then its magnitude bits."""
    code, codes, last = 0, {}, 0
    for n in range(1, 17):
        for cat in np.flatnonzero(_DC_LENGTHS == n):
            code <<= n - last
            last = n
            codes[int(cat)] = code
            code += 1
    out = np.zeros(511, dtype=np.uint16)
    for d in range(-255, 256):
        cat = abs(d).bit_length()
        out[d + 255] = (codes[cat] << cat) | (d if d >= 0 else d + (1 << cat) - 1)
    return out


_CODES = _dc_codes()


def encode(plane: np.ndarray) -> bytes:
    """A baseline JPEG whose DC-only luminance is `plane` (rows x cols of uint8, cols a multiple of four)."""
    rows, cols = plane.shape
    if not (0 < rows <= MOST_BLOCKS and 0 < cols <= MOST_BLOCKS) or cols % 4:
        raise JpegError(f"{rows} x {cols} blocks don't fit a baseline file")
    level = plane.astype(np.int16) - 128
    diff = level.copy()
    diff[:, 1:] -= level[:, :-1]
    bits = (_CODES[diff + 255].astype(np.uint64) << np.uint64(1)).reshape(-1, 4)  # ten bits with the end of block
    forty = (bits[:, 0] << np.uint64(30)) | (bits[:, 1] << np.uint64(20)) | (bits[:, 2] << np.uint64(10)) | bits[:, 3]
    scan = forty.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].reshape(rows, -1)
    # a zero byte after each 0xFF, and a restart marker after each row but the last
    width = scan.shape[1]
    full = scan == 0xFF
    lengths = width + full.sum(axis=1) + 2
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    out = np.zeros(int(lengths.sum()), dtype=np.uint8)
    shift = np.cumsum(full, axis=1) - full
    out[(starts[:, None] + np.arange(width) + shift).ravel()] = scan.ravel()
    out[starts + lengths - 2] = 0xFF
    out[starts + lengths - 1] = 0xD0 + np.arange(rows) % 8
    return _header(rows, cols) + out[:-2].tobytes() + b"\xff\xd9"


# --- decoder ---------------------------------------------------------------------------------------------------------


@dataclass
class Component:
    """A colour component of a frame: identifier, sampling factors, quantiser, and the scan's Huffman tables."""

    ident: int
    h: int
    v: int
    quant: int
    dc: int = 0
    ac: int = 0


@dataclass
class Frame:
    """What the marker segments say, and where the scan's entropy-coded bytes begin."""

    height: int
    width: int
    parts: list[Component]
    quants: dict[int, np.ndarray]
    tables: dict[int, np.ndarray]
    restart: int
    scan: int


@cache
def _lookup(lengths: bytes, symbols: bytes) -> np.ndarray:
    """For each value of the next sixteen bits the code's length * 256 + its symbol; zero where no code fits."""
    table, code, at = np.zeros(1 << 16, dtype=np.uint32), 0, 0
    for n in range(1, 17):
        for _ in range(lengths[n - 1]):
            lo = code << (16 - n)
            if lo + (1 << (16 - n)) > 1 << 16 or at >= len(symbols):
                raise JpegError("bad Huffman table")
            table[lo : lo + (1 << (16 - n))] = n * 256 + symbols[at]
            at += 1
            code += 1
        code <<= 1
    return table


def parse(blob: bytes) -> Frame:
    """Read the marker segments up to the start of the scan."""
    if blob[:2] != b"\xff\xd8":
        raise JpegError("no start of image")
    at, quants, tables, frame, restart = 2, {}, {}, None, 0
    while at + 4 <= len(blob):
        if blob[at] != 0xFF:
            raise JpegError(f"no marker at {at}")
        marker = blob[at + 1]
        if marker == 0xFF or marker == 0x01 or 0xD0 <= marker <= 0xD7:
            at += 1 if marker == 0xFF else 2
            continue
        (size,) = struct.unpack_from(">H", blob, at + 2)
        body = blob[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide, name = body[0] >> 4, body[0] & 15
                quants[name] = np.frombuffer(body, dtype=">u2" if wide else np.uint8, count=64, offset=1).astype(np.int32)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = _lookup(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xC0:
            depth, height, width, n = struct.unpack_from(">BHHB", body)
            if depth != 8 or not height or not width:
                raise JpegError("not an 8-bit frame of known size")
            frame = (height, width, [Component(c[0], c[1] >> 4, c[1] & 15, c[2]) for c in (body[6 + 3 * i : 9 + 3 * i] for i in range(n))])
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise JpegError("not a baseline frame")
        elif marker == 0xDD:
            (restart,) = struct.unpack_from(">H", body)
        elif marker == 0xDA:
            if frame is None or body[0] != len(frame[2]):
                raise JpegError("only scans of all components are read")
            for i in range(body[0]):
                part = next((p for p in frame[2] if p.ident == body[1 + 2 * i]), None)
                if part is None:
                    raise JpegError("the scan names an unknown component")
                part.dc, part.ac = body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15
            return Frame(*frame, quants, tables, restart, at)
        elif marker == 0xD9:
            break
    raise JpegError("no scan")


def _intervals(blob: bytes, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The scan's bytes without stuffing and markers, and where each restart interval begins in them."""
    raw = np.frombuffer(blob, dtype=np.uint8)[start:]
    marks = np.flatnonzero(raw[:-1] == 0xFF)
    after = raw[marks + 1]
    ends = marks[(after != 0) & ((after < 0xD0) | (after > 0xD7)) & (after != 0xFF)]
    stop = int(ends[0]) if len(ends) else len(raw)
    inside = marks < stop
    marks, after = marks[inside], after[inside]
    restarts = marks[(after >= 0xD0) & (after <= 0xD7)]
    keep = np.ones(stop, dtype=bool)
    keep[marks[after == 0] + 1] = False
    keep[restarts] = False
    keep[restarts + 1] = False
    before = np.concatenate(([0], np.cumsum(keep)))
    return raw[:stop][keep], np.concatenate(([0], before[restarts]))


def _peek(words: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The sixteen bits from each bit position; words holds the 32 bits from each byte."""
    return (words[bit >> 3] >> (16 - (bit & 7)).astype(np.uint32)) & np.uint32(0xFFFF)


def decode(blob: bytes) -> tuple[np.ndarray, Frame]:
    """The DC-only luminance, a uint8 sample for each 8x8 block of the first component, and the frame."""
    return decode_many([blob])[0]


def decode_many(blobs: list[bytes]) -> list[tuple[np.ndarray, Frame]]:
    """decode() of each file. Files with the same sampling and Huffman tables advance together."""
    out: list[tuple[np.ndarray, Frame] | None] = [None] * len(blobs)
    frames = [parse(b) for b in blobs]
    alike: dict[tuple, list[int]] = {}
    for i, f in enumerate(frames):
        if len(f.parts) == 1:  # not interleaved: one block a unit
            f.parts[0].h = f.parts[0].v = 1
        try:
            key = tuple((p.h, p.v, id(f.tables[p.dc]), id(f.tables[16 + p.ac])) for p in f.parts)
        except KeyError as e:
            raise JpegError("a table is missing") from e
        alike.setdefault(key, []).append(i)
    for group in alike.values():
        for i, plane in zip(group, _lockstep([blobs[i] for i in group], [frames[i] for i in group])):
            out[i] = (plane, frames[i])
    return out


def _lockstep(blobs: list[bytes], frames: list[Frame]) -> list[np.ndarray]:
    """Planes of files that share their tables: a step reads one Huffman symbol in each interval that is still open."""
    parts = frames[0].parts
    hmax, vmax = max(p.h for p in parts), max(p.v for p in parts)
    h, v = parts[0].h, parts[0].v
    pieces, lanes, shapes, at, room = [], [], [], 0, 0
    for blob, f in zip(blobs, frames):
        data, starts = _intervals(blob, f.scan)
        across, down = -(-f.width // (8 * hmax)), -(-f.height // (8 * vmax))
        per = f.restart or across * down
        n = -(-across * down // per)
        if len(starts) < n:
            raise JpegError("restart intervals are missing")
        first = np.arange(n) * per
        ends = np.append(starts[1:n], len(data))
        full = np.full(n, 1)
        lanes.append(((starts[:n] + at) * 8, (ends + at) * 8, np.minimum(per, across * down - first), first, full * across, full * room))
        pieces += [data, np.full(8, 0xFF, np.uint8)]
        at += len(data) + 8
        shapes.append((room, down * v, across * h))
        room += down * v * across * h
    bit, limit, count, first, across, base = (np.concatenate(x) for x in zip(*lanes))
    padded = np.concatenate(pieces).astype(np.uint32)
    words = (padded[:-3] << np.uint32(24)) | (padded[1:-2] << np.uint32(16)) | (padded[2:-1] << np.uint32(8)) | padded[3:]
    last = len(words) * 8 - 1
    tables = [(frames[0].tables[p.dc], frames[0].tables[16 + p.ac]) for p in parts]
    order = [(i, y, x) for i, p in enumerate(parts) for y in range(p.v) for x in range(p.h)]
    luma = np.zeros(room, dtype=np.int32)
    before = np.zeros((len(parts), len(bit)), dtype=np.int64)
    for step in range(int(count.max())):
        lane = np.flatnonzero(count > step)
        unit = first[lane] + step
        corner = base[lane] + unit // across[lane] * v * across[lane] * h + unit % across[lane] * h
        here = bit[lane]
        for i, y, x in order:
            dc, ac = tables[i]
            entry = dc[_peek(words, here)]
            if not entry.all():
                raise JpegError("bad DC code")
            here = here + (entry >> 8)
            size = (entry & 255).astype(np.int64)
            extra = _peek(words, np.minimum(here, last)).astype(np.int64) >> (16 - size)
            here += size
            before[i, lane] += extra - np.where(extra < (1 << size) >> 1, (1 << size) - 1, 0)
            if i == 0:
                luma[corner + y * across[lane] * h + x] = before[0, lane]
            left, k = np.arange(len(lane)), np.ones(len(lane), dtype=np.int64)
            while len(left):  # AC symbols are only passed over
                entry = ac[_peek(words, np.minimum(here[left], last))]
                if not entry.all():
                    raise JpegError("bad AC code")
                here[left] += (entry >> 8) + (entry & 15)
                symbol = entry & 255
                more = (symbol & 15 > 0) | (symbol == 0xF0)
                if not more.any():
                    break
                k += (symbol >> 4) + 1
                more &= k < 64
                left, k = left[more], k[more]
        if (here > limit[lane]).any():
            raise JpegError("the scan ends early")
        bit[lane] = here
    out = []
    for f, (start, down, wide) in zip(frames, shapes):
        try:
            quant = int(f.quants[f.parts[0].quant][0])
        except KeyError as e:
            raise JpegError("a table is missing") from e
        plane = luma[start : start + down * wide].reshape(down, wide)
        rows, cols = -(-f.height * v // (8 * vmax)), -(-f.width * h // (8 * hmax))
        out.append(np.clip((plane[:rows, :cols] * quant + 4 >> 3) + 128, 0, 255).astype(np.uint8))
    return out
