from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import jpeg, media
from tests.llm.made import awkward, frame


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=4000))
def test_payloads_come_back(raw):
    stored = media.store(media.pad(raw))
    ((payload, feature),) = media.read([stored])
    assert payload == media.pad(raw) and len(payload) % 576 == 0 and payload.startswith(raw) and set(payload[len(raw) :]) <= {255}
    assert media.store(media.pad(raw)) == stored and feature.startswith("192x")


@pytest.mark.parametrize("n", [0, 576, 24 * 8191, 24 * 8191 + 1, 3_000_000])
def test_sizes(n):
    raw = np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes()
    assert media.read([media.store(media.pad(raw))])[0][0] == media.pad(raw)


def test_more_files_for_larger_payloads(monkeypatch):
    monkeypatch.setattr(media, "FILE_BYTES", 576 * 2)
    raws = [b"a" * 3000, b"b", b"c" * 1152]
    stored = [media.store(media.pad(r)) for r in raws]
    assert len(media.split(stored[0])) == 3 and [p for p, _ in media.read(stored)] == [media.pad(r) for r in raws]


class Bits:
    def __init__(self):
        self.out, self.acc, self.n = bytearray(), 0, 0

    def put(self, value, size):
        for i in range(size - 1, -1, -1):
            self.acc, self.n = self.acc << 1 | (value >> i & 1), self.n + 1
            if self.n == 8:
                self.out.append(self.acc)
                if self.acc == 0xFF:
                    self.out.append(0)
                self.acc = self.n = 0

    def done(self):
        while self.n:
            self.put(1, 1)
        return bytes(self.out)


def colour_file(rng, width, height, restart):
    """A 4:2:0 file of random coefficients with AC terms, by a plain encoder, and its luminance DC values."""
    dc_syms, ac_syms = list(range(12)), [r << 4 | s for r in range(16) for s in range(1, 11)] + [0x00, 0xF0]
    across, down = -(-width // 16), -(-height // 16)
    luma = np.zeros((down * 2, across * 2), int)
    seg = lambda m, b: struct.pack(">BBH", 0xFF, m, len(b) + 2) + b
    head = b"\xff\xd8" + seg(0xFE, b"a comment") + seg(0xDB, b"\x00" + bytes([4] * 64) + b"\x11" + struct.pack(">64H", *[6] * 64))
    head += seg(0xC0, struct.pack(">BHHB", 8, height, width, 3) + b"\x01\x22\x00\x02\x11\x01\x03\x11\x01")
    for kind, syms, n in ((0x00, dc_syms, 4), (0x10, ac_syms, 8)):
        head += seg(0xC4, bytes([kind]) + bytes(len(syms) if i == n else 0 for i in range(1, 17)) + bytes(syms))
    if restart:
        head += seg(0xDD, struct.pack(">H", restart))
    head += seg(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x3f\x00")

    def number(bits, v):
        return v if v >= 0 else v + (1 << bits) - 1

    body, bits, last, unit = b"", Bits(), [0, 0, 0], 0
    for y in range(down):
        for x in range(across):
            if restart and unit and unit % restart == 0:
                body += bits.done() + bytes([0xFF, 0xD0 + (unit // restart - 1) % 8])
                bits, last = Bits(), [0, 0, 0]
            for c, (v, h) in enumerate(((2, 2), (1, 1), (1, 1))):
                for i in range(v * h):
                    dc = int(rng.integers(-200, 200))
                    diff = dc - last[c]
                    last[c] = dc
                    size = abs(diff).bit_length()
                    bits.put(dc_syms.index(size), 4)
                    bits.put(number(size, diff), size)
                    if c == 0:
                        luma[y * 2 + i // 2, x * 2 + i % 2] = dc
                    k = 1
                    for _ in range(int(rng.integers(0, 4))):
                        run, size = int(rng.integers(0, 20)), int(rng.integers(1, 6))
                        if k + run > 62:
                            break
                        if run > 15:
                            bits.put(ac_syms.index(0xF0), 8)
                            run, k = run - 16, k + 16
                        bits.put(ac_syms.index(run << 4 | size), 8)
                        bits.put(int(rng.integers(0, 1 << size)), size)
                        k += run + 1
                    if k < 64:
                        bits.put(ac_syms.index(0), 8)
            unit += 1
    return head + body + bits.done() + b"\xff\xd9", luma


@pytest.mark.parametrize("width,height,restart", [(16, 16, 0), (50, 70, 0), (120, 33, 3), (64, 64, 1)])
def test_colour_files_of_another_encoder(width, height, restart):
    blob, dc = colour_file(np.random.default_rng(width), width, height, restart)
    plane, frame_ = jpeg.decode(blob)
    want = np.clip((dc * 4 + 4 >> 3) + 128, 0, 255)[: -(-height // 8), : -(-width // 8)]
    assert (frame_.width, frame_.height) == (width, height) and (plane == want).all()


def test_damage_is_told():
    good = media.store(media.pad(b"some text " * 100))
    for bad in (b"", b"\xff\xd8", good[:300], good[:-60], b"\x00" + good[1:], good.replace(b"\xff\xc0", b"\xff\xc2")):
        with pytest.raises(jpeg.JpegError):
            jpeg.decode(bad)


def test_hash_shows_change():
    plane = np.tile(np.arange(0, 216, 9, dtype=np.uint8), (24, 1))
    assert media.thumbnail_hash(plane) == "f" * 16 and media.thumbnail_hash(plane[:, ::-1]) == "0" * 16


def test_rows(spark):
    rows = media.describe(media.media_column(awkward(spark))).collect()
    assert len(rows) == 12
    texts = {r["doc_id"]: r["text"] or "" for r in awkward(spark).collect()}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        payload = media.pad(raw)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r["media_sha256"] == hashlib.sha256(media.store(payload)).hexdigest()
    assert media.describe(media.media_column(frame(spark, []))).count() == 0
