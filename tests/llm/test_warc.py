from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pytest

from plumbline.llm import warc

SCHEMA = "page_id long, url string, html string, archive string, key string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)


def brute(rows):
    keep = {}
    for i, _, h in rows:
        keep[h or ""] = max(keep.get(h or "", -1), i)
    out = {}
    for i, _, h in rows:
        b = (h or "").encode()
        k = keep[h or ""]
        out[i] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if k == i else "revisit", None if k == i else k)
    return out


def test_archives_give_back_every_page(spark):
    rows = [(i, f"http://h/{i} \n é", ["same", "", None, f"<p>{i}é</p>\r\n\r\nWARC/1.1 x", "z" * 100_000][i % 5]) for i in range(60)]
    got = {r["page_id"]: tuple(r)[1:] for r in warc.archive(pages(spark, rows)).collect()}
    assert got == brute(rows)


def test_smaller_payloads_stay_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive(pages(spark, rows), least=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_awkward_rows(spark):
    rows = [(None, None, None), (None, "u", "only"), (5, "u", "t"), (5, "u", "t"), (4, None, "t")]
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive(pages(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 0, "response", None), (None, 4, "response", None), (5, 1, "response", None), (5, 1, "response", None), (4, 1, "revisit", 5)], key=str)
    assert warc.archive(pages(spark, [])).count() == 0


def one(n, members):
    """An archive of n records as one or several gzip members."""
    raw = [warc.record(i, f"http://x/{i}", f"page {i}".encode() * i, None, False) for i in range(n)]
    if members == 1:
        return gzip.compress(b"".join(raw))
    cut = b"".join(raw)
    step = -(-len(cut) // members)
    return b"".join(gzip.compress(cut[i : i + step]) for i in range(0, len(cut), step))


@pytest.mark.parametrize("members", [1, 2, 7])
def test_normalised_members_open_alone(members):
    target, index = io.BytesIO(), io.BytesIO()
    assert warc.normalise(io.BytesIO(one(9, members)), target, index) == 9
    listed = list(warc.entries(index.getvalue()))
    assert sum(e.length for e in listed) == len(target.getvalue()) and [e.ident for e in listed] == [f"<urn:page:{i}>" for i in range(9)]
    for i in (8, 0, 4):
        r = warc.member(target, listed[i])
        assert warc.payload_of(r)[0] == len(f"page {i}") * i
        assert gzip.decompress(target.getvalue()[listed[i].offset :][: listed[i].length]) == r.raw
    again = io.BytesIO()
    assert warc.normalise(io.BytesIO(target.getvalue()), again, io.BytesIO()) == 9 and again.getvalue() == target.getvalue()


def test_records_are_not_held_together(monkeypatch):
    """A long archive passes in pieces."""
    monkeypatch.setattr(warc, "CHUNK", 512)
    target = io.BytesIO()
    assert warc.normalise(io.BytesIO(one(40, 1)), target, io.BytesIO()) == 40


@pytest.mark.parametrize("spoil", [lambda b: b[:-9], lambda b: b[:40], lambda b: gzip.compress(b"no archive"), lambda b: gzip.compress(gzip.decompress(b)[:-3])])
def test_damage_is_told(spoil):
    with pytest.raises(warc.Damaged):
        warc.normalise(io.BytesIO(spoil(one(3, 1))), io.BytesIO(), io.BytesIO())


def test_wrong_digest_is_told():
    (r,) = warc.records(io.BytesIO(warc.record(1, "u", b"payload", None, False).replace(b"payload\r\n", b"paylord\r\n")))
    with pytest.raises(warc.Damaged):
        warc.payload_of(r)


def test_archives_roll_over(spark):
    from plumbline.llm.common import Scratch, fresh_dir

    rows = pages(spark, [(i, "u", f"{i}" * 1000) for i in range(30)]).coalesce(1)
    scratch = Scratch(spark, "t")
    written = scratch.cut(warc.write_archives(warc.plan_revisits(rows, scratch), fresh_dir(spark, "roll"), archive_bytes=5000))
    assert written.count() > 5 and sum(r["records"] for r in written.collect()) == 30
