from __future__ import annotations

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import packing
from plumbline.llm.tokens import encoder
from tests.llm.made import awkward, frame


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 2048), max_size=120))
def test_windows_hold_every_item_once_within_capacity(sizes):
    got = packing.pack(sizes)
    assert sorted(i for w in got for i in w) == list(range(len(sizes))) and all(sum(sizes[i] for i in w) <= 2048 for w in got)


def test_differencing_balances():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 512) for _ in range(800)]
    sums = [s for s, _ in packing.differencing(sizes, 50)]
    assert len(sums) == 50 and sum(sums) == sum(sizes) and max(sums) - min(sums) <= 12
    assert [s for s, _ in packing.differencing([8, 7, 6, 5, 4], 2)] == [14, 16]  # the textbook case


def test_cuts_cover_a_document():
    for n in (1, 511, 512, 2047, 2048, 2049, 5000, 100_000):
        c = packing.cuts(n)
        assert sum(c) == n and all(0 < x <= 2048 for x in c)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_fast_ids_equal_those_of_the_vocabulary(text):
    enc = encoder()
    assert enc.ids(text).tolist() == enc._plain(text)


def test_fast_ids_are_used():
    assert encoder().fast is not None


def test_added_tokens_keep_their_ids():
    from tokenizers import Tokenizer

    import public_tokenizers
    from plumbline.llm.tokens import VOCABULARY

    plain = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    for text in ("a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext>", "a <|endof text|>"):
        assert encoder().ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encoder().ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def check(rows, texts):
    """Every id in one piece, digests right, sequences gapless."""
    enc = encoder()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids = np.array(enc._plain(texts[i] or "") + [1], dtype="<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return sum(r["length"] for r in rows) / (2048 * len(by_seq))


def test_sequences(spark, monkeypatch):
    rng = random.Random(8)
    texts = {i: " ".join(f"word{rng.randrange(999)}" for _ in range(int(rng.expovariate(1 / 300)))) for i in range(300)}
    texts[300] = None
    rows = packing.sequences(frame(spark, list(texts.items()))).collect()
    assert check(rows, texts) > 0.97
    monkeypatch.setattr(packing, "GROUP", 50)
    check(packing.sequences(frame(spark, list(texts.items()))).collect(), texts)


def test_awkward_rows(spark):
    rows = packing.sequences(awkward(spark)).collect()
    texts = {r["doc_id"]: r["text"] for r in awkward(spark).collect()}
    twice = [r for r in rows if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0]["ids_crc32"] == twice[1]["ids_crc32"]
    seen, one = set(), []
    for r in rows:
        if (r["doc_id"], r["start"]) not in seen or r["doc_id"] is None:
            seen.add((r["doc_id"], r["start"]))
            one.append(r)
    enc = encoder()
    assert {r["doc_id"]: r["doc_tokens"] for r in one} == {i: len(enc._plain(t or "")) + 1 for i, t in texts.items()}
    assert packing.sequences(frame(spark, [])).count() == 0


def test_places_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 60)
    monkeypatch.setattr(packing, "COPIES", 8)
    rng = random.Random(9)
    texts = [" ".join(f"word{rng.randrange(999)}" for _ in range(int(rng.expovariate(1 / 300)))) for i in range(200)]
    rows = [*enumerate(texts), *[(7, "the same row")] * 150, *[(None, "no id")] * 5, (None, None), (2**62 + 1, "an id of many digits")]
    docs = frame(spark, rows)
    got = [sorted(packing.sequences(docs.repartition(n) if n else docs.orderBy(docs["text"].desc()).coalesce(1)).collect(), key=str) for n in (0, 1, 3, 8)]
    assert all(g == got[0] for g in got) and (2**62 + 1) in {r["doc_id"] for r in got[0]}
    same = [r["sequence_id"] >> 24 for r in got[0] if r["doc_id"] == 7 and r["length"] < 10]
    assert len(same) == 150 and len(set(same)) > 2  # equal rows aren't one group's
    by = {}
    for r in got[0]:
        by.setdefault(r["sequence_id"], []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_fast_ids_of_whole_documents(spark):
    """All documents of a test folder, and a text of a megabyte."""
    import os

    enc = encoder()
    texts = [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()] if os.path.isdir("/root/testdata/sf0.01") else []
    texts.append((" ".join(texts) or "Grüße, 日本語 x_y.z 12½ " * 40_000)[: 1 << 20])
    for text in texts:
        assert enc.ids(text).tolist() == enc._plain(text)
