from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import runs
from tests.llm.made import awkward, frame


def plain(w, least=6, times=4):
    """All runs, period by period and word by word."""
    n, out, seen = len(w), [], set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            a, b = i, j + q
            if b - a >= max(least, times * q) and not any(s <= a and b <= e for s, e in seen):
                out.append((a, b - a, q))
                seen.add((a, b))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def values(w):
    return np.array([zlib.crc32(str(x).encode()) for x in w], dtype=np.uint64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_runs_of_small_alphabets(w):
    assert runs.periodic(values(w)) == plain(w)


def test_runs_of_made_sequences():
    rng = random.Random(3)
    for _ in range(300):
        w = []
        while len(w) < rng.randrange(20, 700):
            unit = [rng.randrange(rng.choice((2, 3, 50))) for _ in range(rng.randrange(1, 40))]
            unit = unit * rng.randrange(1, 4) + unit[: rng.randrange(3)] if rng.random() < 0.3 else unit
            w += unit * rng.randrange(1, 8) + unit[: rng.randrange(len(unit))]
        assert runs.periodic(values(w)) == plain(w)
        assert runs.periodic(values(w), 4, 3) == plain(w, 4, 3)


def test_few_blocks_an_automaton(monkeypatch):
    monkeypatch.setattr(runs, "BLOCKS", 3)
    rng = random.Random(4)
    for _ in range(60):
        unit = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        w = [7, 8] + unit * 9 + [rng.randrange(4) for _ in range(50)]
        assert runs.periodic(values(w)) == plain(w)


def test_long_runs_take_few_steps():
    n = 400_000
    assert runs.periodic(values([1]) .repeat(n)) == [(0, n, 1)]
    unit = np.arange(1, 30_001, dtype=np.uint64)
    assert runs.periodic(np.tile(unit, 8)) == [(0, 240_000, 30_000)]


def test_two_periods_cannot_be_asked_for():
    with pytest.raises(ValueError):
        runs.periodic(values([1, 1, 1]), 2, 2)


def digest(rows, doc_id, text, rewrite=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if rewrite and doc_id is not None and (to := runs.planted(doc_id, len(w))) is not None:
        w = [w[i] for i in to]
    found = plain(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found)]
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept)))


def test_report_equals_the_plain_way(spark):
    rng = random.Random(5)
    texts = [(i * 7, " ".join(rng.choice(("a", "é", "日本", "w1", "A")) if rng.random() < 0.5 else "x y" for _ in range(rng.randrange(160)))) for i in range(300)]
    texts += [(5001, None), (5002, ""), (5003, "\t \n"), (5004, "a\n" * 40), (5005, "a b " * 20 + "c" + " d" * 9)]
    got = {tuple(r) for r in runs.report(runs.find(frame(spark, texts).repartition(3), rewrite=runs.planted)).collect()}
    assert got == {digest(None, i, t) for i, t in texts}


def test_planted_documents_repeat_their_end():
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(ids) > 200 and runs.planted(ids[0], 0) is None
    for i in ids:
        to = runs.planted(i, 50)
        g = zlib.crc32(str(i).encode()) // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert to.tolist() == [j if j < a else a + (j - a) % p for j in range(50)]


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = runs.report(runs.find(docs))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {(r["doc_id"], r["n_runs"], r["length"], r["period"]) for r in got.collect()}
    assert got.count() == docs.count()
    assert (6, 1, 60_000, 977) in rows and (0, 0, None, None) in rows and (None, 0, None, None) in rows
    assert runs.report(runs.find(docs.limit(0))).collect() == []
