from __future__ import annotations

import random

import numpy as np
import pytest

from plumbline.llm import decontaminate as d
from tests.llm.made import awkward, frame, words


def edit(ws, k, rng):
    w = list(ws)
    for _ in range(k):
        at, how = rng.randrange(len(w)), rng.randrange(3)
        if how == 0:
            w[at] = f"y{rng.randrange(10**6)}"
        elif how == 1 and len(w) > 1:
            del w[at]
        else:
            w.insert(at, f"y{rng.randrange(10**6)}")
    return w


def distance(a, text):
    """Least edits of `a` against any part of text, plainly."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(11)
    items = [words(rng.randrange(6, 60), 100 + i, 3000) for i in range(40)]
    docs = []
    for i in range(240):
        body = words(300, 1000 + i, 3000)
        if i % 2:
            item = items[rng.randrange(40)]
            at = rng.randrange(len(body))
            body[at:at] = edit(item, rng.randrange(d.allowed(len(item)) + 1), rng)
        docs.append(body)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    return items, docs, bench


def test_recall_and_precision_against_brute_force(spark, planted):
    items, docs, bench = planted
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in d.leaks(frame(spark, [" ".join(w) for w in docs]), bench).collect()}
    want = {(i, j): n for i, w in enumerate(docs) for j, item in enumerate(items) if set(item) & set(w) and (n := distance(item, w)) <= d.allowed(len(item))}
    assert len(want) > 100 and not set(got) - set(want)
    assert len(set(want) & set(got)) >= 0.99 * len(want)
    assert all(got[k] == want[k] for k in got)


def test_leaky_rows_go_and_clean_rows_stay(spark, planted):
    items, docs, bench = planted
    frame_ = frame(spark, [" ".join(w) for w in docs])
    hit = {r["doc_id"] for r in d.leaks(frame_, bench).collect()}
    out = d.without_leaks(frame_, bench)
    assert out.columns == frame_.columns and {r["doc_id"] for r in out.collect()} == set(range(240)) - hit


def test_several_passes_give_the_same(spark, planted, monkeypatch):
    items, docs, bench = planted
    frame_ = frame(spark, [" ".join(w) for w in docs])
    once = sorted(map(tuple, d.leaks(frame_, bench).collect()))
    monkeypatch.setattr(d, "ITEM_CHARS", 2000)
    assert sorted(map(tuple, d.leaks(frame_, bench).collect())) == once


def test_spans_name_the_passage(spark):
    bench = spark.createDataFrame([(5, "Alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    text = "é one two alpha BETA gamma delta epsilon zeta end"
    (r,) = d.leaks(frame(spark, [text]), bench).collect()
    assert tuple(r) == (0, 5, 0, 6, 10, 45) and text[10:45].lower().startswith("alpha") and text[10:45].endswith("zeta")


def test_alignment_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 9))])
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(0, 14))])
        cost, lo, hi = d.align(a, b)
        assert cost == distance(a.tolist(), b.tolist())
        part = b[lo:hi].tolist()
        assert distance(part, a.tolist()) <= cost or not part


@pytest.mark.parametrize("n", range(1, 70))
def test_items_have_windows_of_their_size(n):
    w = d.Items.build([(1, " ".join(f"w{i % 40}" for i in range(n)))]).windows
    offsets = set(w.offset.tolist())
    assert 0 <= min(offsets) and max(offsets) <= (n - 1) // 2 and len(offsets) == min(d.allowed(n) + d.MORE, (n + 1) // 2)
    assert set(w.lengths.tolist()) == {n - o for o in offsets} and min(w.lengths) >= n / 2 and len(w.keys) == d.WALKS * d.SAMPLES * len(offsets)


@pytest.mark.parametrize("n", [6, 8, 10, 15, 20, 30, 60, 100, 200])
def test_share_of_occurrences_that_windows_propose(n):
    """Recall of the LSH alone by the item's length, at the most edits that are allowed, where places are known."""
    rng = random.Random(n)
    items = [words(n, 500 + i, 3000) for i in range(50)]
    built = d.Items.build([(i, " ".join(w)) for i, w in enumerate(items)])
    hit = 0
    for j, item in enumerate(items):
        part = edit(item, d.allowed(n), rng)
        raw = np.frombuffer(" ".join([*words(20, rng.randrange(10**6), 3000), *part, *words(20, rng.randrange(10**6), 3000)]).encode(), dtype=np.uint8)
        w = d.words(d.lower(raw), np.array([0, len(raw)]))
        near = [b for _, i, b in zip(*(x.tolist() for x in d.candidates(w.hash, w.first, built)), strict=True) if i == j]
        hit += any(abs(b - 20) <= 2 * d.allowed(n) for b in near)
    assert hit >= 0.96 * len(items)


def test_keys_are_the_same_whatever_else_is_embedded(monkeypatch):
    h = np.random.default_rng(3).integers(0, 2**63, 400).astype(np.uint64)
    start, size = np.arange(0, 300, 7), np.arange(43) % 19 + 1
    whole = d.embed_keys(h, start, start + 30, size)
    monkeypatch.setattr(d, "SYMBOLS", 300)
    assert (whole == d.embed_keys(h, start, start + 30, size)).all()
    assert all((whole[i] == d.embed_keys(h, start[i : i + 1], start[i : i + 1] + 30, int(size[i]))[0]).all() for i in range(len(start)))
    assert d.embed_keys(h, start[:0], start[:0], size[:0]).shape == (0, d.WALKS * d.SAMPLES)


def test_walks_agree_on_equal_texts_and_differ_on_others():
    h = np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64)
    two = np.concatenate((h[:40], h[50:55], h[:40]))
    keys = d.embed_keys(two, np.array([0, 45, 5]), np.array([40, 85, 45]), 16)
    assert (keys[0] == keys[1]).all() and not (keys[0] == keys[2]).all()


def test_awkward_rows_and_items(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, " "), (4, "one two three four five six"), (4, "one two three four five six"), (None, "no id here at all today"), (6, "one")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in d.leaks(awkward(spark), bench).collect() if r["doc_id"] is not None and r["item_id"] is not None)
    assert got == [(3, 6), (4, 6), (5, 4), (5, 4), (5, 4), (5, 4), (5, 6), (5, 6), (8, 4), (8, 4), (8, 6)]
    assert d.leaks(frame(spark, []), bench).count() == 0
    assert d.leaks(awkward(spark), bench.limit(0)).count() == 0 and d.without_leaks(awkward(spark), bench.limit(0)).count() == 12
