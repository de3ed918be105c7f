from __future__ import annotations

import random

import numpy as np
import pytest

from plumbline.llm import components, dedup, minhash
from plumbline.llm.common import Scratch
from plumbline.llm.text import lower, words
from tests.llm.made import awkward, frame
from tests.llm.made import words as made_words


def shingles_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, num=85, den=100):
    sets = {i: shingles_of(t) for i, t in rows}
    lab = {i: i for i in sets}

    def root(i):
        while lab[i] != i:
            i = lab[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            n = len(sets[a] & sets[b])
            if n and den * n >= num * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                lab[q] = p
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def group(n, size, changes, seed):
    """Copies of one text, each with its own changes: a chain of similarities around the threshold."""
    rng, base = random.Random(seed), made_words(size, seed)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.fixture(scope="module")
def corpus():
    texts = group(60, 120, 4, 1) + group(30, 300, 12, 2) + [" ".join(made_words(80, s)) for s in range(10, 40)] + ["a b", "a b", "A  B", "a c", "", " "] + group(3, 40, 1, 3)
    random.Random(5).shuffle(texts)
    return list(enumerate(texts))


def test_components_equal_brute_force(spark, corpus):
    assert result(dedup.near_components(frame(spark, corpus))) == brute(corpus)


def test_large_clusters_are_compared_in_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_DOCS", 7)
    assert result(dedup.near_components(frame(spark, corpus))) == brute(corpus)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    u = rng.integers(0, 2**63, 400).astype(np.uint64)
    for shared in (0, 100, 300, 380):
        a, b = np.sort(u[:390]), np.sort(np.concatenate((u[390 - shared : 390], rng.integers(0, 2**63, 390 - shared).astype(np.uint64))))
        sig = minhash.signatures(np.concatenate((a, b)), np.array([0, 390, 780]), 512)
        assert abs((sig[0] == sig[1]).mean() - shared / (780 - shared)) < 0.09


def test_every_slot_is_filled_by_one_element_in_a_permutation():
    sig = minhash.signatures(np.array([7, 9], dtype=np.uint64), np.array([0, 1, 2]), 64)
    assert [sorted(np.floor(s).astype(int)) for s in sig] == [list(range(64))] * 2 and not (sig[0] == sig[1]).any()
    assert np.isinf(minhash.signatures(np.zeros(0, np.uint64), np.array([0, 0]), 8)).all()


@pytest.mark.parametrize("text", ["", " ", "a", "A b\tc\x0bd\x0ce\rf\n", "é É " * 9, "a\xa0b c d e f g", "x " * 300])
def test_shingle_counts(text):
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    w = words(lower(raw), np.array([0, len(raw)]))
    assert minhash.shingles(w)[1][-1] == len(shingles_of(text)) and len(w.hash) == len(text.encode().split())


def test_long_chains_connect(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (101, 100)], "a long, b long")
    got = {r[0]: r[1] for r in components.components(edges, Scratch(spark, "t")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_awkward_rows(spark, monkeypatch):
    rows = dedup.near_components(awkward(spark)).collect()
    assert len(rows) == 12
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[0] == {(0, 0, True)} and got[1] == {(0, 1, True)} and got[2] == {(0, 2, True)}
    assert got[3] == {(1, 3, True)} and got[4] == {(1, 3, False)} and got[5] == {(2, 5, True)} and got[8] == {(2, 5, False)}
    assert got[None] == {(2, None, False)} and got[9] == {(1, 9, True)}
    from pyspark.sql import functions as F

    clashing = awkward(spark).withColumns({c: F.lit(1) for c in ("k_", "n_", "r_", "d_", "h_", "o", "near_row_", "NEAR_GONE_", "a", "b")})
    for few in (dedup.FEW, 0):
        monkeypatch.setattr(dedup, "FEW", few)
        kept = dedup.survivors(clashing)
        assert kept.columns == clashing.columns and sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == [0, 1, 2, 3, 5, 6, 7, 9] and kept.count() == 9


def test_no_rows(spark):
    assert dedup.near_components(frame(spark, [])).count() == 0


def test_one_id_with_several_texts_links_their_groups(spark):
    a, b = (made_words(60, s) for s in (71, 72))
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(3, " ".join(a)), (5, " ".join(a)), (4, " ".join(b)), (5, " ".join(b)), (9, near(a)), (10, near(b)), (11, "quite alone in here it is")]
    got = dedup.near_components(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(3, 3), (5, 3), (4, 3), (9, 3), (10, 3), (11, 11)}
    rows = [(7, " ".join(a)), (7, " ".join(b)), (9, near(a)), (10, near(b))]
    assert {r["component_id"] for r in dedup.near_components(frame(spark, rows)).collect()} == {7}


def test_pipeline_stage_links_from_four_fifths(spark):
    """Pairs planted between 0.80 and 0.85: n words with one changed in the middle share n - 9 of n + 1 shingles."""
    import corpus_pipeline

    rows = []
    for k, n in enumerate([49, 50, 52, 54, 56, 58, 60, 48, 46]):
        w = made_words(n, 900 + k)
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join([*w[: n // 2], "changed", *w[n // 2 + 1 :]]))]
    want = {i for i, (_, _, kept) in brute(rows, 80, 100).items() if kept}
    assert len(want) == len({i for i, (_, _, kept) in brute(rows).items() if kept}) - 7
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect()} == want


def test_pipeline_stage_keeps_rows_without_an_id_and_unlike_rows_of_one_id(spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(made_words(60, s)) for s in (81, 82, 83, 84))
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    rows = [(None, a), (None, near(a)), (None, b), (7, near(b)), (3, c), (3, d), (3, near(d)), (9, near(c)), (None, "alone"), (4, ""), (4, ""), (4, " "), (5, None), (None, ""), (None, "")]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, frame(spark, rows), "").collect()]
    fixed = [(7, near(b)), (3, c), (None, "alone"), (4, ""), (4, " "), (5, None), (None, ""), (None, "")]
    assert len(got) == len(fixed) + 2 and all(got.count(x) == fixed.count(x) for x in fixed)
    assert sum(x in ((None, a), (None, near(a))) for x in got) == 1 and sum(x in ((3, d), (3, near(d))) for x in got) == 1
    whole = awkward(spark)
    out = corpus_pipeline.near_duplicates(spark, whole, "")
    assert out.columns == whole.columns and sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, i) for i in (0, 1, 2, 3, 5, 6, 7, 9)] + [(True, 0)]
