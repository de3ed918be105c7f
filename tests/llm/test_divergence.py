from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from plumbline.llm import divergence as d
from plumbline.llm.common import Scratch
from tests.llm.made import SCHEMA, awkward

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, least, top=50):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows, with Python's integers."""
    df, count, langs = defaultdict(Counter), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        for t, n in terms.items():
            df[lang][t] += 1
            count[lang, source, t] += n
    out = set()
    for lang, sources in langs.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        extra = 5 * len(kept)
        whole = {t: sum(count[lang, s, t] for s in sources) for t in kept}
        share = lambda n, total: 1 + 10**9 * (n + 5) // (total + extra)
        p = {s: {t: share(count[lang, s, t], sum(count[lang, s, u] for u in kept)) for t in kept} for s in sources}
        q = {t: share(whole[t], sum(whole.values())) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, x, f, i + 1) for i, (f, x) in enumerate(found) if part == "pair" or i < top}
    return out


def corpus(seed, n, langs=("en", "de", None), sources=("a", "b", "ü", None, "z")):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "É", "é", "日本", "straße", "x1y", "won't", "a\x00b", "\x7fq", "[k]", "{z}", "Ω"] + [f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    weights = [50] + [1 + 40 / (i + 1) for i in range(len(vocabulary) - 1)]
    return [(rng.choice((None, "", "12 34")) if rng.random() < 0.05 else " ".join(rng.choices(vocabulary, weights, k=rng.randrange(40))), rng.choice(langs), rng.choice(sources)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None) for i, (t, lang, s) in enumerate(rows)], SCHEMA)


def test_audit_equals_plain_sums(spark):
    rows = corpus(1, 500)
    got = [tuple(r) for r in d.audit(frame(spark, rows).repartition(7), least=20, top=6).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, 20, 6)


def test_partial_counts_add_up(monkeypatch):
    """Given out early and often, partial counts have the sums of the whole."""
    rows = corpus(2, 400)
    monkeypatch.setattr(d, "HELD", 10)
    monkeypatch.setattr(d, "OUT", 7)
    batches = [pa.RecordBatch.from_pydict({"lang": [r[1] or "" for r in part], "source": [r[2] or "" for r in part], "doc_id": pa.array([None if i % 9 == 0 else i for i in range(len(part))], pa.int64()), "text": [r[0] or "" for r in part]}) for part in (rows[i : i + 37] for i in range(0, len(rows), 37))]
    docs, n = Counter(), Counter()
    for out in d._count(iter(batches)):
        assert len(out) <= 7
        for r in out.to_pylist():
            docs[r["lang"], r["term"], r["source"]] += r["docs"]
            n[r["lang"], r["term"], r["source"]] += r["n"]
    want_docs, want_n = Counter(), Counter()
    for text, lang, source in rows:
        for t, k in Counter(TERM.findall((text or "").translate(LOWER))).items():
            want_docs[lang or "", t, source or ""] += 1
            want_n[lang or "", t, source or ""] += k
    assert docs == want_docs and n == want_n


def test_a_term_in_every_document_is_cut_over_ranges(spark):
    """Ranges split the runs of few terms; pieces are put together."""
    rows = [("same same other", "en", f"s{i % 7}") for i in range(900)] + [("rare", "en", "s1")]
    docs = frame(spark, rows).repartition(60)  # partial counts of 60 tasks, 2 terms
    kept = {r["term"]: dict(zip(r["sources"], r["counts"], strict=True)) for r in d.term_runs(docs.select("lang", "source", "doc_id", "text"), Scratch(spark, "t")).collect()}
    assert set(kept) == {"same", "other"}
    per = Counter(s for _, _, s in rows[:900])
    assert kept["other"] == dict(per) and kept["same"] == {s: 2 * n for s, n in per.items()}


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([[10**12, 0, 3]], dtype=np.int64)
    total = np.array([[10**12 + 40]], dtype=np.int64)
    assert d._shares(counts, total).tolist() == [[1 + 10**9 * (c + 5) // (10**12 + 40) for c in counts[0].tolist()]]
    small = np.arange(50, dtype=np.int64)[None, :]
    assert d._shares(small, np.array([[977]])).tolist() == [[1 + 10**9 * (c + 5) // 977 for c in range(50)]]


def test_many_sources_by_a_join(spark, monkeypatch):
    rows = [(f"w{'abc'[i % 3]} common", "en", f"s{i % 40}") for i in range(400)]
    monkeypatch.setattr(d, "FEW", 5)
    assert {tuple(r) for r in d.audit(frame(spark, rows), least=30).collect()} == plain(rows, 30)


def test_distances_of_many_sources_are_given_out_by_batch(monkeypatch):
    rng = np.random.default_rng(1)
    names = [f"s{i}" for i in range(9)]
    totals = rng.integers(100, 900, 9)
    rows = []
    for t in range(30):
        own = sorted(rng.choice(9, size=rng.integers(1, 9), replace=False).tolist())
        rows.append({"lang": "en", "term": f"t{t}", "sources": [names[i] for i in own], "counts": rng.integers(1, 30, len(own)).tolist(), "names": names, "totals": totals.tolist(), "total": int(totals.sum())})
    batches = lambda: iter([pa.RecordBatch.from_pylist(rows[:13]), pa.RecordBatch.from_pylist(rows[13:])])

    def total(out):
        c = Counter()
        for r in (r for b in out for r in b.to_pylist()):
            c[r["part"], r["source"], r["item"]] += r["value"]
        return c

    one = total(d._compare(batches()))
    monkeypatch.setattr(d, "DENSE", 4)
    assert total(d._compare(batches())) == one and len(one) > 36


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = d.audit(docs, least=1)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.select("text", "lang", "source").collect()]
    assert {tuple(r) for r in out.collect()} == plain(rows, 1)
    assert d.audit(docs.limit(0)).collect() == []
    one = frame(spark, [(None, None, "a"), ("x", "", "b"), ("", "", None)])
    assert {tuple(r) for r in d.audit(one).collect()} == plain([(None, None, "a"), ("x", "", "b"), ("", "", None)], 30)
