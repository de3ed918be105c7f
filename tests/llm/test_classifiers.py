from __future__ import annotations

import os
import random

import numpy as np
import pytest

from plumbline.llm import langid, toxicity
from tests.llm.made import awkward, frame

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data here")


@needs_data
def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = langid.identify(docs, langid.train(docs)).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.97


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12, 30])
def test_codewords_are_far_apart(n):
    code = langid.codewords(n)
    apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= (2 ** (n - 2) if n <= 7 else 8) and set(np.unique(code)) <= {-1.0, 1.0}


def test_decoding_corrects_a_wrong_bit_and_flags_ties():
    code = langid.codewords(4)
    m = langid.Model(["a", "b", "c", "d"], code, np.eye(7), np.zeros(7), np.ones(7))
    x = 4 * code[2]
    x[3] *= -0.5
    assert m.predict(x)[0] == "c" and not m.predict(x)[2]
    assert m.predict(np.zeros(7))[2] and m.predict(np.zeros(7))[0] == "a"


def test_language_of_awkward_rows(spark):
    docs = frame(spark, ["the cat sat on the mat and slept"] * 30, 100).unionByName(frame(spark, ["der hund lief über die straße nach hause"] * 30, 200, "de"))
    model = langid.train(docs)
    got = langid.identify(awkward(spark), model).collect()
    assert len(got) == 12 and all(r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert by[0] == by[1] == by[2] == "und" and by[7] != "und"
    assert langid.identify(frame(spark, ["123 ... !", "½ ²"]), model).filter("lang_pred <> 'und'").count() == 0
    kept = langid.recognised(awkward(spark), model)
    assert kept.columns == awkward(spark).columns and not {0, 1, 2} & {r["doc_id"] for r in kept.collect()}
    assert langid.identify(frame(spark, []), model).count() == 0


def test_language_without_or_with_one_label(spark):
    docs = frame(spark, ["a b c", "d e f"], lang=None)
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()} == {"und"}
    docs = frame(spark, [f"some words {i}" for i in range(20)])
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(docs)).collect()} == {"en"}


def labelled(spark, n=700, seed=3):
    """Insults decide the label, but toxic texts name one group far more often than clean ones."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = i % 3 == 0
        w = [rng.choice(["calm", "river", "table", "green", "under", "walks", "today", "paper"]) for _ in range(20)]
        w[3] = rng.choice(["muslim", "christian"] if rng.random() < (0.9 if bad else 0.1) else ["paper"]) if not bad else ("muslim" if rng.random() < 0.9 else "paper")
        if not bad and rng.random() < 0.1:
            w[3] = rng.choice(["muslim", "christian", "hindu"])
        if bad:
            w[9] = "vile" + rng.choice("abcdefgh") + rng.choice("klmnopqr") + "en"
        rows.append((i, " ".join(w) + ".", int(bad)))
    docs = frame(spark, [(i, t) for i, t, _ in rows])
    return docs, spark.createDataFrame([(i, b) for i, _, b in rows], "doc_id long, toxic int")


def scores(spark, model, texts):
    return [r["score"] for r in toxicity.score(frame(spark, texts), model).orderBy("doc_id").collect()]


def test_counterfactuals_shrink_the_effect_of_identity(spark):
    docs, labels = labelled(spark)
    neutral = ["calm river muslim table today", "calm river christian table today", "calm river paper table today"]
    gap = {}
    for fairness in (0.0, 30.0):
        s = scores(spark, toxicity.train(docs, labels, fairness=fairness), neutral)
        gap[fairness] = max(s) - min(s)
    assert gap[30.0] < 0.5 * gap[0.0]


def test_toxic_texts_score_higher_even_with_unseen_endings(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    s = scores(spark, model, ["calm river vileaken today", "calm river VILEZZOG today", "calm river green today"])
    assert s[0] > 0.5 and s[1] > 0.3 > s[2]
    held = toxicity.score(docs, model).filter("held_out").join(labels, "doc_id").collect()
    assert len(held) > 100 and np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.97


def test_swapping_replaces_terms_of_a_kind():
    rows = toxicity.term_features(["calm", "muslim", "river"])
    out = toxicity.swapped(rows, toxicity.IDENTITY, 1)
    terms = list(toxicity.IDENTITY["faith"])
    want = toxicity.term_features([terms[(terms.index("muslim") + 1) % len(terms)]])
    assert (out[1] == want[0]).all() and (out[[0, 2]] == rows[[0, 2]]).all() and toxicity.swapped(rows[:1], toxicity.IDENTITY, 1) is None


@needs_data
def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in got)
    assert hit / sum(r["toxic"] for r in got) > 0.75 and hit / sum(r["predicted"] for r in got) > 0.8


def test_toxicity_of_awkward_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs.unionByName(frame(spark, [None, ""], 9000)), labels.union(spark.createDataFrame([(None, 1), (9000, None), (9001, 1), (77777, 0), (0, 1)], labels.schema)))
    got = toxicity.score(awkward(spark), model).collect()
    assert len(got) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert toxicity.score(frame(spark, []), model).count() == 0
    none = toxicity.train(docs, labels.limit(0))
    assert len(set(scores(spark, none, ["a", "b c"]))) == 1
    assert len(set(scores(spark, toxicity.train(docs, labels.filter("toxic = 0")), ["a", "vilescum"]))) == 1


def test_language_scores_are_those_of_the_weights(spark):
    """Plain recomputation of each document's decoding from n-grams, weights and codewords."""
    import math
    from collections import Counter

    rng = random.Random(6)
    kinds = {"en": ["the", "cat", "sat", "on", "mat"], "de": ["der", "hund", "läuft", "über", "straße"], "fr": ["le", "chat", "était", "sous", "table"]}
    train = None
    for k, (lang, ws) in enumerate(kinds.items()):
        part = frame(spark, [" ".join(rng.choices(ws, k=9)) for _ in range(40)], 1000 * k, lang)
        train = part if train is None else train.unionByName(part)
    model = langid.train(train)
    texts = ["The cat, the mat!", "Der Hund und le chat", "é", "x1y2 ...", " ".join(rng.choices(sum(kinds.values(), []), k=400)), "straße \U0001f600 table"]
    got = {r["doc_id"]: r for r in langid.identify(frame(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        raw = [b if b >= 128 else b | 32 if chr(b).isalpha() else 0 for b in text.encode()]
        grams = Counter()
        for n in langid.ORDERS:
            for at in range(len(raw) - n + 1):
                code = int.from_bytes(bytes(raw[at : at + n]), "big")
                grams[((code + n - 1) * 0x9E3779B1 % 2**32) >> (32 - langid.BITS)] += 1
        total = sum(grams.values())
        x = {g: math.sqrt(c / total) for g, c in grams.items()}
        loss = {}
        for c, lang in enumerate(model.langs):
            loss[lang] = sum(model.trust[j] * math.log1p(math.exp(-model.code[c, j] * (model.bias[j] + sum(v * float(model.weights[g, j]) for g, v in x.items())))) for j in range(model.code.shape[1]))
        best = min(loss, key=lambda k: loss[k])
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - 1 / sum(math.exp(loss[best] - v) for v in loss.values())) < 1e-4


def test_toxicity_scores_are_those_of_the_weights(spark):
    """Plain recomputation of each document's score from its distinct words and word beginnings."""
    import math
    import re

    from plumbline.llm.text import _byte_values, RADIX
    from plumbline.llm.common import mix64

    docs, labels = labelled(spark)[:2]
    model = toxicity.train(docs, labels)
    value = [int(v) for v in _byte_values()]

    def number(part, extra):
        h = (sum(value[b] * pow(int(RADIX), i, 2**64) for i, b in enumerate(part)) + len(part)) % 2**64
        h = (int(mix64(np.array([h], dtype=np.uint64))[0]) + extra) % 2**64
        return (h * 0x9E3779B97F4A7C15 % 2**64) >> (64 - toxicity.BITS)

    rows = docs.limit(60).collect() + frame(spark, [(10**6, "It's a-b ÉÉ x, yy; zzz"), (10**6 + 1, ""), (10**6 + 2, None)]).collect()
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows), model).collect()}
    for r in rows:
        features = set()
        for word in re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (r["text"] or "").encode())):
            features |= {number(word, 0)} | {number(word[:k], k) for k in toxicity.PREFIXES}
        assert abs(got[r["doc_id"]] - 1 / (1 + math.exp(-model.bias - sum(float(model.weights[f]) for f in features)))) < 1e-5


def test_samples_are_bounded_and_do_not_rank_repeated_keys(spark, monkeypatch):
    from plumbline.llm import sampling
    from plumbline.llm.sampling import per_class

    rows = spark.range(0, 6000).selectExpr("id", "id % 2 as c").union(spark.range(0, 3000).selectExpr("cast(77 as bigint)", "cast(1 as bigint)"))
    got = per_class(rows.repartition(5), "id", "c", 200).collect()
    n = {c: sum(r["c"] == c for r in got) for c in (0, 1)}
    assert 180 <= n[0] <= 200 and 80 <= n[1] <= 200 and len(set(map(tuple, got))) == len(got) and (77, 1) not in set(map(tuple, got))
    assert sorted(map(tuple, got)) == sorted(map(tuple, per_class(rows.coalesce(1), "id", "c", 200).collect()))
    monkeypatch.setattr(sampling, "FEW", 0)
    assert sorted(map(tuple, got)) == sorted(map(tuple, per_class(rows, "id", "c", 200).collect()))
    assert per_class(rows, "id", "c", 10**6).count() == 6000 and per_class(rows.limit(0), "id", "c", 5).count() == 0


def test_training_does_not_depend_on_the_layout(spark):
    docs, labels = labelled(spark)[:2]
    a, b = toxicity.train(docs.repartition(1), labels), toxicity.train(docs.repartition(7), labels.repartition(3))
    assert (a.weights == b.weights).all() and a.bias == b.bias
    a, b = langid.train(docs.repartition(1)), langid.train(docs.repartition(6))
    assert (a.weights == b.weights).all()
