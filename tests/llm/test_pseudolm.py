from __future__ import annotations

import math
import random
import timeit
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import pseudolm as p
from plumbline.llm import windownet as w
from plumbline.llm.common import Scratch
from plumbline.llm.text import lower, words
from tests.llm.made import awkward, frame


def hashes(names):
    raw = "\n".join(names).encode()
    return words(lower(np.frombuffer(raw, dtype=np.uint8)), np.array([0, len(raw)])).hash


def stream_of(docs):
    return w.joined([np.array(d, dtype=np.uint16) for d in docs])


def noisy(seed=1):
    rng = np.random.default_rng(seed)
    net = w.Network.begin(rng.integers(1, 50, w.CODES).astype(float))
    return w.Network.of(net.flat() + rng.normal(0, 0.1, w.Network.SIZE).astype(np.float32))


def test_probabilities_add_up_to_one():
    net, rng = noisy(), np.random.default_rng(2)
    near = rng.integers(0, w.CODES, 6)
    every = [[*near[:3], c, *near[3:]] for c in range(w.CODES)]
    total = sum(math.exp(float(net.log_probs(np.array(x, dtype=np.uint16))[0])) for x in every)
    assert abs(total - 1) < 1e-3


def test_steps_follow_the_gradient():
    """Each part's gradient against finite differences of the loss."""
    net = noisy(3)
    stream, _ = stream_of([np.random.default_rng(4).integers(0, 300, 40), [5], np.random.default_rng(5).integers(0, w.CODES, 30)])
    loss = lambda n: -n.log_probs(stream).astype(float).sum() / 71
    codes, grads = net.gradients(stream)
    grads = [*grads]
    full = np.zeros_like(net.vectors)
    full[codes] = grads[0]
    grads[0] = full
    for k, g in enumerate(grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        values = []
        for step in (1e-2, -1e-2):
            moved = w.Network.of(net.flat())
            moved.parts()[k][at] += step
            values.append(loss(moved))
        assert abs((values[0] - values[1]) / 2e-2 - g[at]) < 0.02 * max(abs(g[at]), 0.01), k


def test_contexts_stay_within_documents_and_leave_the_token_out():
    net = noisy(6)
    stream, first = stream_of([[100, 200], [], [300]])
    assert first.tolist() == [3, 8, 11] and len(stream) == 15
    alone = [net.log_probs(stream_of([d])[0]) for d in ([100, 200], [300])]
    both = net.log_probs(stream)
    np.testing.assert_allclose(both[[0, 1, 8]], [alone[0][0], alone[0][1], alone[1][0]], rtol=1e-5)
    assert both[2:8].tolist() == [0] * 6
    other = [w.Network.hidden(net, net.vectors[stream_of([[c, 200]])[0]])[0] for c in (100, 7)]
    np.testing.assert_array_equal(*other)


def plain_log_prob(net, codes):
    """A document's score by the definition, token by token in doubles."""
    total = 0.0
    for i, c in enumerate(codes):
        z = net.bias.astype(float).copy()
        for o, d in zip(w.OFFSETS, net.scale.astype(float)):
            z += net.vectors[codes[i + o] if 0 <= i + o < len(codes) else w.OUTSIDE].astype(float) * d
        h = np.tanh(z)
        a, b = divmod(int(c), w.MEMBERS)
        for logits, at in ((h @ net.to_class + net.class_bias, a), (h @ net.to_member[a] + net.member_bias[a], b)):
            total += logits[at] - math.log(np.exp(logits).sum())
    return total


def test_scores_are_those_of_the_weights_token_by_token(spark, monkeypatch):
    """Documents' scores against a plain recomputation from the weights and the exact counts, in shards of all sizes."""
    monkeypatch.setattr(p, "SHARD", 300)
    monkeypatch.setattr(p, "HEAVY", 40)
    texts = [*sentences(12, 7), "", None, "one", *(f"rare{i} the cat rare{i % 3}" for i in range(9))]
    docs, scratch = frame(spark, texts), Scratch(spark, "t")
    counts = scratch.cut(p.counted(docs))
    vocabulary = p.Vocabulary.of(counts)
    rows = p.coded(docs, vocabulary, scratch)
    shards = p.sharded(rows, scratch)
    net = p.train(shards, vocabulary.by_code)
    got = {r["doc_id"]: r["log_prob"] for r in p.score(rows, shards, counts, net).collect()}
    n = Counter(x for t in texts for x in (t or "").split())
    own = [x for x in sorted(n)]
    code = dict(zip(own, vocabulary.look(hashes(own))[0].tolist()))
    size = Counter()
    for x in own:
        size[code[x]] += n[x]
    assert shards.select("shard").distinct().count() > 3
    for i, t in enumerate(texts):
        tokens = (t or "").split()
        want = plain_log_prob(net, [code[x] for x in tokens]) + sum(math.log(n[x] / size[code[x]]) for x in tokens)
        assert abs(got[i] - want) < 1e-3 * max(1, len(tokens))


def sentences(n, seed):
    rng = random.Random(seed)
    subject, verb, thing = ["the cat", "a dog", "the bird"], ["chases", "sees", "finds"], ["the red ball", "a blue stone", "the old tree"]
    return [" . ".join(f"{rng.choice(subject)} {rng.choice(verb)} {rng.choice(thing)} and then it sleeps" for _ in range(12)) for _ in range(n)]


def test_trained_network_prefers_texts_in_order(spark):
    scratch = Scratch(spark, "t")
    docs = frame(spark, sentences(2000, 1))
    counts = scratch.cut(p.counted(docs))
    vocabulary = p.Vocabulary.of(counts)
    net = p.train(p.sharded(p.coded(docs, vocabulary, scratch), scratch), vocabulary.by_code)
    fresh = sentences(20, 2)
    rng = random.Random(3)
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in fresh]

    def score(texts, net):
        rows = p.coded(frame(spark, texts), vocabulary, scratch)
        return {r["doc_id"]: r["mean_log_prob"] for r in p.score(rows, p.sharded(rows, scratch), counts, net).collect()}

    good, bad, before = score(fresh, net), score(mixed, net), score(fresh, w.Network.begin(vocabulary.by_code))
    assert all(good[i] > bad[i] + 0.3 for i in range(20)) and np.mean(list(good.values())) > np.mean(list(before.values())) + 1


@pytest.mark.parametrize("rounds", [1, 3])
def test_every_token_is_a_target_once(spark, monkeypatch, rounds):
    """The parts of all shards hold every row once, and a part's steps predict every place of it once."""
    monkeypatch.setattr(p, "SHARD", 200)
    texts = [" ".join(f"t{i}" for i in range(n)) for n in (1, 2, 8, 50, 700, 0)] * 3
    scratch = Scratch(spark, "t")
    docs = frame(spark, texts).repartition(4)
    rows = p.coded(docs, p.Vocabulary.of(scratch.cut(p.counted(docs))), scratch)
    shards = p.sharded(rows, scratch, rounds).collect()
    assert sorted(i for r in shards for i in r["doc_ids"]) == list(range(18))
    assert Counter(c for r in shards for c in np.frombuffer(r["codes"], "<u2").tolist()) == Counter(c for r in rows.collect() for c in np.frombuffer(r["codes"], "<u2").tolist())
    for size in (1, 5, 64, 5000):
        stream, _ = stream_of([range(n) for n in (1, 0, 70, 3)])
        goals = np.concatenate([x[w.REACH : len(x) - w.REACH] for x in w.parts(stream, size)])
        assert Counter(goals[goals != w.OUTSIDE].tolist()) == Counter([*range(1), *range(70), *range(3)])


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(p, "SHARD", 700)
    monkeypatch.setattr(p, "HEAVY", 30)
    texts = [*sentences(40, 5), *((7, "the same row again and again"),) * 25, (None, "no id"), (None, "no id"), (None, "another"), (None, None)]
    docs = frame(spark, texts)
    results = [sorted(map(str, p.pseudo_likelihood(docs.repartition(n) if n else docs.orderBy(docs["text"].desc()).coalesce(1)).collect())) for n in (0, 1, 3, 8)]
    assert len(results[0]) == len(texts) and all(r == results[0] for r in results)


def test_hot_rows_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(p, "SHARD", 400)
    docs, scratch = frame(spark, [*((7, "one row that is a third of all"),) * 400, *sentences(10, 1)]), Scratch(spark, "t")
    rows = p.coded(docs, p.Vocabulary.of(scratch.cut(p.counted(docs))), scratch)
    shards = p.sharded(rows, scratch).collect()
    by = Counter()
    for r in shards:
        by[r["shard"]] += r["doc_ids"].count(7)
    assert sum(by.values()) == 400 and max(by.values()) < 120


def test_frequent_words_are_counted_over_all_documents(spark):
    docs = frame(spark, ["b b b a", "a c", "a B"]).repartition(3)
    a, b = hashes(["a", "b"])
    assert p.frequent(Scratch(spark, "t").cut(p.counted(docs)), 2).tolist() == [int(b), int(a)]


def test_awkward_rows(spark):
    got = p.pseudo_likelihood(awkward(spark)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 12 and tuple(by[0])[1:] == tuple(by[1])[1:] == tuple(by[2])[1:] == (0, 0.0, None)
    assert by[6]["n_tokens"] == 60_000 and abs(by[3]["log_prob"] - by[4]["log_prob"]) < 1e-4 and by[3]["log_prob"] < 0
    assert p.pseudo_likelihood(frame(spark, [])).count() == 0


def test_each_word_has_a_probability_of_its_own(spark, monkeypatch):
    """Words that share a code differ by the logarithm of their exact counts, held by tasks or joined."""
    names = [f"r{i}" for i in range(4000)]
    codes = p.hashed(hashes(names))
    a, b = next((i, j) for j in range(4000) for i in range(j) if codes[i] == codes[j])
    common = [" ".join(f"c{i}" for i in range(60))] * 9
    monkeypatch.setattr(p, "frequent", lambda counts, most=0: np.zeros(0, np.uint64))  # no word has a code of its own
    docs = frame(spark, [*common, *[names[a]] * 6, *[names[b]] * 2]).repartition(5)
    counts = {np.int64(r["word"]).view(np.uint64): r["n"] for r in p.counted(docs).collect()}
    assert counts[hashes([names[a]])[0]] == 6 and counts[hashes([names[b]])[0]] == 2 and Counter(counts.values()) == {9: 60, 6: 1, 2: 1}
    for heavy in (1, 60, 1 << 16):
        monkeypatch.setattr(p, "HEAVY", heavy)
        got = {r["doc_id"]: r["log_prob"] for r in p.pseudo_likelihood(docs).collect()}
        assert abs(got[9] - got[15] - np.log(3)) < 1e-5 and got[9] < 0
        assert heavy == 1 or all(abs(got[i] - before[i]) < 1e-4 for i in got)
        before = got


def test_contexts_tell_more_than_frequencies_of_rows_not_learned_from(spark):
    rng = random.Random(9)
    follows = {f"w{i}": [f"w{(i * 7 + k) % 60}" for k in range(3)] for i in range(60)}

    def text():
        out = ["w0"]
        while len(out) < 400:
            out.append(rng.choice(follows[out[-1]]))
        return " ".join(out)

    r = p.held_out(frame(spark, [text() for _ in range(400)])).first()
    assert r["n_tokens"] > 20_000 and r["unigram"] < -3.5
    assert r["mean_log_prob"] > r["unigram"] + 0.3


def vocabulary(held, seed=1):
    rng = np.random.default_rng(seed)
    return p.Vocabulary(held, rng.integers(0, w.CODES, len(held)), rng.integers(1, 1 << 40, len(held)), rng.integers(1, 10**6, w.CODES))


@pytest.mark.parametrize("spread", ["evenly", "close", "one", "ends"])
def test_words_are_found_however_their_hashes_lie(spread):
    """Codes, logarithms and which words are held, against a dictionary."""
    rng = np.random.default_rng(2)
    top = (1 << 64) - 1
    held = {"evenly": rng.integers(0, top, 5000, np.uint64, True), "close": rng.integers(0, 9000, 3000, np.uint64), "one": np.array([77], np.uint64), "ends": np.array([0, top], np.uint64)}[spread]
    held = np.unique(held)
    v = vocabulary(held)
    asked = np.concatenate((held, held + np.uint64(1), held - np.uint64(1), rng.integers(0, top, 500, np.uint64, True), np.array([0, top], np.uint64)))
    code, part, lacks = v.look(asked)
    place, whole = {int(x): i for i, x in enumerate(held)}, p._logs(v.by_code)
    for i, h in enumerate(asked.tolist()):
        k = place.get(h)
        assert lacks[i] == (k is None) and code[i] == (p.hashed(asked[i : i + 1])[0] if k is None else v.codes[k])
        assert part[i] == (0 if k is None else v.logs[k]) - whole[code[i]]


def test_words_are_looked_up_in_less_time_than_a_binary_search_takes():
    """As many words as tasks hold at most; each of a slice's words is looked up, so this is paid for every token."""
    rng = np.random.default_rng(3)
    held = np.unique(rng.integers(0, (1 << 64) - 1, p.HEAVY, np.uint64))
    v, asked = vocabulary(held), rng.choice(held, 1 << 18)
    v.look(asked)
    cost = lambda f: min(timeit.repeat(f, number=1, repeat=7))
    assert cost(lambda: v.look(asked)) < cost(lambda: np.searchsorted(held, asked))


@pytest.mark.parametrize("width", [1, 40])
def test_steps_of_many_blocks_follow_the_definition(width):
    """Gradients and scores of a stream longer than what is worked on at once against plain double precision, with
    logits on both sides of their bound, and classes that are not there."""
    net, rng = noisy(8), np.random.default_rng(9)
    net.to_member *= width
    net.to_class *= width
    stream, _ = stream_of([rng.integers(0, 5 * w.MEMBERS, n) for n in (4 * w.BLOCK + 17, 0, 1, w.BLOCK)])
    goal = stream[w.REACH : -w.REACH].astype(int)
    at = np.flatnonzero(goal != w.OUTSIDE)
    h = np.tanh(net.bias + sum(net.vectors[stream[w.REACH + o : w.REACH + o + len(goal)]].astype(float) * d for o, d in zip(w.OFFSETS, net.scale)))[at]
    cls, member = np.divmod(goal[at], w.MEMBERS)
    want, errors = 0, []
    for logits, k in ((h @ net.to_class + net.class_bias, cls), (np.einsum("ij,ijk->ik", h, net.to_member[cls].astype(float)) + net.member_bias[cls], member)):
        logits = np.minimum(logits, w.TOP)
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        e /= e.sum(axis=1, keepdims=True)
        want = want + np.log(e[np.arange(len(at)), k])
        e[np.arange(len(at)), k] -= 1
        errors.append(e / len(at))
    np.testing.assert_allclose(net.log_probs(stream)[at], want, rtol=1e-4, atol=2e-3)
    codes, (g_vectors, _, g_bias, g_class, g_class_bias, g_member, g_member_bias) = net.gradients(stream)
    near = lambda a, b: np.testing.assert_allclose(a, b, atol=1e-3 * np.abs(b).max())
    near(g_class, h.T @ errors[0])
    near(g_class_bias, errors[0].sum(axis=0))
    for c in (0, 4):
        near(g_member[c], h[cls == c].T @ errors[1][cls == c])
        near(g_member_bias[c], errors[1][cls == c].sum(axis=0))
    assert not g_member[5:].any() and not g_member_bias[5:].any()
    gz = (errors[0] @ net.to_class.T + np.einsum("ik,ijk->ij", errors[1], net.to_member[cls].astype(float))) * (1 - h * h)
    near(g_bias, gz.sum(axis=0))
    full = np.zeros((w.CODES + 1, w.HIDDEN))
    for o, d in zip(w.OFFSETS, net.scale.astype(float)):
        np.add.at(full, stream[w.REACH + o + at], gz * d)
    near(g_vectors, full[codes])
