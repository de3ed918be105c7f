from __future__ import annotations

import os
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import secrets as s
from plumbline.llm.text import slices
from tests.llm.made import awkward, frame

KEYS = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(t):
    """The base kinds as they are defined, by start and then kind."""
    out = [(m.start(), 0, "assign", m.end()) for m in KEYS.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def spans(spark, texts, rules=s.RULES):
    return {r["doc_id"]: [(x["kind"], x["start"], x["end"]) for x in r["found"]] for r in s.scan(frame(spark, texts), rules).collect()}


def test_base_spans_equal_the_plain_patterns(spark):
    import random

    rng = random.Random(6)
    bits = ["password", "Token", "SECRET", "api_key", "ApiKey", "passwd", "=", ":", " ", '"', "'", "abcdef12", "x", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "\n", "/+", "ſecret", "toKen"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(3000)]
    got = spans(spark, texts, tuple(r for r in s.RULES if r.base))
    assert all(got[i] == plain(t) for i, t in enumerate(texts))
    assert sum(map(len, got.values())) > 500


def test_method_adds_and_base_stays(spark):
    t = "x ghp_" + "a1B2" * 9 + " -----BEGIN RSA PRIVATE KEY----- password=abcdefgh1 https://bob:hunter22@host/ eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM"
    got = spans(spark, [t])[0]
    assert [x for x in got if x[0] in ("assign", "access", "hex")] == plain(t)
    assert {k for k, _, _ in got} == {"forge", "pem", "assign", "url", "jwt"}


def holds(q, text):
    if q is True:
        return True
    if isinstance(q, str):
        return q in text
    return (all if q[0] == "and" else any)(holds(x, text) for x in q[1])


@settings(max_examples=60, deadline=None)
@given(st.data())
@pytest.mark.parametrize("pattern", [r.pattern for r in s.RULES] + ["(abc|xyz)+def", "a{3}b?cde", "(?:foo|barx*)baz[0-9]", "[a-z]+", "ab", "(abcd)?", "(?i:HeLLo) wor?ld"])
def test_queries_admit_whatever_the_regex_matches(pattern, data):
    text = data.draw(st.from_regex(pattern.replace("*+", "*").replace("}+", "}").replace("?<!", "?<!"), fullmatch=False).filter(lambda t: len(t) < 3000))
    lowered = "".join(c.lower() if c < "\x80" else c for c in text)
    assert holds(s.trigram_query(pattern), lowered)


def test_lookaheads_ask_for_nothing_wrong():
    assert holds(s.trigram_query("x(?=yz)yza.b"), "xyzaqb") and holds(s.trigram_query("(?<!a)bcd"), "bcd")


def test_queries_are_the_expected_ones():
    assert s.trigram_query("[0-9a-f]{32,}") is True and s.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert s.trigram_query("abc|xyz") in (("or", ("abc", "xyz")), ("or", ("xyz", "abc")))


def test_postings_intersect_within_documents():
    import pyarrow as pa

    (part,) = slices(pa.array(["xABCd", "abd bcd", "ab", "c", None, "abcd"]))
    code = lambda t: int.from_bytes(t.encode(), "big")
    seg = s.Segment(part.data, part.offsets, np.array(sorted([code("abc"), code("bcd")]), dtype=np.int32))
    assert seg.answer("abc").tolist() == [0, 5] and seg.answer(("and", ("abc", "bcd"))).tolist() == [0, 5] and seg.answer(("or", ("abc", "bcd"))).tolist() == [0, 1, 5] and seg.answer(True).tolist() == list(range(6))


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="no test data here")
def test_report_on_the_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r for r in s.report(s.scan(docs)).collect()}
    for r in docs.collect():
        want = plain(r["text"] or "")
        x = got[r["doc_id"]]
        assert x["base_sha256"] == s.digest(want) and (x["n_assign"], x["n_access"], x["n_hex"]) == tuple(sum(k == n for k, _, _ in want) for n in ("assign", "access", "hex"))


def test_awkward_rows(spark):
    got = s.report(s.scan(awkward(spark))).collect()
    assert len(got) == 12 and all(r["spans"] == "" for r in got)
    assert s.report(s.scan(frame(spark, []))).count() == 0
