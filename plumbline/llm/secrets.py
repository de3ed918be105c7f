"""Secrets in texts: rules are turned into Boolean trigram queries that an inverted index answers before any regex runs.

Each run of documents that a task reads is an index segment, as in a search engine: it holds postings for the trigrams
that some rule mentions, in memory and only while the segment is scanned. Postings never leave their segment, so nothing
is shuffled and no posting list grows with the corpus. Rules without a mandatory trigram read every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as tok
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import tune
from plumbline.llm.text import lower, slices

# --- Boolean queries -------------------------------------------------------------------------------------------------

#: A query is True (any text), a trigram, ("and", queries) or ("or", queries).
Query = bool | str | tuple
#: Sets of literal strings are followed up to this size, then only their trigrams.
LITERALS = 16


def both(kind: str, parts: list[Query]) -> Query:
    """Join queries, leaving out what can't exclude a text."""
    flat: list[Query] = []
    for p in parts:
        if p is True:
            if kind == "or":
                return True
        elif isinstance(p, tuple) and p[0] == kind:
            flat.extend(p[1])
        else:
            flat.append(p)
    flat = list(dict.fromkeys(flat))
    return True if not flat else flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _of_strings(strings: set[str]) -> Query:
    return both("or", [both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in strings])


def _fold(c: int) -> str:
    return chr(c).lower() if c < 128 else chr(c)


def _strings(node) -> set[str] | None:
    """The strings that a parsed item can match if they are few, in lower case."""
    op, arg = node
    if op is tok.LITERAL:
        return {_fold(arg)}
    if op is tok.IN:
        out: set[str] = set()
        for kind, value in arg:
            if kind is tok.LITERAL:
                out.add(_fold(value))
            elif kind is tok.RANGE and value[1] - value[0] < 64:
                out |= {_fold(c) for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 4 else None
    if op is tok.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is tok.BRANCH:
        parts = [_sequence_strings(p) for p in arg[1]]
        return None if any(p is None for p in parts) or sum(map(len, parts)) > LITERALS else set().union(*parts)
    if op in (tok.MAX_REPEAT, tok.MIN_REPEAT, tok.POSSESSIVE_REPEAT):
        low, high, body = arg
        inner = _sequence_strings(body)
        if inner is None or high is tok.MAXREPEAT or high > 4:
            return None
        out = {"".join(x) for n in range(low, high + 1) for x in product(inner, repeat=n)}
        return out if len(out) <= LITERALS else None
    return {""} if op in (tok.AT, tok.ASSERT, tok.ASSERT_NOT) else None


def _sequence_strings(seq) -> set[str] | None:
    out = {""}
    for node in seq:
        part = _strings(node)
        if part is None or len(out) * len(part) > LITERALS:
            return None
        out = {a + b for a in out for b in part}
    return out


def _needs(node) -> Query:
    """What a text must hold if a parsed item that is no small set of strings is to match."""
    op, arg = node
    if op is tok.SUBPATTERN:
        return _query(arg[3])
    if op is tok.BRANCH:
        return both("or", [_query(p) for p in arg[1]])
    if op in (tok.MAX_REPEAT, tok.MIN_REPEAT, tok.POSSESSIVE_REPEAT) and arg[0] > 0:
        return _query(arg[2])
    return True


def _query(seq) -> Query:
    parts: list[Query] = []
    run = {""}
    for node in seq:
        here = _strings(node)
        if here is not None and len(run) * len(here) <= LITERALS:
            run = {a + b for a in run for b in here}
            continue
        parts.append(_of_strings(run))
        run = here if here is not None else {""}
        if here is None:
            parts.append(_needs(node))
    return both("and", [*parts, _of_strings(run)])


def trigram_query(pattern: str) -> Query:
    """A query, over texts in lower case, that holds for every text in which the regex can match.

    Only ASCII trigrams are used: lower-casing leaves other letters alone.
    """

    def ascii_only(q: Query) -> Query:
        if isinstance(q, tuple):
            return both(q[0], [ascii_only(x) for x in q[1]])
        return q if q is True or q.isascii() else True

    return ascii_only(_query(parser.parse(pattern)))


# --- rules -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a regex, and a test that a match must pass. Failing matches are dropped and not retried."""

    kind: str
    pattern: str
    passes: Callable[[re.Match], bool] = lambda m: True
    base: bool = False


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])

#: The base kinds, in their order, then what the method adds. Possessive repeats match as the plain ones do here.
RULES: tuple[Rule, ...] = (
    Rule("assign", rf"({_KEYS})[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16, True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+", base=True),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("url", r"[a-z]{2,10}://[^\s/:@\"'<>]{1,64}:[^\s/:@\"'<>]{4,64}@", lambda m: True),
)


class Segment:
    """Postings of a run of documents for some trigrams of their lower-cased bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> None:
        """wanted: sorted codes of the trigrams to index, first byte * 65536 + second * 256 + third."""
        self.n = len(offsets) - 1
        b = lower(data).astype(np.int32)
        self.postings: dict[int, np.ndarray] = {}
        if len(b) < 3 or not len(wanted):
            return
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        known = np.zeros(1 << 16, dtype=bool)  # by two of three bytes, small enough to stay in the cache
        known[wanted >> 8] = True
        at = np.flatnonzero(known[code >> 8])
        slot = np.searchsorted(wanted, code[at])
        hit = wanted[np.minimum(slot, len(wanted) - 1)] == code[at]
        at, slot = at[hit], slot[hit]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[doc + 1]
        pair = np.unique(slot[inside].astype(np.int64) * self.n + doc[inside])
        cut = np.searchsorted(pair, np.arange(len(wanted) + 1, dtype=np.int64) * self.n)
        for i, code_ in enumerate(wanted.tolist()):
            self.postings[code_] = pair[cut[i] : cut[i + 1]] - i * self.n

    def answer(self, q: Query) -> np.ndarray:
        """The documents of the segment that the query admits, sorted."""
        if q is True:
            return np.arange(self.n)
        if isinstance(q, str):
            return self.postings.get(int.from_bytes(q.encode(), "big"), np.zeros(0, np.int64))
        parts = [self.answer(x) for x in q[1]]
        if q[0] == "or":
            return np.unique(np.concatenate(parts))
        parts.sort(key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True)
        return out


def _trigrams(q: Query) -> set[str]:
    return set() if q is True else {q} if isinstance(q, str) else set().union(*map(_trigrams, q[1]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found array<struct<kind, start, end>>), a row for each row of docs (doc_id long, text string).

    Matches of each rule are leftmost and do not overlap; positions count code points of the whole text, end
    exclusive; found is ordered by start, then by the order of the rules. Null and empty texts have none.
    Repeated rows repeat; no rows in, no rows out; other columns are ignored.
    """
    tune(docs.sparkSession)
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = np.array(sorted(int.from_bytes(t.encode(), "big") for t in set().union(*map(_trigrams, queries))), dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = [re.compile(r.pattern) for r in rules]
        for batch in batches:
            for s in slices(batch.column(1)):
                segment = Segment(s.data, s.offsets, wanted)
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(segment.n)]
                texts: dict[int, str] = {}
                for i, (rule, q, test) in enumerate(zip(rules, queries, tests)):
                    for d in segment.answer(q).tolist():
                        if d not in texts:
                            texts[d] = s.data[s.offsets[d] : s.offsets[d + 1]].tobytes().decode("utf-8", "replace")
                        found[d].extend((m.start(), i, m.end()) for m in test.finditer(texts[d]) if rule.passes(m))
                spans = [[{"kind": rules[i].kind, "start": a, "end": b} for a, i, b in sorted(f)] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, s.hi - s.lo), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
                    names=["doc_id", "found"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, found array<struct<kind: string, start: long, end: long>>")


def report(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans as text, from what scan() returns."""
    base = [r.kind for r in rules if r.base]
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    only = F.filter("found", lambda x: x["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(text(only), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def digest(spans: list[tuple[str, int, int]]) -> str:
    """The hex SHA-256 of spans written as kind:start:end and joined by commas."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
