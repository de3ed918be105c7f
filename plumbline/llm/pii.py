"""Personal data by bootstrapped contextual extraction.

Seeds are what four base patterns find. Every identifier-shaped token (one with digits or an at sign) is an instance,
and its shape and what stands beside it give its lexical patterns: the shape itself, words, pairs of words, a label before
a colon, a word with the shape. Spark scores the graph of patterns and instances in rounds. A pattern's confidence for a kind is the mean
belief in its instances: 1 for seeds, the best confidence of their patterns for tokens that confident ones hold, a prior
for tokens that might be of the kind, 0 for all else. Tokens found in one round count as support in the next, so that
patterns which no seed has are induced from them. Patterns that end with high confidence mark tokens as of their kind.

Every pattern with enough support takes part, however many other seeds its kind has. Patterns are a table; where they
are counted and few they are handed to the tasks, and otherwise they are joined with the tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import Scratch, tune

KINDS = ("email", "ip", "card", "phone")

# Possessive repeats and lookbehinds give the matches of the plain patterns, in linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: A token that may be an identifier: no white space, with a digit or an at sign.
_TOKEN = re.compile(r"(?<!\S)(?=[^\s0-9@]*[0-9@])\S++")
_TRIM = ".,;:!?()[]{}<>\"'|"
#: A token's context: the words that stand within so many characters of it. What is further away is no context.
REACH = 80

#: Confidence from which a pattern marks tokens; distinct believed instances that it needs; rounds of scoring; belief in
#: a token that no confident pattern holds; least digits of a token that is marked.
CONFIDENT, SEEDS, ROUNDS, PRIOR, DIGITS = 0.8, 5, 4, 0.5, 4
#: So many patterns are handed to the tasks; more are joined.
FEW = 1 << 14


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each at sign takes the run of local characters before it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > floor and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at)):
            yield begin, m.end()
            floor = m.end()
        else:
            floor = at + 1
        at = text.find("@", floor)


def _ip_ok(s: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in s.split("."))


def luhn(digits: str) -> bool:
    """Whether the digits' check sum is a multiple of ten."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns in a whole text, by kind and then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if _ip_ok(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


_LABEL = re.compile(r"[:=#]\s*[\"'(<\[]?\s*\Z")
_RUNS = re.compile(r"(.)\1+", re.DOTALL)
_CLASSES = {**dict.fromkeys(map(ord, "0123456789"), "9"), **{c: "a" for c in range(97, 123)}, **{c: "A" for c in range(65, 91)}}


def shape(token: str) -> str:
    """A token with a sign for each run of digits, capitals or small letters, and of equal other characters.

    A shape of more than 64 signs is told by its digest.
    """
    out = _RUNS.sub(r"\1", token.translate(_CLASSES))
    return out if len(out) <= 64 else hashlib.blake2b(out.encode("utf-8", "replace"), digest_size=16).hexdigest()


def _names(text: str) -> list[str]:
    return [w for w in (x.strip(_TRIM + "=#") for x in text.lower().split()) if w]


def _beside(text: str, start: int, end: int) -> list[str]:
    """A span's lexical patterns: T its own shape, L and LL the words before, R the word after, LR both, C a label, S the
    word before with the span's shape."""
    before, own = text[max(0, start - REACH) : start], shape(text[start:end])
    left, right = _names(before)[-2:], _names(text[end : end + REACH])[:1]
    out = [f"T {own}"] + ([f"R {right[0]}"] if right else [])
    if left:
        out += [f"L {left[-1]}", f"S {left[-1]} {own}"]
        out += [f"C {left[-1]}"] if _LABEL.search(before) else []
        out += [f"LR {left[-1]} {right[0]}"] if right else []
        out += [f"LL {left[0]} {left[1]}"] if len(left) > 1 else []
    return out


def _run_together(text: str) -> Iterator[tuple[int, int]]:
    """What a phone number may be that stands before further digits: the base pattern takes these with it and fails.

    For each match with more than 15 digits the runs of its first words that have 9 to 15.
    """
    for m in _PHONE.finditer(text):
        digits, at = 0, m.start()
        if len(_digits(m[0])) <= 15:
            continue
        for word in _WORD.finditer(text, m.start(), m.end()):
            digits += len(_digits(word[0]))
            if digits > 15:
                break
            if digits >= 9 and word.end() < m.end():
                yield at, word.end()


def occurrences(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str | None, int, int, list[str]]]:
    """(kind or None, start, end, patterns) of the seeds, of the other identifier-shaped tokens of a text, and of runs of
    words that may be a phone number run together with what follows."""
    out: list[tuple[str | None, int, int, list[str]]] = [(k, a, b, _beside(text, a, b)) for k, a, b in base]
    if not ("@" in text or _DIGIT.search(text)):
        return out
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        i = int(np.searchsorted(starts, b))
        if b > a and not any(x < b and y > a for x, y in taken[max(0, i - 3) : i]):
            out.append((None, a, b, _beside(text, a, b)))
    if "+" in text:
        out += [(None, a, b, _beside(text, a, b)) for a, b in _run_together(text)]
    return out


_WORD = re.compile(r"\S+")
_WORDY = re.compile(r"[^\W\d_]")
_ADDRESS = re.compile(r"[0-9A-Fa-f]++(?:[.:][0-9A-Fa-f]*+){2,}+")


def may_be(token: str) -> list[str]:
    """The kinds that a token's characters allow, however it fails the base patterns and however long it is.

    None but email for a token of few digits. What has the form of an address or a card number but fails its check isn't
    one: that is known, not open. Every test takes time in proportion to the token.
    """
    digits = sum(c in "0123456789" for c in token)
    out = ["email"] if "@" in token else []
    if digits + token.count("@") < DIGITS:
        return out
    out += ["ip"] if _ADDRESS.fullmatch(token) and not _IP.fullmatch(token) else []
    if not _WORDY.search(token):
        failed = 13 <= digits <= 19 and _CARD.fullmatch(token)
        out += ["card"] if digits >= 8 and not failed else []
        out += ["phone"] if digits >= 6 else []
    return out


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SEEN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("who", pa.int64()), ("may", pa.list_(pa.string())), ("patterns", pa.list_(pa.string()))]))
_SPANS = "array<struct<kind: string, start: long, end: long>>"
_TOKENS = "array<struct<kind: string, start: long, end: long, who: long, may: array<string>, patterns: array<string>>>"


def _who(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.lower().encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def scan(docs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """The carried columns, base spans in pii_base_, and in pii_seen_ seeds and identifier-shaped tokens with their patterns."""
    rows = docs.select(*[F.col(f"`{c}`") for c in carried], F.col("text").cast("string").alias("pii_text_"))
    schema = rows.drop("pii_text_").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, seen = [], []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                seen.append([{"kind": k, "start": a, "end": b, "who": _who(text[a:b]), "may": [] if k else may_be(text[a:b]), "patterns": p} for k, a, b, p in occurrences(text, spans)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(base, _FOUND), pa.array(seen, _SEEN)], names=[*schema.names, "pii_base_", "pii_seen_"])

    tune(docs.sparkSession)
    out = T.StructType([*schema, *T.StructType.fromDDL(f"pii_base_ {_SPANS}, pii_seen_ {_TOKENS}")])
    return rows.mapInArrow(run, out)


def graph_of(scanned: DataFrame, scratch: Scratch, confident: float = CONFIDENT, seeds: int = SEEDS, hidden: Column | None = None) -> DataFrame:
    """A written table (pattern, k, who, hit, n): the instances that are or may be of kind k, and how many the pattern has.

    Left out are patterns that can't become confident of a kind: too few instances, or too many that can't be of it.
    hidden: a condition on `who` by which seeds are taken for tokens of which nothing is known.
    """
    seen = scanned.select(F.explode("pii_seen_").alias("o")).select("o.kind", "o.who", "o.may", F.explode("o.patterns").alias("pattern"))
    if hidden is not None:
        seen = seen.withColumn("may", F.when(hidden & F.col("kind").isNotNull(), F.array("kind")).otherwise(F.col("may"))).withColumn("kind", F.when(~hidden, F.col("kind")))
    edges = scratch.cut(seen.groupBy("pattern", "who").agg(F.collect_set("kind").alias("kinds"), F.max("may").alias("may")))
    hits = edges.select("pattern", F.explode("kinds").alias("k"), "who", F.lit(True).alias("hit"))
    open_ = edges.filter(F.size("kinds") == 0).select("pattern", F.explode("may").alias("k"), "who", F.lit(False).alias("hit"))
    able = hits.unionByName(open_)
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    some = able.groupBy("pattern", "k").agg(F.count("*").alias("c")).filter(F.col("c") >= seeds).join(sizes, "pattern").filter(F.col("c") >= confident * F.col("n"))
    out = scratch.cut(able.join(some.drop("c"), ["pattern", "k"]))
    scratch.drop(edges)
    return out


def bootstrap(graph: DataFrame, scratch: Scratch, rounds: int = ROUNDS, confident: float = CONFIDENT, seeds: int = SEEDS) -> DataFrame:
    """(pattern, kind) of the patterns that end confident, from a table of graph_of()."""
    known = scores = None
    for _ in range(rounds):
        belief = F.when(F.col("hit"), 1.0).otherwise(F.lit(PRIOR))
        held = graph
        if known is not None:
            held = graph.join(known.toDF("who", "k", "b"), ["who", "k"], "left")
            belief = F.when(F.col("hit"), 1.0).otherwise(F.coalesce("b", F.lit(PRIOR)))
        scored = held.withColumn("v", belief).groupBy("pattern", "k").agg((F.sum("v") / F.first("n")).alias("score"), F.count_if(F.col("v") >= confident).alias("support"))
        scores = scratch.cut(scored.filter((F.col("score") >= confident) & (F.col("support") >= seeds)))
        known = scratch.cut(graph.filter(~F.col("hit")).join(scores, ["pattern", "k"]).groupBy("who", "k").agg(F.max("score").alias("b")))
    return scratch.cut(scores.groupBy("pattern").agg(F.max_by("k", F.struct("score", "k")).alias("kind")))


def held_out(docs: DataFrame, share: int = 5) -> DataFrame:
    """(kind, n_hidden, n_found, n_right): how the method does on distinct seeds that it isn't told of, one in `share`.

    n_found of them stand in a pattern that ended confident, and n_right in one of their own kind.
    """
    scratch = Scratch(docs.sparkSession, "pii-trial")
    scanned, hidden = scratch.cut(scan(docs)), F.pmod(F.xxhash64("who"), F.lit(share)) == 0
    patterns = bootstrap(graph_of(scanned, scratch, hidden=hidden), scratch).toDF("p_", "marked")
    seen = scanned.select(F.explode("pii_seen_").alias("o")).select("o.kind", "o.who", F.explode_outer("o.patterns").alias("p_")).filter(hidden & F.col("kind").isNotNull())
    each = seen.join(patterns, "p_", "left").groupBy("kind", "who").agg(F.max(F.col("marked").isNotNull()).alias("found"), F.max(F.coalesce(F.col("marked") == F.col("kind"), F.lit(False))).alias("right"))
    return each.groupBy("kind").agg(F.count("*").alias("n_hidden"), F.count_if("found").alias("n_found"), F.count_if("right").alias("n_right"))


def _held(patterns: DataFrame) -> dict[str, str] | None:
    """Pattern -> kind where patterns are few, else None."""
    rows = patterns.limit(FEW + 1).collect()
    return {r["pattern"]: r["kind"] for r in rows} if len(rows) <= FEW else None


def _marked(seen: list[dict], patterns: dict[str, str]) -> list[tuple[str, int, int]]:
    out = []
    for o in seen:
        if kinds := [k for p in o["patterns"] if (k := patterns.get(p)) in o["may"]]:
            out.append((max(set(kinds), key=lambda k: (kinds.count(k), k)), o["start"], o["end"]))
    return out


def _joined(scanned: DataFrame, row: str, patterns: DataFrame) -> DataFrame:
    """(pii_r_, pii_added_): what _marked() finds in each row of `scanned`, by joins; rows without any are left out."""
    seen = scanned.select(F.col(row).alias("pii_r_"), F.explode("pii_seen_").alias("o")).filter(F.size("o.may") > 0).select("pii_r_", "o.start", "o.end", "o.may", F.explode("o.patterns").alias("p_"))
    votes = seen.join(patterns, F.col("p_") == F.col("pattern")).filter(F.array_contains("may", F.col("kind"))).groupBy("pii_r_", "start", "end", "kind").agg(F.count("*").alias("n"))
    spans = votes.groupBy("pii_r_", "start", "end").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"))
    by = spans.groupBy("pii_r_").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))
    return by.select("pii_r_", F.transform("added", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("pii_added_"))


def _found(docs: DataFrame, carried: Sequence[str], scratch: Scratch, finish=None, schema: T.StructType | None = None) -> DataFrame:
    """The carried columns with base spans in pii_base_ and those that the method adds in pii_added_. Texts are scanned once.

    finish(columns, base, added) may make a batch of `schema` of them instead, in the same pass.
    """
    scanned = scratch.cut(scan(docs, carried).withColumn("pii_row_", F.monotonically_increasing_id()))
    table = bootstrap(graph_of(scanned, scratch), scratch)
    patterns, n = _held(table), len(carried)
    rows, last = scanned.drop("pii_row_"), "pii_seen_"
    if patterns is None:
        joined = scanned.drop("pii_seen_").join(_joined(scanned, "pii_row_", table), F.col("pii_row_") == F.col("pii_r_"), "left").drop("pii_r_", "pii_row_")
        rows, last = joined.withColumn("pii_added_", F.coalesce("pii_added_", F.array().cast(_SPANS))), "pii_added_"
    kept = T.StructType([*rows.drop(last).schema, *T.StructType.fromDDL(f"pii_added_ {_SPANS}")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, seen = batch.column(n), batch.column(n + 1)
            added = seen
            if patterns is not None:
                added = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in _marked(s.as_py(), patterns)] if patterns else [] for s in seen], _FOUND)
            if finish:
                yield finish(batch.columns[:n], base, added)
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], added], names=kept.names)

    if patterns is None and not finish:
        return rows
    return rows.mapInArrow(run, schema or kept)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added), a row for each row of docs: spans of the base patterns and those that the method adds.

    Positions count code points of the whole text, end exclusive. Null and empty texts have no spans. Repeated rows
    repeat, and count once as instances; no rows in, no rows out; other columns are ignored.
    """
    found = _found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], Scratch(docs.sparkSession, "pii"))
    return found.select("doc_id", F.col("pii_base_").alias("base"), F.col("pii_added_").alias("added"))


def report(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as text, from what find() returns."""
    rank = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    order = lambda x: F.struct(rank[x["kind"]].alias("r"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
    every = F.array_sort(F.transform(F.concat("base", "added"), order))
    return found.select("doc_id", *map(count, KINDS), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets, and n_chars, where there is one, counted again.

    All columns, whatever their names, and all rows stay. Of overlapping spans the first and longest is replaced, and the
    rest falls with it. A null text stays null, and so does its n_chars; an empty text stays empty. Repeated rows repeat,
    a null doc_id plays no part. No rows in, no rows out.
    """
    schema, at = docs.schema, docs.columns.index("text")
    plain = [f"c{i}" if i != at else "text" for i in range(len(schema))]  # none of the names that are used within

    def clean(text: str, spans: list[dict]) -> str:
        parts, end = [], 0
        for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= end:
                parts += [text[end : s["start"]], f"[{s['kind'].upper()}]"]
            end = max(end, s["end"])
        return "".join(parts) + text[end:]

    def finish(columns: list[pa.Array], base: pa.Array, added: pa.Array) -> pa.RecordBatch:
        text = [clean(t.as_py(), spans) if (spans := b.as_py() + a.as_py()) else t.as_py() for t, b, a in zip(columns[at], base, added, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if i == at else c for i, c in enumerate(columns)], names=schema.names)

    out = _found(docs.toDF(*plain), plain, Scratch(docs.sparkSession, "redact"), finish, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
