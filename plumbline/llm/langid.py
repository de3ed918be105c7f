"""Language identification by error-correcting output codes over hashed byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settle, tune
from plumbline.llm.sampling import fold, per_class
from plumbline.llm.text import lower, slices

#: n-grams of two to four bytes fall into 2**BITS counters.
ORDERS, BITS = (2, 3, 4), 13
#: At most so many documents of each language train the classifiers.
PER_LANGUAGE = 400
#: A text is ambiguous when the two nearest codewords' probabilities differ by less.
MARGIN = 0.05
UNKNOWN = "und"

_LETTERISH = np.zeros(256, dtype=np.uint8)
_LETTERISH[97:123] = np.arange(97, 123)
_LETTERISH[128:] = np.arange(128, 256)


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each document of a slice its whole text's n-gram counts: square roots, scaled to length one.

    Letters are kept in lower case; every other ASCII character counts as a blank.
    """
    b = _LETTERISH[lower(data)].astype(np.uint32)
    grams = []
    code = b
    for k in range(1, max(ORDERS)):
        code = code[:-1] * np.uint32(256) + b[k:] if len(code) > 1 else code[:0]
        if k + 1 in ORDERS:
            grams.append((((code + np.uint32(k)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), k))
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        total = np.zeros(1 << BITS, dtype=np.int64)
        for g, k in grams:
            if hi - k > lo:
                total += np.bincount(g[lo : hi - k], minlength=1 << BITS)
        x = np.sqrt(total).astype(np.float32)
        norm = float(np.sqrt(total.sum()))
        yield x / norm if norm else x


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each document holds a letter of any script."""
    ascii_ = np.concatenate(([0], np.cumsum((lower(data) >= 97) & (lower(data) < 123))))
    found = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each class.

    Up to seven classes: the exhaustive code, all ways to split the classes in two. More: of 200 random codes of
    eight bits for each doubling of the classes, the one whose nearest rows are farthest apart.
    """
    if classes < 2:
        return np.ones((classes, 0))
    if classes <= 7:
        splits = np.arange(1, 1 << (classes - 1))
        rest = ((splits[None, :] >> np.arange(classes - 1)[:, None]) & 1) * -2 + 1
        return np.vstack((np.ones(len(splits)), rest)).astype(float)
    rng, best, far = np.random.default_rng(seed), None, -1.0
    width = int(8 * np.ceil(np.log2(classes)))
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (classes, width))
        apart = (width - code @ code.T) / 2 + width * np.eye(classes)
        usable = (np.abs(code.sum(axis=0)) < classes).all()
        if usable and apart.min() > far:
            best, far = code, apart.min()
    return best


@dataclass
class Model:
    """Languages, a codeword for each, one linear classifier for each bit, and how far each bit is trusted."""

    langs: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[str, float, bool]:
        """(language, probability, ambiguous): the codeword of least weighted loss."""
        if not self.langs:
            return UNKNOWN, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        m = x @ self.weights + self.bias
        loss = (np.logaddexp(0, -self.code * m) * self.trust).sum(axis=1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        first, second = np.argsort(-p, kind="stable")[:2]
        return self.langs[first], float(p[first]), bool(p[first] - p[second] < MARGIN)


def fit(x: np.ndarray, langs: np.ndarray, steps: int = 150, rate: float = 0.5, decay: float = 1e-5) -> Model:
    """Logistic regressions, one for each bit of the code, by full-batch Adam; every class weighs the same."""
    names = sorted(set(langs.tolist()))
    code = codewords(len(names))
    if code.shape[1] == 0:
        return Model(names, code, np.zeros((x.shape[1], 0), np.float32), np.zeros(0), np.zeros(0))
    cls = np.searchsorted(names, langs)
    y = code[cls].astype(np.float32)
    share = (1.0 / np.bincount(cls)[cls] / len(names)).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for t in range(1, steps + 1):
        slope = -y * share / (1 + np.exp(y * (x @ w + b)))
        for i, (p, g) in enumerate(((w, x.T @ slope + decay * w), (b, slope.sum(axis=0)))):
            first, second = state[2 * i], state[2 * i + 1]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            p -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    wrong = ((np.sign(x @ w + b) != y) * share).sum(axis=0)
    trust = np.log((1 - wrong + 1e-3) / (wrong + 1e-3))
    return Model(names, code, w, b.astype(float), np.clip(trust, 0.05, None) / np.clip(trust, 0.05, None).mean())


def packed(x: np.ndarray) -> bytes:
    """A row of features as half floats: which of them aren't zero, a bit each, and these."""
    half = x.astype(np.float16)
    held = half != 0
    return np.packbits(held).tobytes() + half[held].tobytes()


def unpack(row: bytes | pa.Buffer, into: np.ndarray) -> None:
    """Fill a row of zeros with what packed() was given, to the precision of half floats."""
    raw, bits = np.frombuffer(row, dtype=np.uint8), -(-len(into) // 8)
    into[np.unpackbits(raw[:bits], count=len(into)).view(bool)] = raw[bits:].view(np.float16)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on text and lang of a bounded sample: rows with both, outside the held-out fold, first by a hash of doc_id.

    The sample is put in order before it is fitted, so that the layout of the rows makes no difference. It comes to the
    driver packed, and is held there once as what is fitted; what the driver has freed by then goes back to the machine.
    """
    usable = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    usable = usable.filter("text is not null and lang is not null and doc_id is not null").filter(fold("doc_id", 5) != 0)
    # at most per_language rows of each language: a few thousand ids
    picked = per_class(usable, "doc_id", "lang", per_language).toDF("l_", "of_").toArrow()
    if not picked.num_rows:
        return Model([], np.ones((0, 0)), np.zeros((1 << BITS, 0)), np.zeros(0), np.zeros(0))
    picked = docs.sparkSession.createDataFrame(picked)
    sample = usable.join(F.broadcast(picked), (F.col("doc_id") == F.col("l_")) & (F.col("lang") == F.col("of_")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                rows = [packed(x) for x in ngram_counts(s.data, s.offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.lo, s.hi - s.lo), pa.array(rows, pa.binary())], names=["lang", "x"])

    got = sample.select("lang", "text").mapInArrow(run, "lang string, x binary").toArrow().sort_by([("lang", "ascending"), ("x", "ascending")])
    x, langs = np.zeros((got.num_rows, 1 << BITS), np.float32), np.array(got["lang"].to_pylist())
    for row, into in zip(got["x"], x, strict=True):
        unpack(row.as_buffer(), into)
    del got, picked, sample
    model = fit(x, langs)
    del x, into
    settle(docs.sparkSession)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), a row for each row of docs (doc_id long, text string).

    A null text, or one without any letter, is `und` with score 0 and ambiguous. held_out is false for a null doc_id.
    Other columns are never read; repeated rows repeat; no rows in, no rows out.
    """
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2)):
                letters = has_letter(s.data, s.offsets)
                found = [model.predict(x) if known else (UNKNOWN, 0.0, True) for x, known in zip(ngram_counts(s.data, s.offsets), letters)]
                n = s.hi - s.lo
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, n), batch.column(1).slice(s.lo, n), *map(pa.array, zip(*found))],
                    names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
                )

    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows whose language identify() leaves unknown or flags as ambiguous.

    All columns, whatever their names, stay as they are. Null, empty and blank texts and texts without a letter go, a null
    doc_id or lang plays no part, repeated rows stay or go together. No rows in, no rows out.
    """
    tune(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for s in slices(batch.column(at)):
                letters = has_letter(s.data, s.offsets)
                for d, x in enumerate(ngram_counts(s.data, s.offsets)):
                    keep[s.lo + d] = letters[d] and not model.predict(x)[2]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
