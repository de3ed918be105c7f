"""Toxicity scores from a logistic regression that is kept from leaning on identity terms.

Labelled texts that name a group are rewritten to name another group of the same kind, and training penalises the
squared change of the score. Neutral mentions of a group then hardly move a score, whatever the labels suggest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, tune
from plumbline.llm.sampling import fold, per_class
from plumbline.llm.text import lower, slices, words

#: Terms that may stand for each other, by kind and language; single words, in the forms that texts use. A parameter of
#: training.
IDENTITY: dict[str, tuple[str, ...]] = {
    "gender": ("women", "men", "girls", "boys"),
    "gender, one": ("woman", "man", "girl", "boy"),
    "gender, kind": ("female", "male", "nonbinary", "transgender"),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"),
    "orientation, people": ("gays", "lesbians", "bisexuals", "heterosexuals", "homosexuals"),
    "faith": ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    "faith, people": ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    "origin": ("african", "asian", "european", "american", "arab", "mexican", "indian", "chinese", "immigrant"),
    "origin, people": ("africans", "asians", "europeans", "americans", "arabs", "mexicans", "indians", "immigrants"),
    "colour": ("black", "white", "brown"),
    "age": ("young", "old", "elderly", "teenage"),
    "ability": ("disabled", "deaf", "blind", "autistic"),
    "Geschlecht": ("frauen", "männer", "mädchen", "jungen"),
    "Geschlecht, eins": ("frau", "mann"),
    "Neigung": ("schwule", "lesben", "bisexuelle", "homosexuelle", "heterosexuelle"),
    "Glaube": ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "katholiken"),
    "Herkunft": ("afrikaner", "asiaten", "europäer", "amerikaner", "araber", "türken", "ausländer", "einwanderer"),
    "genre": ("femmes", "hommes", "filles", "garçons"),
    "genre, un": ("femme", "homme", "fille", "garçon"),
    "orientation, fr": ("gais", "lesbiennes", "bisexuels", "homosexuels", "hétérosexuels"),
    "foi": ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    "origine": ("africains", "asiatiques", "européens", "américains", "arabes", "étrangers", "immigrés"),
    "género": ("mujeres", "hombres", "chicas", "chicos"),
    "género, uno": ("mujer", "hombre", "chica", "chico"),
    "orientación": ("gais", "lesbianas", "bisexuales", "homosexuales", "heterosexuales"),
    "fe": ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    "origen": ("africanos", "asiáticos", "europeos", "americanos", "árabes", "extranjeros", "inmigrantes"),
}
#: Features of a text are its words, and its words' first four, five and six bytes, hashed to BITS bits.
PREFIXES, BITS = (4, 5, 6), 18
#: At most so many labelled texts of either class train the classifier.
PER_CLASS = 4000
#: Features are kept from this many standard errors of the difference between the classes' shares.
SIGMAS = 4.0
THRESHOLD = 0.3

_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 32
TERM_BITS = np.uint64(64 - BITS)


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of feature numbers for each word of a slice, and each document's first word. Punctuation parts words."""
    plain = _PLAIN[lower(data)]
    whole = words(plain, offsets)
    rows = [whole.hash]
    for k in PREFIXES:
        cut = plain.copy()
        span = np.minimum(whole.end - whole.start, k)
        keep = np.zeros(len(plain), dtype=bool)
        for i in range(k):
            keep[whole.start[span > i] + i] = True
        cut[~keep] = 32
        rows.append(words(cut, offsets).hash + np.uint64(k))
    with np.errstate(over="ignore"):
        return (np.stack(rows, axis=1) * np.uint64(0x9E3779B97F4A7C15)) >> TERM_BITS, whole.first


def term_features(terms: list[str]) -> np.ndarray:
    """One row of feature numbers for each single-word term."""
    parts = [t.encode() for t in terms]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    return word_features(data, np.concatenate(([0], np.cumsum([len(p) for p in parts]))))[0]


@cache
def _forms(terms: tuple[str, ...]) -> np.ndarray:
    return term_features(list(terms))


def swapped(rows: np.ndarray, identity: dict[str, tuple[str, ...]], turn: int) -> np.ndarray | None:
    """The word rows with each identity term replaced by the `turn`-th next one of its kind; None without a term."""
    out = None
    if not np.isin(rows[:, 0], np.concatenate([_forms(t)[:, 0] for t in identity.values()] or [rows[:0, 0]])).any():
        return None
    for terms in identity.values():
        forms = _forms(terms)
        where, which = np.nonzero(rows[:, :1] == forms[None, :, 0])
        if len(where):
            out = rows.copy() if out is None else out
            out[where] = forms[(which + turn) % len(terms)]
    return out


@dataclass
class Model:
    """Weights by feature number; the score is the logistic function of bias plus the weights of distinct features."""

    weights: np.ndarray
    bias: float

    def scores(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.full(len(first) - 1, self.bias)
        telling = self.weights[rows] != 0
        for d in np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(telling.any(axis=1))))[first])):
            own = rows[first[d] : first[d + 1]][telling[first[d] : first[d + 1]]]
            out[d] += self.weights[np.unique(own)].sum()
        return 1 / (1 + np.exp(-np.clip(out, -700, 700)))


def telling(one: np.ndarray, none: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Which features a two-sample test keeps, by their shares among n1 texts of label 1 and n0 of label 0."""
    pool = (one * n1 + none * n0) / (n1 + n0)
    z = np.abs(one - none) / np.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n0) + 1e-12)
    return (z >= SIGMAS) & (pool * (n1 + n0) >= 3)


def fit(texts: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], prior: float, fairness: float = 10.0, decay: float = 1e-3, steps: int = 400, rate: float = 0.1) -> Model:
    """texts: distinct feature numbers of each text. pairs: those of a text and of its rewriting.

    Telling features are kept by a two-sample test; the loss is the logistic loss, plus decay times the squared
    weights, plus fairness times the mean squared score change over pairs. prior is the share of label 1 among all
    labelled rows: the bias is moved to it, as the sample has other shares.
    """
    size = 1 << BITS
    y = labels.astype(float)
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return Model(np.zeros(size, np.float32), float(np.log((prior + 1e-3) / (1 - prior + 1e-3))))
    one = np.bincount(np.concatenate([t for t, v in zip(texts, y) if v]).astype(np.int64), minlength=size) / n1
    none = np.bincount(np.concatenate([t for t, v in zip(texts, y) if not v]).astype(np.int64), minlength=size) / n0
    keep = np.flatnonzero(telling(one, none, n1, n0))
    column = np.full(size, -1)
    column[keep] = np.arange(len(keep))

    def dense(sets: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(sets), len(keep)), np.float32)
        for i, s in enumerate(sets):
            c = column[s.astype(np.int64)]
            x[i, c[c >= 0]] = 1
        return x

    x = dense(texts)
    change = dense([a for a, _ in pairs]) - dense([b for _, b in pairs]) if pairs else np.zeros((0, len(keep)), np.float32)
    y = y.astype(np.float32)  # float32 throughout: no product copies the matrix
    share = np.where(y > 0, 0.5 / n1, 0.5 / n0).astype(np.float32)
    w, b = np.zeros(len(keep), np.float32), np.float32(0)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        slope = share * (1 / (1 + np.exp(-np.clip(x @ w + b, -60, 60))) - y)
        g, gb = slope @ x + np.float32(decay / len(keep)) * w, slope.sum()
        if len(change):
            g = g + np.float32(2 * fairness / len(change)) * ((change @ w) @ change)
        m, v = m + np.float32(0.1) * (g - m), v + np.float32(0.01) * (g * g - v)
        mb, vb = mb + 0.1 * (gb - mb), vb + 0.01 * (gb * gb - vb)
        fix1, fix2 = 1 - 0.9**t, 1 - 0.99**t
        w = w - np.float32(rate / fix1) * m / (np.sqrt(v / np.float32(fix2)) + np.float32(1e-8))
        b = np.float32(b - rate * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8))
    weights = np.zeros(size, np.float32)
    weights[keep] = w
    return Model(weights, float(b + np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))


def train(docs: DataFrame, labels: DataFrame, identity: dict[str, tuple[str, ...]] | None = None, per_class_rows: int = PER_CLASS, fairness: float = 10.0) -> Model:
    """Fit on a bounded sample of labelled texts outside the held-out fold.

    labels (doc_id, toxic): null ids or labels are left out; a doc_id labelled twice counts as toxic if either says
    so; labels of no document are ignored. Without both classes every text gets the same score.
    """
    identity = IDENTITY if identity is None else identity
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("y"))
    known = known.filter("doc_id is not null and y in (0, 1)").filter(fold("doc_id", 4) != 2).groupBy("doc_id").agg(F.max("y").alias("y"))
    share = known.agg(F.avg("y")).first()[0]
    if share is None:
        return fit([], np.zeros(0), [], 0.0)
    rows = docs.select(F.col("doc_id").cast("long").alias("d_"), F.col("text").cast("string").alias("text"))
    labelled = rows.select("d_").join(known, F.col("d_") == F.col("doc_id")).select("d_", "y")
    # at most per_class_rows rows of each of two classes
    sample = per_class(labelled, "d_", "y", per_class_rows).toDF("l_", "y").toArrow()
    rows = rows.join(F.broadcast(docs.sparkSession.createDataFrame(sample, "l_ long, y int")), F.col("d_") == F.col("l_")).select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                feats, first = word_features(s.data, s.offsets)
                own, others = [], []
                for d in range(s.hi - s.lo):
                    part = feats[first[d] : first[d + 1]]
                    own.append(np.unique(part).astype(np.int32))
                    turns = [swapped(part, identity, k) for k in (1, 2)]
                    others.append([np.unique(o).astype(np.int32) for o in turns if o is not None])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, s.hi - s.lo), pa.array(own, pa.list_(pa.int32())), pa.array(others, pa.list_(pa.list_(pa.int32())))],
                    names=["y", "own", "swaps"],
                )

    kind = "y int, own array<int>, swaps array<array<int>>"
    scratch = Scratch(docs.sparkSession, "toxicity")
    sets = scratch.cut(rows.mapInArrow(run, kind))
    by = sets.select("y", F.explode("own").alias("f")).groupBy("f").agg(F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")).toArrow()
    n1, n0 = sets.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    kept = np.zeros(1 << BITS, dtype=bool)
    if n1 and n0:
        f, one, none = (by[c].to_numpy() for c in ("f", "n1", "n0"))
        kept[f[telling(one / n1, none / n0, n1, n0)]] = True

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = lambda x: [f for f in x if kept[f]]
        for batch in batches:
            own = [left(x.as_py()) for x in batch.column(1)]
            others = [[left(o) for o in x.as_py()] for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32())), pa.array(others, pa.list_(pa.list_(pa.int32())))], names=["y", "own", "swaps"])

    got = sets.mapInArrow(prune, kind).toArrow()
    # in an order of their own, so that the layout of the rows makes no difference
    texts = sorted(zip(got["y"].to_pylist(), got["own"].to_pylist(), got["swaps"].to_pylist()))
    own = [np.array(x, dtype=np.int32) for _, x, _ in texts]
    pairs = [(own[i], np.array(o, dtype=np.int32)) for i, (_, _, swaps) in enumerate(texts) for o in swaps]
    return fit(own, np.array([y for y, _, _ in texts]), pairs, share, fairness)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of docs (doc_id long, text string).

    Only the text is read, and all of it. Null and empty texts get the score of the bias. held_out is false for a
    null doc_id. Repeated rows repeat; no rows in, no rows out; other columns are ignored.
    """
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2)):
                p = model.scores(*word_features(s.data, s.offsets))
                n = s.hi - s.lo
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, n), batch.column(1).slice(s.lo, n), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
