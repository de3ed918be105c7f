"""Small corpora for the text operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use as names of their own.
CLASHING = {"component_id": "c", "score": "0.5", "start": "1", "node": "n", "keys": "k", "media": "m", "label": "l", "_r": "r", "n_": "n", "group": "g", "codes": "c", "key": "k"}


def frame(spark: SparkSession, texts: list, first: int = 0, lang: str | None = "en") -> DataFrame:
    """Documents numbered from `first`; a pair in texts is (doc_id, text)."""
    rows = [x if isinstance(x, tuple) else (first + i, x) for i, x in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls, empty and blank texts, ties, repeated rows, a long text, odd characters and clashing columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one"), (5, "one two three four five six"), (5, "one two three four five six"), (None, "no id here at all today"), (6, long), (7, "é ß 日本 😀 ½ ​ \x00 x"), (8, "ONE two THREE four five six"), (9, "x" * 50_000)]
    out = spark.createDataFrame([(i, t, None if i == 3 else "en", None, None) for i, t in rows], SCHEMA)
    return out.withColumns({k: F.lit(v) for k, v in CLASHING.items()})


def words(n: int, seed: int, size: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]
