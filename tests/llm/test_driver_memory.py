"""What the driver holds beside its heap: the training sample once, and nothing that it has freed."""

from __future__ import annotations

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pytest
from py4j.protocol import Py4JError

from plumbline.llm import common, langid
from tests.llm.made import frame, words


@pytest.mark.parametrize("share", [0.0, 0.01, 0.3, 1.0])
@pytest.mark.parametrize("n", [1, 13, 1 << langid.BITS])
def test_packed_features_are_whole_and_small(n, share):
    rng = np.random.default_rng(n)
    x = np.where(rng.random(n) < share, rng.random(n), 0).astype(np.float32)
    row, back = langid.packed(x), np.zeros(n, np.float32)
    langid.unpack(row, back)
    assert (back == x.astype(np.float16)).all() and len(row) <= -(-n // 8) + 2 * np.count_nonzero(x)


def test_a_training_sample_is_held_once(spark, monkeypatch):
    texts = [" ".join(words(40, i)) for i in range(300)]
    docs = frame(spark, texts).unionByName(frame(spark, texts[::-1], 1000, "de"))
    held = []
    monkeypatch.setattr(langid, "fit", lambda x, langs: held.append((x.nbytes, len(set(langs.tolist())))))
    tracemalloc.start()
    try:
        langid.train(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    size, langs = held[0]
    assert langs == 2 and size > 300 * 4 << langid.BITS and peak < 1.3 * size


def test_written_tables_have_the_driver_return_what_it_freed(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "settle", lambda s: calls.append(s))
    assert common.Scratch(spark, "t").cut(spark.range(3)).count() == 3 and calls == [spark]


def test_the_jvm_returns_memory_now_and_then(spark, monkeypatch):
    monkeypatch.setattr(common, "_last", [-1e9])
    version = tuple(int(x) for x in spark.sparkContext._jvm.java.lang.System.getProperty("java.version").split("-")[0].split("."))
    if version < (17, 0, 9):
        pytest.skip("this JVM has no such command")
    assert common.settle(spark) and not common.settle(spark)


def test_a_jvm_without_the_command_is_left_alone(monkeypatch):
    class Lacks:
        def __getattr__(self, name):
            raise Py4JError("no such thing")

    monkeypatch.setattr(common, "_last", [-1e9])
    assert common.settle(SimpleNamespace(sparkContext=SimpleNamespace(_jvm=Lacks(), _gateway=None))) is False
