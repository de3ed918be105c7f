from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

import corpus_pipeline as c
from plumbline.llm import decontaminate, dedup, pii
from plumbline.llm.common import table
from tests.llm.made import SCHEMA, awkward

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test data here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's documents, written and read again as the driver does."""
    home = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, DATA, "documents"), []
    for i, (name, stage) in enumerate(c.STAGES):
        stage(spark, docs, DATA).write.parquet(f"file://{home}/{i}")
        docs = spark.read.parquet(f"file://{home}/{i}")
        out.append((name, docs))
    return out


def test_columns_and_order(spark, stages):
    want = table(spark, DATA, "documents").dtypes
    assert [n for n, _ in stages] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(df.dtypes == want for _, df in stages[:-1])


def test_decisions_take_effect(spark, stages):
    got = dict(stages)
    kept = {r["doc_id"] for r in got["language"].collect()}
    near = {r["doc_id"] for r in dedup.near_components(got["language"], *c.NEAR).filter("kept").collect()}
    assert {r["doc_id"] for r in got["near_duplicates"].collect()} == near <= kept
    leaky = {r["doc_id"] for r in decontaminate.leaks(got["near_duplicates"], table(spark, DATA, "benchmark")).collect()}
    assert leaky and {r["doc_id"] for r in got["decontamination"].collect()} == near - leaky
    assert pii.report(pii.find(got["personal_data"])).filter("spans <> ''").count() == 0
    assert got["personal_data"].count() == got["decontamination"].count()
    assert {r["doc_id"] for r in got["packing"].collect()} == near - leaky


def test_run_gives_the_last_stage(spark, stages):
    cols = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, c.run(spark, DATA).select(cols).collect())) == sorted(map(tuple, stages[-1][1].select(cols).collect()))


#: Names that stages use within, and others that they might.
NAMES = """pii_row_ pii_base_ pii_seen_ pii_text_ pii_added_ pii_r_ p_ q_ o near_row_ near_gone_ r_ d_ h_ n_ k_ t_ c_ c0 c1 label_ cluster block
version shingles node labels row rows keys held_out lang_pred score ambiguous base added who kind marked item_id hits piece pieces ids sequence_id offset
doc_tokens start length ids_crc32 group_ place hash_ c_row pattern hit belief v b a with ask col_0 fp_a fp_b n_shingles component_id kept pos cls text_ n""".split()


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Given and awkward documents with further columns of all these names; a folder with the benchmark beside them."""
    home = f"file://{tmp_path_factory.mktemp('odd')}"
    rows = table(spark, DATA, "documents").unionByName(awkward(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    mail = " ".join(["please write to ann.b@example.org or call +1 202 555 0143 about the last meeting of the board"] * 3)
    rows = rows.unionByName(spark.createDataFrame([(None, mail, "en", None, None), (900_001, mail, "en", "s", 1), (900_001, mail, "en", "s", 1)], SCHEMA))
    rows.withColumns({n: F.lit(f"{n} of row") for n in NAMES}).write.parquet(f"{home}/documents.parquet")
    table(spark, DATA, "benchmark").write.parquet(f"{home}/benchmark.parquet")
    return home


def test_odd_rows_and_names_go_through_every_stage(spark, odd, tmp_path):
    docs = table(spark, odd, "documents")
    want, counts = docs.dtypes, [docs.count()]
    for i, (_, stage) in enumerate(c.STAGES[:-1]):
        stage(spark, docs, odd).write.parquet(f"file://{tmp_path}/{i}")
        docs = spark.read.parquet(f"file://{tmp_path}/{i}")
        assert docs.dtypes == want
        counts.append(docs.count())
        assert docs.filter(" or ".join(f"coalesce(`{n}`, '') <> '{n} of row'" for n in NAMES)).count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] > 50
    mails = [r["text"] for r in docs.filter("text like '%about the last meeting of the board%'").collect()]
    assert len(mails) == 1 and "[EMAIL]" in mails[0] and "example.org" not in mails[0] and "[PHONE]" in mails[0]
    last = c.STAGES[-1][1](spark, docs, odd)
    assert {r["doc_id"] for r in last.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_run_over_odd_rows_and_over_none(spark, odd, tmp_path):
    whole = c.run(spark, odd)
    assert whole.count() > 50
    home = f"file://{tmp_path}"
    table(spark, odd, "documents").limit(0).write.parquet(f"{home}/documents.parquet")
    table(spark, odd, "benchmark").write.parquet(f"{home}/benchmark.parquet")
    assert c.run(spark, home).collect() == []
