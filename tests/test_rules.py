"""Row rules on the made month: one marker for each bad row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import copies, rules, staging
from plumbline.settings import Month, load
from plumbline.sources.tables import with_position
from tests import made_month as m


@pytest.fixture(scope="module")
def final(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "trips.parquet")
    m.parquet(path)
    zones = spark.createDataFrame(m.ZONES, "location_id int, borough string, zone string, service_zone string")
    lic = spark.createDataFrame([("HV0003", "Uber", "UBER"), ("HV0005", "Lyft", "LYFT")], "hvfhs_license_num string, brand string, control_key string")
    return staging.check(with_position(spark, path), zones, lic, m.MONTH, load()).cache()


@pytest.fixture(scope="module")
def lists(final):
    marks = m.markers()
    out: dict[str, set] = {}
    for r in final.select("source_row_id", "failed_rules", "warned_rules").collect():
        out.setdefault(marks[r[0]], set()).add((r[1], r[2]))
    return out


@pytest.mark.parametrize("rule", ["SCH01", "SCH02", "REF01", "TMP01", "TMP02", "TMP03", "TMP04", "DOM04"])
def test_error_marker_fails_its_rule_alone(lists, rule):
    assert {f for f, _ in lists[rule]} == {rule}


def test_unknown_zone_fails_and_warns(lists):
    assert lists["REF02"] == {("REF02", "REF03")}


@pytest.mark.parametrize("rule", ["REF03", "DOM01", "DOM02", "DOM03"])
def test_warning_marker_is_clean(lists, rule):
    assert lists[rule] == {("", rule)}


@pytest.mark.parametrize("mark", ["background", "m_ok", "edge600", "original", "padding", "lyft_ok"])
def test_good_rows_are_clean(lists, mark):
    assert lists[mark] == {("", "")}


def test_no_row_is_lost_or_multiplied(final):
    assert final.count() == len(m.rows()) and final.select("source_row_id").distinct().count() == len(m.rows())


def test_wait_is_the_sum_of_its_parts(final):
    assert final.filter("response_s + curbside_s <> wait_s").count() == 0


def test_counts_agree_with_flags(final):
    got = {(r[0], r[1]): r[2] for r in rules.counts(final).groupBy("rule_id", "hvfhs_license_num").agg(F.sum("n_failed")).collect()}
    assert got["TMP02", "HV0005"] == 6 and got["TMP02", "HV0003"] == 1 and got["ANY_ERROR", "HV9999"] == 1 and got["DOM04", "HV0003"] == 1


def test_null_predicate_fails(spark):
    r = rules.Rule("X", "x", "ERROR", "", lambda p: F.col("a") > 1, "", "")
    p = rules.Params(Month(2026, 2).start, Month(2026, 2).after)
    got = rules.apply(spark.createDataFrame([(None,), (2,)], "a int"), p, [r]).orderBy(F.col("a").asc_nulls_first()).collect()
    assert [x["pass_X"] for x in got] == [False, True] and got[0]["failed_rules"] == "X"


def test_later_copies_treat_nulls_as_equal(spark):
    rows = spark.createDataFrame([(0, None, "a"), (1, None, "a"), (2, 1.0, "a"), (3, None, "a"), (4, None, None)], "id long, x double, y string")
    assert sorted(r[0] for r in copies.later_copies(rows, "id").collect()) == [1, 3]


def test_unique_keys_are_asserted(spark):
    with pytest.raises(ValueError, match="not unique"):
        copies.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
