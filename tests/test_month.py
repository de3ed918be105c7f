"""Runs of whole months: publication, reruns, refusals, isolation."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from plumbline.operators.checks import CHECKS
from plumbline.plans.month import Engine, run
from plumbline.settings import Month, load
from tests import made_month as m


@pytest.fixture
def settings(tmp_path):
    limits = {"kpi.min_cell_requests": 5, "validation.max_error_row_pct": 10.0}
    return load(root=tmp_path, overrides={"paths.raw": "raw", "paths.warehouse": "wh", "paths.outputs": "out", "paths.logs": "logs", **limits})


def serve(settings, tmp_path, change=lambda t: t, **more):
    return m.Server(settings, m.parquet(tmp_path / "made.parquet", change), **more)


def go(spark, settings, server, months=(m.MONTH,), **how):
    return run(spark, list(months), settings, server, sleep=lambda _: None, **how)


def outputs(settings):
    skip = ("last_run.json",)
    root = settings.path("outputs")
    return {str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(root.rglob("*")) if p.is_file() and p.name not in skip}


def checks_of(summary, month="2026-02"):
    return {c.check_id if hasattr(c, "check_id") else c["check_id"]: (c.status if hasattr(c, "status") else c["status"]) for c in summary["months"][month]["checks"]}


def test_month_is_published_and_reruns_are_identical(spark, settings, tmp_path):
    server = serve(settings, tmp_path)
    first = go(spark, settings, server)
    assert first["status"] == "OK", first
    got = first["months"]["2026-02"]
    assert (got["retrieval_status"], got["metric_status"]) == ("RECONCILED", "FINAL")
    before = outputs(settings)
    assert {"metrics/m1_m2_kpi_dispatcher_month.csv", "scorecard.md", "validation_rules.md", "profile/2026-02_trips_profile.csv", "validation/2026-02/rule_results.csv"} <= set(before)
    kpi = (settings.path("outputs") / "metrics/m1_m2_kpi_dispatcher_month.csv").read_text().splitlines()
    assert kpi[1].startswith("2026-02,HV0003,Uber,21,20,1,0.9524,true,0.9048,0.9,0.9,0.8571,0.9048,MEETS (estimate)")
    assert go(spark, settings, None, offline=True)["status"] == "OK"
    assert outputs(settings) == before
    documented = {c[0] for c in CHECKS}
    assert {c.split("-")[0] for c in checks_of(first)} <= documented
    engine = Engine(spark, settings, offline=True)
    assert engine.warehouse.attempts().count() == 2 and len(engine.warehouse.published()) == 1
    assert engine.warehouse.table("fct_wav_trip").count() == 31


def _without_day(t: pa.Table) -> pa.Table:
    return t.filter(pc.not_equal(pc.day(t["pickup_datetime"]), 13))


@pytest.mark.parametrize(
    "change,error,check",
    [
        (lambda t: t.drop_columns(["wav_match_flag"]), "FIL01", "FIL01"),
        (lambda t: t.set_column(t.schema.get_field_index("PULocationID"), "PULocationID", t["PULocationID"].cast(pa.string())), "FIL01", "FIL01"),
        (_without_day, "FIL03", "FIL03"),
    ],
)
def test_broken_files_are_refused(spark, settings, tmp_path, change, error, check):
    got = go(spark, settings, serve(settings, tmp_path, change))
    assert got["status"] == "FAILED" and got["months"]["2026-02"]["error_type"] == error and checks_of(got)[check] == "FAIL"
    here = settings.path("outputs") / "validation/2026-02"
    assert (here / "REFUSED.json").exists() and (here / "file_checks.csv").exists()


def test_too_many_errors_and_extra_columns(spark, settings, tmp_path):
    got = go(spark, settings.override({"validation.max_error_row_pct": 1.0}), serve(settings, tmp_path, lambda t: t.append_column("new_fee", pa.array([0.0] * len(t)))))
    assert got["months"]["2026-02"]["error_type"] == "FIL06" and checks_of(got)["FIL01"] == "PASS"


def test_control_mismatch_refuses_unless_allowed(spark, settings, tmp_path):
    server = serve(settings, tmp_path, control={"UBER": 1, "LYFT": m.counts()["HV0005"]})
    got = go(spark, settings, server)
    assert got["months"]["2026-02"]["error_type"] == "REC01" and got["months"]["2026-02"]["comparisons"]
    assert (settings.path("outputs") / "validation/2026-02/reconciliation.csv").read_text().count("MISMATCH") == 1
    got = go(spark, settings, server, allow_unreconciled=True)
    assert got["status"] == "OK" and got["months"]["2026-02"]["retrieval_status"] == "UNRECONCILED" and not (settings.path("outputs") / "validation/2026-02/REFUSED.json").exists()


def test_fallback_control(spark, settings, tmp_path):
    got = go(spark, settings, serve(settings, tmp_path, control={}))
    assert got["months"]["2026-02"]["retrieval_status"] == "RECONCILED_FALLBACK" and got["months"]["2026-02"]["metric_status"] == "PROVISIONAL"


def test_failed_months_leave_others_and_the_last_good_one(spark, settings, tmp_path):
    server = serve(settings, tmp_path)
    got = go(spark, settings, server, months=(m.MONTH, Month(2026, 3)))
    assert got["status"] == "PARTIAL" and got["months"]["2026-03"]["error_type"] == "SRC01" and got["try_again"] == ["2026-03"]
    assert "2026-03" in (settings.path("outputs") / "scorecard.md").read_text()
    good = (settings.path("outputs") / "validation/2026-02/rule_results.csv").read_text()
    server.files[settings["sources.trips.url_template"].format(month=m.MONTH)] = m.parquet(tmp_path / "bad.parquet", _without_day)
    got = go(spark, settings, server, refresh=True)
    assert got["status"] == "FAILED" and Engine(spark, settings, offline=True).warehouse.table("fct_wav_trip").count() == 31
    assert (settings.path("outputs") / "validation/2026-02/rule_results.csv").read_text() == good and not (settings.path("outputs") / "validation/2026-02/REFUSED.json").exists()


def test_without_zones_nothing_runs(spark, settings, tmp_path):
    server = serve(settings, tmp_path)
    server.files[settings["sources.zones.url"]] = b"LocationID,Borough,Zone,service_zone\n1,a,b,c\n1,a,b,c\n"
    got = go(spark, settings, server)
    assert got["status"] == "FAILED" and got["months"] == {} and got["error"].startswith("ZON02") and got["try_again"] == []


def test_command_line():
    import run_months

    with pytest.raises(SystemExit) as e:
        run_months.main(["--month", "2026-13"])
    assert e.value.code == 2
    with pytest.raises(SystemExit):
        run_months.main(["--month", "2026-02", "--offline", "--refresh"])


def test_driver_rounds_as_spark_does(spark):
    from pyspark.sql import functions as F

    from plumbline.plans.exports import half_up

    values = [0.00005, 2.5, 1.00005, 0.12345, -0.00005, 1 / 3, 2 / 3, 0.89995, 1e-9, 123456.78905, 0.0, None]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(F.round("x", 4)).collect()
    assert [r[0] for r in got] == [half_up(v, 4) for v in values]


def test_a_month_on_another_file_system(spark, settings, tmp_path):
    """Warehouse, shared files and pages behind viewfs, which only Hadoop's clients can read."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.month.link./m", f"file://{tmp_path}/far")
    far = settings.override({"paths.warehouse": "viewfs://month/m/wh", "paths.shared": "viewfs://month/m/shared"})
    (tmp_path / "far").mkdir()
    server = serve(far, tmp_path)
    got = go(spark, far, server)
    assert got["status"] == "OK", got
    assert (tmp_path / "far" / "wh" / "commits" / "0000000001.json").exists() and not (tmp_path / "wh").exists()
    again = go(spark, far, None, offline=True)
    assert again["status"] == "OK" and again["months"]["2026-02"]["retrieval_status"] == "RECONCILED"
    w = Engine(spark, far, offline=True).warehouse
    assert w.root.startswith("viewfs:") and w.table("fct_wav_trip").count() == 31 and w.commits() == [1, 2]
    assert {r["brand"] for r in w.reference("dim_licensee").collect()} >= {"Uber", "Lyft"}
