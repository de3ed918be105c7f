"""Verdicts on counts, and figures of the made month against plain Python."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators import metrics, segments, staging
from plumbline.settings import Month, load
from plumbline.sources.tables import with_position
from tests import made_month as m

CASES = [((100, 95, 93), "MEETS"), ((100, 85, 60), "BELOW"), ((100, 95, 86), "MEETS (estimate)"), ((100, 95, 84), "BELOW"), ((100, 40, 38), "NOT MEASURABLE"), ((100, 95, 85), "BELOW (estimate)"), ((10, 9, 9), "MEETS"), ((5, 0, 0), "NOT MEASURABLE")]


@pytest.mark.parametrize("counts,expected", CASES)
def test_verdict(spark, counts, expected):
    rows = spark.createDataFrame([counts], "n long, c long, u long")
    x = metrics._bounds("n", "c", "u")
    assert rows.select(metrics.verdict(x["low_"], x["high_"], x["coverage_"], x["rate_"], metrics.Standard())).first()[0] == expected


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "trips.parquet")
    m.parquet(path)
    zones = spark.createDataFrame(m.ZONES, "location_id int, borough string, zone string, service_zone string")
    lic = spark.createDataFrame([("HV0003", "Uber", "UBER"), ("HV0005", "Lyft", "LYFT")], "hvfhs_license_num string, brand string, control_key string")
    final = staging.check(with_position(spark, path), zones, lic, m.MONTH, load())
    agg = segments.aggregates(final, 600).cache()
    status = spark.createDataFrame([("2026-02", "FINAL")], "month string, metric_status string")
    return {"final": final, "agg": agg, "kpi": metrics.kpi(agg, lic, status, metrics.Standard(min_cell=5)).cache(), "lic": lic, "status": status}


def one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    (row,) = df.collect()
    return row


def test_measurable_dispatcher(made):
    r = one(made["kpi"], hvfhs_license_num="HV0003")
    assert (r["wav_requests"], r["wav_requests_clean"]) == (21, 20)
    assert math.isclose(r["m1_service_rate_10min"], 18 / 20) and math.isclose(r["m1_bound_low"], 18 / 21) and math.isclose(r["m1_bound_high"], 19 / 21)
    assert math.isclose(r["naive_rate_unvalidated"], 19 / 21) and r["kpi_status"] == "MEETS (estimate)"


def test_withheld_dispatcher(made):
    r = one(made["kpi"], hvfhs_license_num="HV0005")
    assert r["naive_rate_unvalidated"] == 1.0 and math.isclose(r["m2_evidence_coverage"], 0.4) and r["m1_service_rate_10min"] is None and r["kpi_status"] == "NOT MEASURABLE"
    gap = one(metrics.response_gap(made["agg"], made["kpi"]), hvfhs_license_num="HV0005")
    assert gap["m3_p90_gap_min"] is None and gap["nonwav_response_p90_min"] is not None
    assert metrics.cells(made["agg"], made["kpi"], metrics.Standard(min_cell=5)).filter("hvfhs_license_num = 'HV0005'").count() == 0


def test_cells(made):
    cells = metrics.cells(made["agg"], made["kpi"], metrics.Standard(min_cell=5))
    bronx, manhattan = one(cells, pu_borough="Bronx"), one(cells, pu_borough="Manhattan")
    assert bronx["hour_band"] == "20-24 evening" and bronx["wav_requests_clean"] == 6 and math.isclose(bronx["wav_service_rate_10min"], 4 / 6) and bronx["below_target"] and not bronx["significantly_below"]
    assert manhattan["wav_requests_clean"] == 14 and manhattan["wav_service_rate_10min"] == 1.0


def test_grains_add_up(made):
    fact = {r[0]: r[1] for r in segments.fact(made["final"]).groupBy("hvfhs_license_num").count().collect()}
    for level in ("dispatcher", "cell"):
        got = made["agg"].filter((F.col("level") == level) & F.col("wav_requested")).groupBy("hvfhs_license_num").agg(F.sum("n_records")).collect()
        assert {r[0]: r[1] for r in got} == fact == {"HV0003": 21, "HV0005": 10}


def test_quantiles_and_means_against_python(made):
    rows = [r for mark, r in m.rows() if r["wav_request_flag"] == "Y" and r["hvfhs_license_num"] == "HV0003" and not mark.startswith("TMP")]
    s = sorted((r["on_scene_datetime"] - r["request_datetime"]).total_seconds() for r in rows)

    def quantile(q):
        x = q * (len(s) - 1)
        lo = int(x)
        return s[lo] + (x - lo) * (s[min(lo + 1, len(s) - 1)] - s[lo])

    r = one(made["agg"], hvfhs_license_num="HV0003", level="dispatcher", wav_requested=True)
    assert math.isclose(r["response_p50_s"], quantile(0.5)) and math.isclose(r["response_p90_s"], quantile(0.9)) and math.isclose(r["response_mean_s"], sum(s) / len(s))


def test_extra_wait_splits_exactly(made):
    r = one(metrics.stage_decomposition(made["agg"], made["kpi"]), hvfhs_license_num="HV0003")
    assert math.isclose(r["extra_wait_min"], r["extra_response_min"] + r["extra_curbside_min"])


def test_signatures(made):
    got = metrics.negative_signature(segments.negative_responses(made["final"]), made["lic"], made["status"])
    assert one(got, hvfhs_license_num="HV0003", wav_requested=True)["signature"].startswith("pre-booked")
    assert one(got, hvfhs_license_num="HV0005", wav_requested=True)["signature"].startswith("no pre-booking")
    assert one(got, hvfhs_license_num="HV0003", wav_requested=False)["signature"] == "none"


@pytest.mark.parametrize("n,p,significant", [(1000, 0.70, True), (300, 0.87, False)])
def test_wilson(spark, n, p, significant):
    from plumbline.functions.columns import wilson

    low, high = spark.range(1).select(*wilson(F.lit(p), F.lit(n))).first()
    z = 1.959964
    mid, spread, scale = p + z * z / (2 * n), z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    assert math.isclose(low, (mid - spread) / scale) and math.isclose(high, (mid + spread) / scale) and (high < 0.9) == significant


def test_year_adds_months(spark, made):
    jan = made["agg"].withColumn("month", F.lit("2026-01"))
    both = spark.createDataFrame([("2026-01", "FINAL"), ("2026-02", "PROVISIONAL")], "month string, metric_status string")
    r = one(metrics.year_to_date(jan.unionByName(made["agg"]), made["lic"], both, metrics.Standard()), hvfhs_license_num="HV0003")
    assert (r["months_included"], r["n_months"], r["wav_requests"], r["all_months_final"]) == ("2026-01 2026-02", 2, 42, False)


def test_months():
    assert str(Month.parse("2026-12")) == "2026-12" and Month(2026, 12).after.isoformat() == "2027-01-01" and Month(2024, 2).days == 29
    for bad in ("2026-13", "2026-1", "x", "2026-00"):
        with pytest.raises(ValueError):
            Month.parse(bad)


def test_settings_refuse_unknown_names():
    s = load()
    with pytest.raises(KeyError):
        s["kpi.nothing"]
    with pytest.raises(KeyError):
        s.override({"kpi.targt_rate": 1})
    assert s.but(kpi__target_rate=0.8)["kpi.target_rate"] == 0.8 and s["kpi.target_rate"] == 0.9
