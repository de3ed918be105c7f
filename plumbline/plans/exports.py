"""Results as files: ordered CSV with rounding by type, a Markdown scorecard, rule documentation and refusal evidence.

All results here are a few rows for each month and dispatcher, or a bounded sample, so the driver writes them; every
file is written aside and renamed, and every export is ordered, so that a rerun gives the same bytes.
"""

from __future__ import annotations

import csv
import io
import json
import math
from collections.abc import Iterable, Sequence
from decimal import ROUND_HALF_UP, Decimal
from pathlib import Path
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import checks, copies, rules
from plumbline.plans.rounding import rounded
from plumbline.sources.files import write_atomic

#: Metric -> its sort keys.
ORDER: dict[str, tuple[str, ...]] = {
    "m1_m2_kpi_dispatcher_month": ("month", "hvfhs_license_num"),
    "m1_m2_kpi_ytd": ("year", "hvfhs_license_num"),
    "m3_response_gap": ("month", "hvfhs_license_num"),
    "m4_stage_decomposition": ("month", "hvfhs_license_num"),
    "m5_service_gap_summary": ("month", "hvfhs_license_num"),
    "m5_service_gap_cells": ("month", "hvfhs_license_num", "pu_borough", "hour_band"),
    "dq_negative_response_signature": ("month", "hvfhs_license_num", "wav_requested"),
    "dq_segment_profile": ("month", "hvfhs_license_num", "wav_requested"),
}


def _cell(v: Any) -> Any:
    return "" if v is None else str(v).lower() if isinstance(v, bool) else v


def write_rows(path: Path, header: Sequence[str], rows: Iterable[Sequence[Any]]) -> None:
    text = io.StringIO()
    w = csv.writer(text, lineterminator="\n")
    w.writerow(header)
    w.writerows([_cell(v) for v in row] for row in rows)
    write_atomic(path, text.getvalue())


def write_frame(df: DataFrame, path: Path, order: Sequence[Any], digits: int = 4) -> None:
    """A small frame as one CSV file, doubles rounded, ordered."""
    out = rounded(df, digits).orderBy(*order)
    write_rows(path, out.columns, out.collect())


class Gathered(NamedTuple):
    """A metric's columns and ordered rows."""

    columns: list[str]
    rows: list[dict[str, Any]]


def gather(found: dict[str, DataFrame]) -> dict[str, Gathered]:
    """Every metric, computed once for all exports: a few rows for each month and dispatcher."""
    return {name: Gathered(df.columns, [r.asDict() for r in df.orderBy(*ORDER[name]).collect()]) for name, df in found.items()}


def half_up(v: Any, digits: int) -> Any:
    """Doubles rounded half up on their shortest decimal form, as Spark rounds them; other values as they are."""
    if not isinstance(v, float) or not math.isfinite(v):
        return v
    return float(Decimal(repr(v)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def write_metrics(found: dict[str, Gathered], folder: Path, digits: int = 4) -> None:
    for name, (columns, rows) in found.items():
        write_rows(folder / f"{name}.csv", columns, [[half_up(v, digits) for v in r.values()] for r in rows])


# --- a month's evidence ----------------------------------------------------------------------------------------------


def _profile(rows: list[dict[str, Any]], path: Path) -> None:
    head = ("column_name", "column_type", "n_rows", "non_null", "null_pct", "n_distinct", "min", "max", "mean")
    write_rows(path, head, [[r[h] for h in head] for r in rows])


def month_evidence(engine: Any, month: Any, r: Any, out: Path) -> None:
    """Rule results, checks, comparisons, quarantine and daily volume of a published month."""
    here, wh, spark = out / "validation" / str(month), engine.warehouse, engine.spark
    results = wh.table("validation_rule_result", str(month)).join(rules.registry_frame(spark), "rule_id").join(wh.reference("dim_licensee").select("month", "hvfhs_license_num", "brand"), ["month", "hvfhs_license_num"], "left")
    pct = F.round(F.try_divide(100.0 * F.col("n_failed"), F.col("n_checked").cast("double")), 4).alias("pct_failed")
    write_frame(results.select("rule_id", "category", "severity", "rule", "hvfhs_license_num", "brand", "wav_requested", "n_checked", "n_failed", pct, "why", "action"), here / "rule_results.csv", ("rule_id", "hvfhs_license_num", "wav_requested"))
    write_frame(wh.table("file_check", str(month)).drop("month"), here / "file_checks.csv", ("check_id",))
    write_frame(wh.table("reconciliation", str(month)).drop("month"), here / "reconciliation.csv", ("control_source", "scope"), 5)
    fact = wh.table("fct_wav_trip", str(month))
    write_frame(checks.quarantine_summary(fact), here / "quarantine_wav_summary.csv", ("hvfhs_license_num", F.desc("n_rows"), "failed_rules"))
    shown = ("source_row_id", "hvfhs_license_num", "dispatching_base_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "pu_location_id", "pu_borough", "response_s", "curbside_s", "failed_rules", "warned_rules")
    sample = copies.sample_per_group(fact.filter("NOT is_clean").select(*shown), ["hvfhs_license_num", "failed_rules"], ["source_row_id"], 25)
    write_frame(sample, here / "quarantine_wav_sample.csv", ("hvfhs_license_num", "failed_rules", "source_row_id"))
    write_rows(here / "daily_volume_by_licensee.csv", ("hvfhs_license_num", "day", "trips"), sorted(r.daily, key=lambda x: (x[0] or "", x[1])))
    _profile(r.profile, out / "profile" / f"{month}_trips_profile.csv")
    (here / "REFUSED.json").unlink(missing_ok=True)


def refusal(r: Any, here: Path) -> None:
    """Why a month that never stood was refused, with the figures behind it."""
    write_atomic(here / "REFUSED.json", json.dumps({"month": r.month, "status": "REFUSED", "stopped_by": r.error_type, "stage": r.stage, "may_pass_later": r.again, "reason": r.error, "note": "Nothing of this month was published."}, indent=2) + "\n")
    head = ("check_id", "name", "severity", "status", "observed", "expected", "detail")
    write_rows(here / "file_checks.csv", head, [x.row().values() for x in sorted(r.checks, key=lambda x: x.check_id)])
    write_rows(here / "reconciliation.csv", ("control_source", "scope", "file_trips", "control_trips", "diff", "diff_pct", "status"), [(x.control_source, x.scope, x.file_trips, x.control_trips, x.diff, None if x.diff_pct is None else round(x.diff_pct, 5), x.status) for x in r.comparisons])
    if r.daily:
        write_rows(here / "daily_volume_by_licensee.csv", ("hvfhs_license_num", "day", "trips"), sorted(r.daily, key=lambda x: (x[0] or "", x[1])))
    if r.profile:
        _profile(r.profile, here / "trips_profile.csv")


# --- Markdown --------------------------------------------------------------------------------------------------------

DASH = "—"


def pct(v: float | None, digits: int = 1) -> str:
    return DASH if v is None else f"{100 * v:.{digits}f}%"


def num(v: float | None, digits: int = 1) -> str:
    return DASH if v is None else f"{v:.{digits}f}"


def whole(v: int | None) -> str:
    return DASH if v is None else f"{int(v):,}"


def table(head: Sequence[str], rows: Iterable[Sequence[str]]) -> str:
    rows = list(rows)
    if not rows:
        return "_No rows._\n"
    return "\n".join(["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(map(str, r)) + " |" for r in rows)]) + "\n"


def scorecard(engine: Any, found: dict[str, Gathered], path: Path) -> None:
    """Seven sections: trust, verdicts, gap, stages, places, impossible times, rules that fired."""
    k, wh = engine.s["kpi"], engine.warehouse
    of = lambda name: found[name].rows if name in found else []
    status = {x["month"]: x for x in wh.table("month_status").collect()} if found else {}
    recon = wh.table("reconciliation").orderBy("month", "control_source", "scope").collect() if found else []
    target = k["target_rate"]
    yes = lambda b: "Y" if b else "N"
    parts = [
        "# Accessible dispatch service scorecard\n",
        f"Standard: at least {target:.0%} of accessible requests served in under {k['threshold_seconds'] // 60} minutes, from request to arrival.\n",
        "## 1. Can these numbers be trusted?\n",
        "A month is RECONCILED when every licensee's trips match the totals that were filed independently, and RECONCILED_FALLBACK when only the city-wide total does. "
        "UNRECONCILED months were published by explicit permission or for want of any control. Figures are FINAL only after a full reconciliation; all others may still change.\n",
        table(("Month", "Trips", "Control", "Scope", "Comparison", "Retrieval", "Metrics"), [(x["month"], whole(status[x["month"]]["trips_rows"]), x["control_source"], x["scope"], x["status"] if x["diff_pct"] is None else f"{x['status']} ({x['diff_pct']:+.3f}%)", status[x["month"]]["retrieval_status"], status[x["month"]]["metric_status"]) for x in recon]),
    ]
    last = copies.latest_of_key(wh.attempts(), ["month"], ["finished_at"])
    refused = [x for x in last.filter("status = 'FAILED'").orderBy("month").collect() if x["month"] not in status]
    if refused:
        parts += ["Months that were tried and refused:\n", table(("Month", "Stopped by", "Reason"), [(x["month"], x["error_type"], x["detail"]) for x in refused])]
    parts += [
        "## 2. Service rate (M1) and evidence coverage (M2)\n",
        table(("Month", "Dispatcher", "Requests", "Coverage", "Naive rate", "Clean rate", "Bounds", "Status", "Basis"), [(x["month"], f"{x['brand']} ({x['hvfhs_license_num']})", whole(x["wav_requests"]), pct(x["m2_evidence_coverage"]), pct(x["naive_rate_unvalidated"]), pct(x["clean_record_rate"]) + ("" if x["measurable"] else " (not decision-grade)"), f"{pct(x['m1_bound_low'])} to {pct(x['m1_bound_high'])}", f"**{x['kpi_status']}**", x["verdict_basis"]) for x in of("m1_m2_kpi_dispatcher_month")]),
        f"- Coverage is the share of requests whose record passes all ERROR rules: how much of the month can be judged at all.\n"
        f"- The naive rate takes every record as it stands, so an impossible negative response counts as a fast one; it is shown to be compared, never to be quoted.\n"
        f"- The clean rate counts clean records alone. The bounds count all others once as late and once as in time.\n"
        f"- MEETS and BELOW without more are proven: both bounds are on one side of {target:.0%}. (estimate) rests on the clean rate. NOT MEASURABLE withholds a verdict.\n",
        f"Proven verdicts hold whatever the quarantined records were. Estimates need a coverage of {k['measurability_gate']:.0%}. Otherwise nothing is claimed.\n",
        table(("Year", "Dispatcher", "Months", "Requests", "Coverage", "M1", "Bounds", "Status", "All final"), [(x["year"], x["brand"], x["months_included"], whole(x["wav_requests"]), pct(x["m2_evidence_coverage"]), pct(x["m1_service_rate_10min"]), f"{pct(x['m1_bound_low'])} to {pct(x['m1_bound_high'])}", x["kpi_status"], "yes" if x["all_months_final"] else "no") for x in of("m1_m2_kpi_ytd")]),
        "## 3. Gap to standard service (M3)\n",
        "Minutes from request to arrival on clean records. The gap is between ninth deciles, since a rider plans for a bad day; a dash on the accessible side means that its coverage is below the gate.\n",
        table(("Month", "Dispatcher", "P50 / P90 accessible", "P50 / P90 standard", "P90 gap", "Standard rate"), [(x["month"], x["brand"], f"{num(x['wav_response_p50_min'])} / {num(x['wav_response_p90_min'])}", f"{num(x['nonwav_response_p50_min'])} / {num(x['nonwav_response_p90_min'])}", num(x["m3_p90_gap_min"], 2), pct(x["nonwav_service_rate_10min"])) for x in of("m3_response_gap")]),
        "## 4. Where the extra wait lies (M4)\n",
        "Means add up, so the extra wait is the sum of its part before arrival and its part at the kerb. The kerb share can pass 100% or be negative when the two parts have opposite signs.\n",
        table(("Month", "Dispatcher", "Mean wait accessible / standard", "Extra wait", "Before arrival", "At the kerb", "Kerb share", "Median kerb accessible / standard"), [(x["month"], x["brand"], f"{num(x['wav_wait_mean_min'], 2)} / {num(x['nonwav_wait_mean_min'], 2)}", num(x["extra_wait_min"], 2), num(x["extra_response_min"], 2), num(x["extra_curbside_min"], 2), pct(x["m4_curbside_share_of_extra_wait"]), f"{num(x['wav_curbside_p50_min'], 2)} / {num(x['nonwav_curbside_p50_min'], 2)}") for x in of("m4_stage_decomposition")]),
        "## 5. Places and hours below the standard (M5)\n",
        f"A cell is a borough and a band of hours with at least {k['min_cell_requests']} clean requests. It is significantly below when even the upper end of its 95% interval misses the standard; below by point estimate alone may be chance.\n",
        table(("Month", "Dispatcher", "Cells judged", "Significantly below", "Share of demand there", "Share of late arrivals", "Below by point estimate only", "Requests in small cells"), [(x["month"], x["brand"], whole(x["cells_judged"]), whole(x["cells_significantly_below"]), pct(x["m5_share_of_demand_in_below_target_cells"]), pct(x["share_of_late_arrivals_in_those_cells"]), whole(x["cells_below_point_estimate"] - x["cells_significantly_below"]), whole(x["requests_in_low_volume_cells"])) for x in of("m5_service_gap_summary")]),
        table(("Month", "Dispatcher", "Borough", "Band", "Requests", "Rate (95%)", "Significant", "P90", "Late", "Standard rate"), [(x["month"], x["brand"], x["pu_borough"], x["hour_band"], whole(x["wav_requests_clean"]), f"{pct(x['wav_service_rate_10min'])} ({pct(x['wilson_low'])} to {pct(x['wilson_high'])})", "yes" if x["significantly_below"] else "no", num(x["wav_response_p90_min"]), whole(x["wav_late_arrivals"]), pct(x["nonwav_service_rate_10min"])) for x in sorted((x for x in of("m5_service_gap_cells") if x["below_target"]), key=lambda x: (x["month"], x["hvfhs_license_num"], not x["significantly_below"], -x["wav_late_arrivals"], x["pu_borough"], x["hour_band"]))]),
        "## 6. Impossible response times\n",
        "A vehicle can't arrive before it is called for. Where nearly all such requests fall on whole minutes and valid ones don't, the request time is likely a booked time; where they don't, another cause has to be found.\n",
        table(("Month", "Dispatcher", "Accessible", "Negative", "Share", "On a whole minute", "On a fifth minute", "Valid on a whole minute", "Signature"), [(x["month"], x["brand"], yes(x["wav_requested"]), whole(x["n_negative"]), pct(x["negative_share"]), pct(x["negative_whole_minute_share"]), pct(x["negative_5min_mark_share"]), pct(x["valid_whole_minute_share"]), x["signature"]) for x in of("dq_negative_response_signature") if x["n_negative"]]),
        table(("Month", "Dispatcher", "Accessible", "Records", "Bases", "Originating base set", "Arrival = pickup: airports / elsewhere", "Raw P01 / P50 / P99", "Clean P50 / P90"), [(x["month"], x["brand"], yes(x["wav_requested"]), whole(x["n_records"]), whole(x["n_dispatching_bases"]), pct(x["originating_base_present_share"]), f"{pct(x['onscene_eq_pickup_share_airports'])} / {pct(x['onscene_eq_pickup_share_elsewhere'])}", f"{num(x['raw_response_p01_min'])} / {num(x['raw_response_p50_min'])} / {num(x['raw_response_p99_min'])}", f"{num(x['clean_response_p50_min'])} / {num(x['clean_response_p90_min'])}") for x in of("dq_segment_profile")]),
        "## 7. Rules that fired\n",
        "ERROR rules set rows aside, and the bounds of section 2 account for them. WARN rules leave figures as they are.\n",
    ]
    fired = []
    if found:
        v = wh.table("validation_rule_result").filter("n_failed > 0").filter(F.col("rule_id") != rules.ANY_ERROR)
        v = v.join(rules.registry_frame(engine.spark).select("rule_id", "severity", "rule"), "rule_id").join(engine.warehouse.reference("dim_licensee").select("month", "hvfhs_license_num", "brand"), ["month", "hvfhs_license_num"], "left")
        v = v.withColumn("who", F.coalesce("brand", "hvfhs_license_num")).orderBy("month", "rule_id", "who", "wav_requested")
        fired = [(x["month"], x["rule_id"], x["severity"], x["rule"], x["who"], x["wav_requested"], whole(x["n_failed"]), f"{100 * x['n_failed'] / x['n_checked']:.3f}%") for x in v.collect()]
    parts.append(table(("Month", "Rule", "Severity", "Text", "Dispatcher", "Accessible", "Rows", "Share"), fired))
    write_atomic(path, "\n".join(parts))


def rules_document(settings: Any, path: Path) -> None:
    """The registries as text, so that documentation can't drift from code."""
    target, gate = settings["kpi.target_rate"], settings["kpi.measurability_gate"]
    write_atomic(path, "\n".join((
        "# Validation rules\n", "## Checks of a file\n", table(("ID", "Check", "Severity", "Why", "On failure"), checks.CHECKS),
        "## Rules for rows\n", table(("ID", "Category", "Severity", "Rule", "Why", "Action"), [(r.rule_id, r.category, r.severity, r.rule, r.why, r.action) for r in rules.REGISTRY]),
        "## Verdict\n", f"Quarantined records count once as failures and once as passes. Bounds on one side of {target:.0%} prove a verdict; else the clean rate decides if {gate:.0%} of the records are clean; else the rate is not measurable.\n",
    )))
