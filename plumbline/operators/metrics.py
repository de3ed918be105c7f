"""The published metrics, as functions of the month tables. Verdicts are taken on unrounded values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import first_match, share, when_known, wilson


@dataclass(frozen=True)
class Standard:
    """What a dispatcher is held to: the rate to reach, the evidence a verdict needs, and the least cell."""

    target: float = 0.90
    gate: float = 0.90
    min_cell: int = 100
    boroughs: tuple[str, ...] = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")


def verdict(low: Column, high: Column, coverage: Column, clean_rate: Column, s: Standard) -> Column:
    """First what holds whatever the quarantined rows were, then what holds on enough evidence, else nothing."""
    return first_match(
        (low >= s.target, "MEETS"),
        (high < s.target, "BELOW"),
        ((coverage >= s.gate) & (clean_rate >= s.target), "MEETS (estimate)"),
        (coverage >= s.gate, "BELOW (estimate)"),
        otherwise="NOT MEASURABLE",
    )


def basis(low: Column, high: Column, coverage: Column, s: Standard) -> Column:
    return first_match(
        (low >= s.target, "proven: holds even if every quarantined record failed"),
        (high < s.target, "proven: holds even if every quarantined record passed"),
        (coverage >= s.gate, "estimate: bounds straddle target; quarantined records treated as out of scope"),
        otherwise="withheld: bounds straddle target and coverage below gate",
    )


def _bounds(n: str, clean: str, under: str) -> dict[str, Column]:
    return {
        "coverage_": share(clean, n),
        "rate_": share(under, clean),
        "low_": share(under, n),
        "high_": share(F.col(under) + F.col(n) - F.col(clean), n),
    }


def _named(rows: DataFrame, licensees: DataFrame) -> DataFrame:
    """rows with their licensee's brand; where licensees come by month, the brand as of the row's own month."""
    keys = [c for c in ("month", "hvfhs_license_num") if c in licensees.columns]
    return rows.join(licensees.select(*keys, "brand"), keys)


def kpi(agg: DataFrame, licensees: DataFrame, status: DataFrame, s: Standard) -> DataFrame:
    """M1 and M2: service rate, evidence coverage, bounds and verdict, for each dispatcher and published month."""
    w = agg.filter((F.col("level") == "dispatcher") & F.col("wav_requested"))
    w = _named(w, licensees).join(status.select("month", "metric_status"), "month")
    w = w.withColumns(_bounds("n_records", "n_clean", "n_clean_under"))
    c, r, low, high = (F.col(x) for x in ("coverage_", "rate_", "low_", "high_"))
    return w.select(
        "month",
        "hvfhs_license_num",
        "brand",
        F.col("n_records").alias("wav_requests"),
        F.col("n_clean").alias("wav_requests_clean"),
        (F.col("n_records") - F.col("n_clean")).alias("wav_requests_quarantined"),
        c.alias("m2_evidence_coverage"),
        (c >= s.gate).alias("measurable"),
        share("n_naive_under", "n_records").alias("naive_rate_unvalidated"),
        r.alias("clean_record_rate"),
        when_known(c >= s.gate, r).alias("m1_service_rate_10min"),
        low.alias("m1_bound_low"),
        high.alias("m1_bound_high"),
        verdict(low, high, c, r, s).alias("kpi_status"),
        basis(low, high, c, s).alias("verdict_basis"),
        "metric_status",
    )


def year_to_date(agg: DataFrame, licensees: DataFrame, status: DataFrame, s: Standard) -> DataFrame:
    """The same verdict on counts added over a year's published months, under the brand of the last of them."""
    w = agg.filter((F.col("level") == "dispatcher") & F.col("wav_requested"))
    w = _named(w, licensees).join(status.select("month", "metric_status"), "month")
    y = w.groupBy(F.substring("month", 1, 4).alias("year"), "hvfhs_license_num").agg(
        F.max_by("brand", "month").alias("brand"),
        F.array_join(F.array_sort(F.collect_list("month")), " ").alias("months_included"),
        F.count("*").alias("n_months"),
        F.sum("n_records").alias("wav_requests"),
        F.sum("n_clean").alias("n_clean"),
        F.sum("n_clean_under").alias("n_clean_under"),
        F.bool_and(F.col("metric_status") == "FINAL").alias("all_months_final"),
    )
    y = y.withColumns(_bounds("wav_requests", "n_clean", "n_clean_under"))
    c, r, low, high = (F.col(x) for x in ("coverage_", "rate_", "low_", "high_"))
    return y.select(
        "year", "hvfhs_license_num", "brand", "months_included", "n_months", "wav_requests",
        c.alias("m2_evidence_coverage"),
        when_known(c >= s.gate, r).alias("m1_service_rate_10min"),
        low.alias("m1_bound_low"),
        high.alias("m1_bound_high"),
        verdict(low, high, c, r, s).alias("kpi_status"),
        "all_months_final",
    )


def _both_sides(agg: DataFrame, measures: list[str]) -> DataFrame:
    """One row for each month and dispatcher that has both sides: w_<measure> and n_<measure> in one aggregation."""
    top = agg.filter(F.col("level") == "dispatcher")
    side = {"w": F.col("wav_requested"), "n": ~F.col("wav_requested")}
    cols = [F.max(F.when(on, F.col(m))).alias(f"{k}_{m}") for k, on in side.items() for m in measures]
    present = [F.count_if(on).alias(f"{k}_rows") for k, on in side.items()]
    return top.groupBy("month", "hvfhs_license_num").agg(*cols, *present).filter("w_rows > 0 and n_rows > 0")


def _of(k: DataFrame, sides: DataFrame) -> DataFrame:
    return k.select("month", "hvfhs_license_num", "brand", "kpi_status", "measurable").join(sides, ["month", "hvfhs_license_num"])


def response_gap(agg: DataFrame, k: DataFrame) -> DataFrame:
    """M3: response quantiles of both sides in minutes; the accessible side only where it is measurable."""
    rows = _of(k, _both_sides(agg, ["response_p50_s", "response_p90_s", "n_clean", "n_records", "n_clean_under"]))
    seen = F.col("measurable")
    return rows.select(
        "month", "hvfhs_license_num", "brand", "kpi_status",
        when_known(seen, F.col("w_response_p50_s") / 60).alias("wav_response_p50_min"),
        (F.col("n_response_p50_s") / 60).alias("nonwav_response_p50_min"),
        when_known(seen, F.col("w_response_p90_s") / 60).alias("wav_response_p90_min"),
        (F.col("n_response_p90_s") / 60).alias("nonwav_response_p90_min"),
        when_known(seen, (F.col("w_response_p90_s") - F.col("n_response_p90_s")) / 60).alias("m3_p90_gap_min"),
        share("n_n_clean", "n_n_records").alias("nonwav_evidence_coverage"),
        share("n_n_clean_under", "n_n_clean").alias("nonwav_service_rate_10min"),
    )


def stage_decomposition(agg: DataFrame, k: DataFrame) -> DataFrame:
    """M4: the extra mean wait, parted exactly into before and after the arrival."""
    rows = _of(k, _both_sides(agg, ["wait_mean_s", "response_mean_s", "curbside_mean_s", "curbside_p50_s", "wait_p50_s"]))
    seen = F.col("measurable")
    extra = lambda m: F.col(f"w_{m}") - F.col(f"n_{m}")
    return rows.select(
        "month", "hvfhs_license_num", "brand", "kpi_status",
        when_known(seen, F.col("w_wait_mean_s") / 60).alias("wav_wait_mean_min"),
        (F.col("n_wait_mean_s") / 60).alias("nonwav_wait_mean_min"),
        when_known(seen, extra("wait_mean_s") / 60).alias("extra_wait_min"),
        when_known(seen, extra("response_mean_s") / 60).alias("extra_response_min"),
        when_known(seen, extra("curbside_mean_s") / 60).alias("extra_curbside_min"),
        when_known(seen, share(extra("curbside_mean_s"), extra("wait_mean_s"))).alias("m4_curbside_share_of_extra_wait"),
        when_known(seen, F.col("w_curbside_p50_s") / 60).alias("wav_curbside_p50_min"),
        (F.col("n_curbside_p50_s") / 60).alias("nonwav_curbside_p50_min"),
        when_known(seen, F.col("w_wait_p50_s") / 60).alias("wav_wait_p50_min"),
        (F.col("n_wait_p50_s") / 60).alias("nonwav_wait_p50_min"),
    )


def cells(agg: DataFrame, k: DataFrame, s: Standard) -> DataFrame:
    """M5: borough x band cells of measurable dispatchers; below target only if the whole Wilson interval is."""
    keys = ["month", "hvfhs_license_num", "pu_borough", "hour_band"]
    at = agg.filter(F.col("level") == "cell")
    c = at.filter(F.col("wav_requested") & (F.col("n_clean") > 0) & F.col("pu_borough").isin(*s.boroughs))
    other = at.filter(~F.col("wav_requested")).select(*keys, share("n_clean_under", "n_clean").alias("nonwav_service_rate_10min"))
    shown = k.filter("measurable").select("month", "hvfhs_license_num", "brand")
    rows = c.join(shown, ["month", "hvfhs_license_num"]).join(other, keys, "left").withColumn("p", share("n_clean_under", "n_clean"))
    low, high = wilson(F.col("p"), F.col("n_clean"))
    judged = F.col("n_clean") >= s.min_cell
    return rows.select(
        "month", "hvfhs_license_num", "brand", "pu_borough", "hour_band",
        F.col("n_clean").alias("wav_requests_clean"),
        F.col("p").alias("wav_service_rate_10min"),
        low.alias("wilson_low"),
        high.alias("wilson_high"),
        (F.col("n_clean") - F.col("n_clean_under")).alias("wav_late_arrivals"),
        (F.col("response_p90_s") / 60).alias("wav_response_p90_min"),
        "nonwav_service_rate_10min",
        judged.alias("judged"),
        (judged & (F.col("p") < s.target)).alias("below_target"),
        (judged & (high < s.target)).alias("significantly_below"),
    )


def cells_summary(cell: DataFrame) -> DataFrame:
    """M5 by dispatcher: how much demand and how many late arrivals lie in cells that are below target."""
    where = lambda on, c: F.sum(F.when(F.col(on), F.col(c)))
    none = lambda x: F.coalesce(x, F.lit(0))
    return cell.groupBy("month", "hvfhs_license_num", "brand").agg(
        F.count_if("judged").alias("cells_judged"),
        F.count_if("significantly_below").alias("cells_significantly_below"),
        F.count_if("below_target").alias("cells_below_point_estimate"),
        where("judged", "wav_requests_clean").alias("requests_in_judged_cells"),
        share(none(where("significantly_below", "wav_requests_clean")), where("judged", "wav_requests_clean")).alias("m5_share_of_demand_in_below_target_cells"),
        share(none(where("significantly_below", "wav_late_arrivals")), where("judged", "wav_late_arrivals")).alias("share_of_late_arrivals_in_those_cells"),
        share(none(where("below_target", "wav_requests_clean")), where("judged", "wav_requests_clean")).alias("share_of_demand_below_point_estimate"),
        none(F.sum(F.when(~F.col("judged"), F.col("wav_requests_clean")))).alias("requests_in_low_volume_cells"),
    )


def negative_signature(neg: DataFrame, licensees: DataFrame, status: DataFrame) -> DataFrame:
    """Whether impossible responses look like pre-booked rides: whole-minute requests far above the chance rate."""
    rows = _named(neg, licensees).join(status.select("month"), "month")
    bad, good = share("n_negative_whole_minute", "n_negative"), share("n_valid_whole_minute", "n_valid")
    label = first_match(
        (F.col("n_negative") == 0, "none"),
        (good >= 0.10, "inconclusive: whole-minute requests are common in valid rows too"),
        (bad >= 0.90, "pre-booked-ride signature (request = booked time; driver arrived early)"),
        (bad <= 2 * good, "no pre-booking signature: cause unknown"),
        otherwise="mixed",
    )
    return rows.select(
        "month", "hvfhs_license_num", "brand", "wav_requested", "n_negative",
        share("n_negative", F.col("n_negative") + F.col("n_valid")).alias("negative_share"),
        bad.alias("negative_whole_minute_share"),
        share("n_negative_5min_mark", "n_negative").alias("negative_5min_mark_share"),
        good.alias("valid_whole_minute_share"),
        label.alias("signature"),
    )


def segment_profile(raw: DataFrame, agg: DataFrame, licensees: DataFrame, status: DataFrame) -> DataFrame:
    """Raw against clean distributions, and where arrival equals pickup."""
    keys = ["month", "hvfhs_license_num", "wav_requested"]
    clean = agg.filter(F.col("level") == "dispatcher").select(*keys, "response_p50_s", "response_p90_s")
    rows = _named(raw, licensees).join(status.select("month"), "month").join(clean, keys, "left")
    return rows.select(
        "month", "hvfhs_license_num", "brand", "wav_requested", "n_records", "n_dispatching_bases",
        share("n_originating_base_present", "n_records").alias("originating_base_present_share"),
        share("n_onscene_eq_pickup", "n_records").alias("onscene_eq_pickup_share"),
        share("n_onscene_eq_pickup_airport", "n_airport_pickups").alias("onscene_eq_pickup_share_airports"),
        share(F.col("n_onscene_eq_pickup") - F.col("n_onscene_eq_pickup_airport"), F.col("n_records") - F.col("n_airport_pickups")).alias("onscene_eq_pickup_share_elsewhere"),
        *[(F.col(f"raw_response_{q}_s") / 60).alias(f"raw_response_{q}_min") for q in ("p01", "p50", "p99")],
        *[(F.col(f"response_{q}_s") / 60).alias(f"clean_response_{q}_min") for q in ("p50", "p90")],
    )
