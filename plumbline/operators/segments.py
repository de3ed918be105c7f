"""Tables of a month: the fact, segment aggregates at two grains, and diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.rules import flag

FACT = ("month", "source_row_id", "hvfhs_license_num", "dispatching_base_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id", "pu_borough", "hour_band", "wav_match_flag", "response_s", "curbside_s", "wait_s", "ride_s", "failed_rules", "warned_rules", "is_clean")


def fact(final: DataFrame) -> DataFrame:
    """Accessible requests, clean and quarantined alike."""
    return final.filter(F.col("wav_request_flag") == "Y").select(*FACT)


def segmentable(final: DataFrame) -> DataFrame:
    """Rows of a known licensee with a usable flag."""
    known = final.filter(F.col("licensee_found") & F.col("wav_request_flag").isin("Y", "N"))
    return known.withColumn("wav_requested", F.col("wav_request_flag") == "Y")


def aggregates(final: DataFrame, threshold_s: int) -> DataFrame:
    """Counts, exact quantiles and means by dispatcher and by cell (borough x band), in one pass with grouping sets."""
    rows = segmentable(final).select(
        "month", "hvfhs_license_num", "wav_requested", "is_clean", "response_s", "curbside_s", "wait_s",
        F.when(flag("REF03"), F.col("pu_borough")).otherwise(F.lit("Non-borough zone")).alias("pu_borough"),
        F.coalesce("hour_band", F.lit("UNKNOWN")).alias("hour_band"),
    )
    keys = ["month", "hvfhs_license_num", "wav_requested", "pu_borough", "hour_band"]
    clean = F.col("is_clean")
    of_clean = lambda c: F.when(clean, F.col(c))
    under = F.col("response_s") < threshold_s
    grouped = rows.groupingSets([[F.col(k) for k in keys[:3]], [F.col(k) for k in keys]], *[F.col(k) for k in keys]).agg(
        F.when(F.grouping("pu_borough") == 0, "cell").otherwise("dispatcher").alias("level"),
        F.count("*").alias("n_records"),
        F.count_if(clean).alias("n_clean"),
        F.count_if(clean & under).alias("n_clean_under"),
        F.count_if(under).alias("n_naive_under"),
        F.percentile(of_clean("response_s"), F.lit(0.5)).alias("response_p50_s"),
        F.percentile(of_clean("response_s"), F.lit(0.9)).alias("response_p90_s"),
        F.percentile(of_clean("curbside_s"), F.lit(0.5)).alias("curbside_p50_s"),
        F.percentile(of_clean("wait_s"), F.lit(0.5)).alias("wait_p50_s"),
        F.avg(of_clean("response_s")).alias("response_mean_s"),
        F.avg(of_clean("curbside_s")).alias("curbside_mean_s"),
        F.avg(of_clean("wait_s")).alias("wait_mean_s"),
    )
    filled = [F.coalesce(k, F.lit("ALL")).alias(k) for k in ("pu_borough", "hour_band")]
    return grouped.select("month", "level", "hvfhs_license_num", "wav_requested", *filled, *[c for c in grouped.columns if c not in (*keys, "level")])


def negative_responses(final: DataFrame) -> DataFrame:
    """How many arrivals precede their request, and how often requests fall on whole minutes in bad and valid rows."""
    negative = ~flag("TMP02")
    whole = F.second("request_datetime") == 0
    fifth = whole & (F.minute("request_datetime") % 5 == 0)
    valid = flag("TMP02") & F.col("response_s").isNotNull()
    return segmentable(final).groupBy("month", "hvfhs_license_num", "wav_requested").agg(
        F.count_if(negative).alias("n_negative"),
        F.count_if(negative & whole).alias("n_negative_whole_minute"),
        F.count_if(negative & fifth).alias("n_negative_5min_mark"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(valid & whole).alias("n_valid_whole_minute"),
    )


def raw_segments(final: DataFrame) -> DataFrame:
    """Segments before any rule: bases, airports, equal times and raw quantiles."""
    airport = F.col("pu_service_zone") == "Airports"
    equal = F.col("on_scene_datetime") == F.col("pickup_datetime")
    return segmentable(final).groupBy("month", "hvfhs_license_num", "wav_requested").agg(
        F.count("*").alias("n_records"),
        F.count_distinct("dispatching_base_num").alias("n_dispatching_bases"),
        F.count("originating_base_num").alias("n_originating_base_present"),
        F.count_if(airport).alias("n_airport_pickups"),
        F.count_if(equal).alias("n_onscene_eq_pickup"),
        F.count_if(equal & airport).alias("n_onscene_eq_pickup_airport"),
        F.percentile("response_s", F.lit(0.01)).alias("raw_response_p01_s"),
        F.percentile("response_s", F.lit(0.5)).alias("raw_response_p50_s"),
        F.percentile("response_s", F.lit(0.99)).alias("raw_response_p99_s"),
    )
