"""From raw trips to checked rows: typed projection, durations, dimensions, copies, rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import half_open_band, seconds_between
from plumbline.operators import rules
from plumbline.operators.copies import flagged
from plumbline.settings import Month, Settings

#: Names of the raw columns that are renamed; the others keep theirs.
RENAMED = {"PULocationID": "pu_location_id", "DOLocationID": "do_location_id"}
STAGED = ("hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id", "wav_request_flag", "wav_match_flag")


def project(raw: DataFrame, month: str) -> DataFrame:
    """Rename, keep what is needed, and add the four durations in whole seconds."""
    raw = raw.withColumnsRenamed(RENAMED)
    return raw.select(
        F.lit(month).alias("month"),
        "source_row_id",
        *STAGED,
        *[c for c in ("is_duplicate_copy",) if c in raw.columns],
        seconds_between("request_datetime", "on_scene_datetime").alias("response_s"),
        seconds_between("on_scene_datetime", "pickup_datetime").alias("curbside_s"),
        seconds_between("request_datetime", "pickup_datetime").alias("wait_s"),
        seconds_between("pickup_datetime", "dropoff_datetime").alias("ride_s"),
    )


def attach(staged: DataFrame, zones: DataFrame, licensees: DataFrame, bands: Sequence[tuple]) -> DataFrame:
    """Left joins to the dimensions: no row is lost or multiplied, and whether it matched is a column.

    zones and licensees have unique keys and a few hundred rows; Spark broadcasts them while they are small.
    """
    z = zones.select(F.col("location_id").alias("z_id"), F.col("borough").alias("pu_borough"), F.col("service_zone").alias("pu_service_zone"))
    lic = licensees.select(F.col("hvfhs_license_num").alias("l_id"))
    joined = staged.join(z, F.col("pu_location_id") == F.col("z_id"), "left").join(lic, F.col("hvfhs_license_num") == F.col("l_id"), "left")
    return joined.select(
        *staged.columns,
        F.col("z_id").isNotNull().alias("pu_zone_found"),
        "pu_borough",
        "pu_service_zone",
        F.col("l_id").isNotNull().alias("licensee_found"),
        half_open_band(F.hour(F.col("request_datetime")), bands).alias("hour_band"),
    )


def check(raw: DataFrame, zones: DataFrame, licensees: DataFrame, month: Month, settings: Settings, keep: str | None = None) -> DataFrame:
    """Raw trips with source_row_id -> every row with its rule flags. Copies are judged over all raw columns.

    keep: a folder for the prints of repeated rows, which spares the rows a shuffle.
    """
    marked = flagged(raw, "source_row_id", name="is_duplicate_copy", keep=keep)
    joined = attach(project(marked, str(month)), zones, licensees, settings["kpi.hour_bands"])
    params = rules.Params(month.start, month.after, int(settings["validation.long_response_warn_seconds"]), tuple(settings["kpi.boroughs"]))
    return rules.apply(joined, params)
