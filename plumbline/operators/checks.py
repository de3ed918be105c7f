"""Can a month's file be trusted at all: contract, completeness, thresholds, and comparison with control totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import first_match
from plumbline.operators.rules import ANY_ERROR
from plumbline.settings import Month
from plumbline.sources.tables import parameter_rows


@dataclass
class Check:
    """The outcome of one check. FATAL ones stop the month when they FAIL."""

    check_id: str
    name: str
    severity: str
    status: str
    observed: str = ""
    expected: str = ""
    detail: str = ""

    def row(self) -> dict[str, str]:
        return asdict(self)


@dataclass
class Comparison:
    """A file count against a control total."""

    month: str
    control_source: str
    scope: str
    file_trips: int | None
    control_trips: int | None
    diff: int | None
    diff_pct: float | None
    status: str


#: (id, what it tests, severity, why, what happens): every check that a run can record.
CHECKS: tuple[tuple[str, str, str, str, str], ...] = (
    ("SRC01", "The source can be had", "FATAL", "Nothing can be said of what isn't there.", "The month stops; a later run may pass"),
    ("SRC02", "Preserved copies are as their manifests say", "FATAL", "Altered inputs can't be reproduced.", "The month stops"),
    ("ZON01", "The zone table has the columns and types of its contract", "FATAL", "Places are told by these columns.", "The run stops"),
    ("ZON02", "Zone numbers are unique", "FATAL", "A repeated key would multiply trips.", "The run stops"),
    ("FIL01", "The trip file has the columns and types of its contract", "FATAL", "A retyped time would spoil every duration.", "The month stops; further columns are noted"),
    ("FIL02", "The rule scan read as many rows as the footers declare", "FATAL", "A partial read would undercount.", "The month stops"),
    ("FIL03", "Every day of the month has pickups", "FATAL", "A missing day means a cut or wrong file.", "The month stops"),
    ("FIL04", "No day is far below the median day", "WARN", "A partial extract, or the weather.", "Reported"),
    ("FIL05", "Few pickups are outside the month", "FATAL", "More means the wrong file.", "The month stops"),
    ("FIL06", "Few rows fail an ERROR rule", "FATAL", "Rows are quarantined one by one; this stops a broken file.", "The month stops"),
    ("FIL07", "No licensee's day is far below its own median", "WARN", "Shows where a shortfall lies.", "Reported"),
    ("FIL08", "Every licensee of the file has pickups on every day", "WARN", "A day without rows can't be below a median.", "Reported"),
    ("CTL01", "The control data has one row for each base", "WARN", "A repeated row would inflate the total.", "Reported"),
    ("REC01", "Trips by licensee equal the primary control", "FATAL", "Independent proof at licensee grain.", "The month stops unless allowed"),
    ("REC02", "All trips equal the fallback control", "FATAL", "Control while the primary one is unpublished.", "The month stops unless allowed"),
)

TRIPS = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("hvfhs_license_num", T.StringType()), ("dispatching_base_num", T.StringType()), ("originating_base_num", T.StringType()),
        ("request_datetime", T.TimestampNTZType()), ("on_scene_datetime", T.TimestampNTZType()), ("pickup_datetime", T.TimestampNTZType()), ("dropoff_datetime", T.TimestampNTZType()),
        ("PULocationID", T.IntegerType()), ("DOLocationID", T.IntegerType()), ("wav_request_flag", T.StringType()), ("wav_match_flag", T.StringType()),
    )]
)
ZONES = T.StructType([T.StructField(n, t) for n, t in (("LocationID", T.LongType()), ("Borough", T.StringType()), ("Zone", T.StringType()), ("service_zone", T.StringType()))])


def schema_drift(actual: T.StructType, contract: T.StructType) -> tuple[list[str], list[str], list[str]]:
    """(missing, changed, extra) columns against a contract."""
    have = {f.name: f.dataType for f in actual}
    missing = [f.name for f in contract if f.name not in have]
    changed = [f"{f.name}: {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in contract if f.name in have and have[f.name] != f.dataType]
    return missing, changed, sorted(set(have) - set(contract.names))


def unique_numbers(rows: DataFrame, number: str, source: str) -> DataFrame:
    """(source, n_rows, n_numbers, ok): whether a number is a key."""
    n, ids = F.count("*"), F.count_distinct(number)
    return rows.agg(F.lit(source).alias("source"), n.alias("n_rows"), ids.alias("n_numbers"), ((n == ids) & (n > 0)).alias("ok"))


def in_month(rows: DataFrame, column: str, month: Month) -> DataFrame:
    """Rows whose time lies in the half-open month, as literals that a scan can push down."""
    t = F.col(column)
    return rows.filter((t >= F.lit(month.start).cast("timestamp_ntz")) & (t < F.lit(month.after).cast("timestamp_ntz")))


def daily_volume(raw: DataFrame, month: Month, by_licensee: bool = False) -> DataFrame:
    """Trips by pickup day of the month, and by licensee if asked."""
    keys = [F.col("hvfhs_license_num")] * by_licensee + [F.dayofmonth("pickup_datetime").cast("long").alias("day")]
    return in_month(raw, "pickup_datetime", month).groupBy(*keys).agg(F.count("*").alias("trips"))


def day_coverage(daily: DataFrame, month: Month, floor: float) -> DataFrame:
    """(day, trips, median_trips, missing, low) for every day of the calendar."""
    spark = daily.sparkSession
    calendar = spark.range(1, month.days + 1).withColumnRenamed("id", "day")
    median = daily.agg(F.median("trips").alias("median_trips"))
    joined = calendar.join(daily, "day", "left").crossJoin(F.broadcast(median))  # one row
    low = F.coalesce(F.col("trips") < floor * F.col("median_trips"), F.lit(False))
    return joined.select("day", F.coalesce("trips", F.lit(0)).cast("long").alias("trips"), "median_trips", F.col("trips").isNull().alias("missing"), low.alias("low"))


def licensee_days(daily: DataFrame, floor: float) -> DataFrame:
    """(hvfhs_license_num, day, trips, median_trips, low) for the days that exist."""
    median = daily.groupBy("hvfhs_license_num").agg(F.median("trips").alias("median_trips"))
    rows = daily.join(median, "hvfhs_license_num")
    return rows.select("hvfhs_license_num", "day", "trips", "median_trips", (F.col("trips") < floor * F.col("median_trips")).alias("low"))


def licensee_day_gaps(daily: DataFrame, licensees: DataFrame, month: Month) -> DataFrame:
    """(hvfhs_license_num, day) without any trip."""
    days = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(month.days).cast("long"))).alias("day")
    return licensees.select("hvfhs_license_num", days).join(daily, ["hvfhs_license_num", "day"], "left_anti")


def scan_totals(rule_counts: DataFrame) -> DataFrame:
    """(scanned, out_of_month, error_rows, out_of_month_pct, error_pct) from rule counts."""
    of = lambda rule, c: F.coalesce(F.sum(F.when(F.col("rule_id") == rule, F.col(c))), F.lit(0)).cast("long")
    t = rule_counts.agg(of(ANY_ERROR, "n_checked").alias("scanned"), of("TMP01", "n_failed").alias("out_of_month"), of(ANY_ERROR, "n_failed").alias("error_rows"))
    pct = lambda c: F.try_divide(100.0 * F.col(c), F.col("scanned").cast("double"))
    return t.select("*", pct("out_of_month").alias("out_of_month_pct"), pct("error_rows").alias("error_pct"))


def quarantine_summary(fact: DataFrame) -> DataFrame:
    """Quarantined rows by licensee and reasons."""
    return fact.filter("NOT is_clean").groupBy("hvfhs_license_num", "failed_rules").agg(
        F.count("*").alias("n_rows"), F.min("response_s").alias("min_response_s"), F.max("response_s").alias("max_response_s"),
        F.count_distinct("dispatching_base_num").alias("n_bases"), F.min("dispatching_base_num").alias("a_base"),
    )


def footer_rows(spark: SparkSession, path: str) -> DataFrame:
    """(footer_rows): the count as the Parquet footers have it; with aggregate pushdown no data page is read."""
    keys = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = spark.read.parquet(path).agg(F.count("*").alias("footer_rows")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return parameter_rows(spark, [(n,)], "footer_rows long")


def footer_against_scan(spark: SparkSession, path: str) -> DataFrame:
    """(footer_rows, scanned_rows, whole): the scan reads every column, so it has to open every row group."""
    rows = spark.read.parquet(path)
    scanned = rows.select(F.xxhash64(*rows.columns).alias("h")).agg(F.count("h").alias("scanned_rows"))
    both = footer_rows(spark, path).crossJoin(scanned)  # one row each
    return both.select("footer_rows", "scanned_rows", (F.col("footer_rows") == F.col("scanned_rows")).alias("whole"))


def compare(file_trips: Column, control_trips: Column, tolerance_pct: float, missing: str) -> dict[str, Column]:
    """diff, diff_pct and status: within the tolerance, bounds included; a control of zero never matches."""
    diff = file_trips - control_trips
    pct = F.try_divide(100.0 * diff, control_trips.cast("double"))
    status = first_match((control_trips.isNull(), missing), (F.coalesce(F.abs(pct) <= tolerance_pct, F.lit(False)), "MATCH"), otherwise="MISMATCH")
    return {"diff": diff, "diff_pct": pct, "status": status}


def compare_controls(counted: DataFrame, licensees: DataFrame, control: DataFrame, tolerance_pct: float, missing: str) -> DataFrame:
    """Licensees that have a control key and are in the file, against the control totals."""
    control = control.groupBy("control_key").agg(F.sum("control_trips").cast("long").alias("control_trips"))
    rows = licensees.filter("control_key is not null").join(counted, "hvfhs_license_num").join(control, "control_key", "left")
    return rows.select("hvfhs_license_num", "file_trips", "control_trips").withColumns(compare(F.col("file_trips"), F.col("control_trips"), tolerance_pct, missing))


def status_of(primary: Column, fallback: Column, allow: Column) -> Column:
    """What comparisons add up to: array of primary statuses, the fallback's status, whether mismatches are allowed."""
    bad = F.array_contains(primary, "MISMATCH") | (fallback == "MISMATCH")
    whole = (F.size(primary) > 0) & F.forall(primary, lambda s: s == "MATCH")
    return first_match((bad & ~allow, "REFUSED"), (bad, "UNRECONCILED"), (whole, "RECONCILED"), (fallback == "MATCH", "RECONCILED_FALLBACK"), otherwise="UNRECONCILED")


def repeated(values: Sequence[str | None]) -> list[str]:
    """Values that occur more than once, sorted."""
    seen: Mapping[str, int] = {}
    for v in values:
        seen[v or ""] = seen.get(v or "", 0) + 1
    return sorted(k for k, n in seen.items() if n > 1)
