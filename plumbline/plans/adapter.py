"""A trip-shaped month made from the events table, so that the whole engine runs over the test tables.

Every field is a deterministic function of an event, chosen so that each rule fires and each verdict branch is near.
SQL holds the same definitions for the oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import metrics, rules, segments, staging
from plumbline.session import pin
from plumbline.settings import Month, Settings, load
from plumbline.sources.tables import parameter_rows

MONTH = Month(2024, 1)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
#: Cells of the test month hold a tenth of what real ones do.
MIN_CELL = 10
LICENSEES = [("L1", "Click", "K1"), ("L2", "View", "K2"), ("L3", "Purchase", "K3"), ("L4", "Signup", None)]


def settings() -> Settings:
    return load().override({"kpi.boroughs": list(REGIONS), "kpi.min_cell_requests": MIN_CELL})


def standard() -> metrics.Standard:
    return metrics.Standard(min_cell=MIN_CELL, boroughs=REGIONS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with source_row_id, some of them twice."""
    e = read(spark, sf_dir, "events").withColumns(
        {
            "lic": F.expr("CASE event_type WHEN 'click' THEN 'L1' WHEN 'view' THEN 'L2' WHEN 'purchase' THEN 'L3' WHEN 'signup' THEN 'L4' ELSE 'L9' END"),
            "flag": F.expr("CASE WHEN user_id % 3 = 0 THEN 'Y' WHEN user_id % 50 = 1 THEN 'X' ELSE 'N' END"),
        }
    )
    e = e.withColumn("off", F.expr("CASE WHEN event_id % 401 = 19 THEN 4000 WHEN lic = 'L1' THEN floor(value * 4) - 2 WHEN lic = 'L2' THEN floor(value * 5) - 20 WHEN lic = 'L3' THEN floor(value * 4) - 150 ELSE floor(value * 9) - 5 END"))
    e = e.withColumn("req", F.expr("CASE WHEN lic = 'L2' AND off < 0 THEN CAST(date_trunc('MINUTE', ts) AS TIMESTAMP_NTZ) ELSE ts END"))
    e = e.withColumn("ons0", F.expr("CAST(date_trunc('SECOND', req) AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, off)"))
    e = e.withColumn("pu", F.expr("""CASE WHEN event_id % 503 = 7 THEN ons0 + INTERVAL '40' DAY WHEN event_id % 173 = 9 THEN ons0 - INTERVAL '120' SECOND
        WHEN event_id % 37 = 11 THEN ons0 WHEN flag = 'Y' THEN ons0 + INTERVAL '160' SECOND ELSE ons0 + INTERVAL '45' SECOND END"""))
    one = e.select(
        F.col("event_id").alias("source_row_id"),
        F.col("lic").alias("hvfhs_license_num"),
        F.expr("concat('B', user_id % 7)").alias("dispatching_base_num"),
        F.expr("CASE WHEN event_id % 5 <> 0 THEN concat('B', user_id % 5) END").alias("originating_base_num"),
        F.col("req").alias("request_datetime"),
        F.expr("CASE WHEN event_id % 211 <> 5 THEN ons0 END").alias("on_scene_datetime"),
        F.col("pu").alias("pickup_datetime"),
        F.expr("CASE WHEN event_id % 157 = 13 THEN pu ELSE pu + INTERVAL '900' SECOND END").alias("dropoff_datetime"),
        F.expr("CAST(user_id % 26 AS INT)").alias("PULocationID"),
        F.expr("CAST(event_id % 25 AS INT)").alias("DOLocationID"),
        F.col("flag").alias("wav_request_flag"),
        F.expr("CASE WHEN flag = 'Y' AND event_id % 101 <> 3 THEN 'Y' ELSE 'N' END").alias("wav_match_flag"),
        F.col("value").alias("trip_miles"),
    )
    again = one.filter("source_row_id % 997 = 17").withColumn("source_row_id", F.col("source_row_id") + 10_000_000)
    return one.unionByName(again)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("location_id"),
        F.when(F.col("n_nationkey") == 24, "Unknown").otherwise(F.col("r_name")).alias("borough"),
        F.col("n_name").alias("zone"),
        F.when(F.col("n_nationkey") % 6 == 0, "Airports").otherwise("Zone").alias("service_zone"),
    )


def licensees(spark: SparkSession) -> DataFrame:
    return parameter_rows(spark, LICENSEES, "hvfhs_license_num string, brand string, control_key string")


def status(spark: SparkSession) -> DataFrame:
    return parameter_rows(spark, [(str(MONTH), "FINAL")], "month string, metric_status string")


def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip of the month with its rule flags."""
    return staging.check(raw_trips(spark, sf_dir), zones(spark, sf_dir), licensees(spark), MONTH, settings())


def aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.aggregates(final(spark, sf_dir), 600)


def place(spark: SparkSession, name: str) -> str:
    """A new folder that all machines see: only where everything runs on one may it be below the warehouse."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/plumbline-sources/{name}-{uuid.uuid4().hex}"


def kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """rows written to the shared folder once, for queries that read them several times."""
    at = place(spark, name)
    rows.write.parquet(at)
    return spark.read.schema(rows.schema).parquet(at)


def table_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregates as a table, for metrics that read them several times; a run over months reads its warehouse instead."""
    return kept(spark, aggregates(spark, sf_dir), "aggregates")


def kpi(spark: SparkSession, agg: DataFrame) -> DataFrame:
    return metrics.kpi(agg, licensees(spark), status(spark), standard())


# --- the same in DuckDB's SQL ----------------------------------------------------------------------------------------

_ALL = "hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, wav_request_flag, wav_match_flag, trip_miles"

def share(part: str, whole: str) -> str:
    """SQL: a quotient in doubles, null where there is nothing to divide by."""
    return f"CAST({part} AS DOUBLE) / nullif({whole}, 0)"


#: For n records, c clean ones and u of these in time, the verdicts in the order in which they are tried: a
#: test, the verdict, and what it rests on. Every quarantined record is at worst late and at best in time: those are the
#: bounds. Between them, the clean records speak if they are nine in ten.
VERDICTS = (
    (f"{share('u', 'n')} >= 0.9", "MEETS", "proven: holds even if every quarantined record failed"),
    (f"{share('u + n - c', 'n')} < 0.9", "BELOW", "proven: holds even if every quarantined record passed"),
    (f"{share('c', 'n')} >= 0.9 AND {share('u', 'c')} >= 0.9", "MEETS (estimate)", "estimate: bounds straddle target; quarantined records treated as out of scope"),
    (f"{share('c', 'n')} >= 0.9", "BELOW (estimate)", "estimate: bounds straddle target; quarantined records treated as out of scope"),
    ("true", "NOT MEASURABLE", "withheld: bounds straddle target and coverage below gate"),
)
VERDICT = f"CASE {' '.join(f'WHEN {test} THEN {name!r}' for test, name, _ in VERDICTS)} END"
BASIS = f"CASE {' '.join(f'WHEN {test} THEN {basis!r}' for test, _, basis in VERDICTS)} END"


_CTES = {
    "raw": f"""
e1 AS (SELECT *, CASE event_type WHEN 'click' THEN 'L1' WHEN 'view' THEN 'L2' WHEN 'purchase' THEN 'L3' WHEN 'signup' THEN 'L4' ELSE 'L9' END AS lic,
  CASE WHEN user_id % 3 = 0 THEN 'Y' WHEN user_id % 50 = 1 THEN 'X' ELSE 'N' END AS flag FROM events),
e2 AS (SELECT *, CAST(CASE WHEN event_id % 401 = 19 THEN 4000 WHEN lic = 'L1' THEN floor(value * 4) - 2 WHEN lic = 'L2' THEN floor(value * 5) - 20
  WHEN lic = 'L3' THEN floor(value * 4) - 150 ELSE floor(value * 9) - 5 END AS BIGINT) AS off FROM e1),
e3 AS (SELECT *, CASE WHEN lic = 'L2' AND off < 0 THEN CAST(date_trunc('minute', ts) AS TIMESTAMP) ELSE ts END AS req FROM e2),
e4 AS (SELECT *, CAST(date_trunc('second', req) AS TIMESTAMP) + to_seconds(off) AS ons0 FROM e3),
e5 AS (SELECT *, CASE WHEN event_id % 503 = 7 THEN ons0 + INTERVAL 40 DAY WHEN event_id % 173 = 9 THEN ons0 - INTERVAL 120 SECOND
  WHEN event_id % 37 = 11 THEN ons0 WHEN flag = 'Y' THEN ons0 + INTERVAL 160 SECOND ELSE ons0 + INTERVAL 45 SECOND END AS pu FROM e4),
one AS (SELECT event_id AS source_row_id, lic AS hvfhs_license_num, 'B' || (user_id % 7) AS dispatching_base_num,
  CASE WHEN event_id % 5 <> 0 THEN 'B' || (user_id % 5) END AS originating_base_num, req AS request_datetime,
  CASE WHEN event_id % 211 <> 5 THEN ons0 END AS on_scene_datetime, pu AS pickup_datetime,
  CASE WHEN event_id % 157 = 13 THEN pu ELSE pu + INTERVAL 900 SECOND END AS dropoff_datetime,
  CAST(user_id % 26 AS INTEGER) AS PULocationID, CAST(event_id % 25 AS INTEGER) AS DOLocationID, flag AS wav_request_flag,
  CASE WHEN flag = 'Y' AND event_id % 101 <> 3 THEN 'Y' ELSE 'N' END AS wav_match_flag, value AS trip_miles FROM e5),
raw AS (SELECT * FROM one UNION ALL SELECT source_row_id + 10000000, {_ALL} FROM one WHERE source_row_id % 997 = 17),
zones AS (SELECT n_nationkey AS location_id, CASE WHEN n_nationkey = 24 THEN 'Unknown' ELSE r_name END AS borough, n_name AS zone,
  CASE WHEN n_nationkey % 6 = 0 THEN 'Airports' ELSE 'Zone' END AS service_zone FROM nation JOIN region ON n_regionkey = r_regionkey),
licensees AS (SELECT * FROM (VALUES ('L1', 'Click', 'K1'), ('L2', 'View', 'K2'), ('L3', 'Purchase', 'K3'), ('L4', 'Signup', NULL)) t(hvfhs_license_num, brand, control_key)),
month_status AS (SELECT '2024-01' AS month, 'FINAL' AS metric_status)""",
    "joined": f"""
joined AS (SELECT '2024-01' AS month, r.*, r.PULocationID AS pu_location_id, r.DOLocationID AS do_location_id,
  date_diff('second', request_datetime, on_scene_datetime) AS response_s, date_diff('second', on_scene_datetime, pickup_datetime) AS curbside_s,
  date_diff('second', request_datetime, pickup_datetime) AS wait_s, date_diff('second', pickup_datetime, dropoff_datetime) AS ride_s,
  z.location_id IS NOT NULL AS pu_zone_found, z.borough AS pu_borough, z.service_zone AS pu_service_zone, l.brand IS NOT NULL AS licensee_found,
  row_number() OVER (PARTITION BY {", ".join("r." + c.strip() for c in _ALL.split(","))} ORDER BY r.source_row_id) > 1 AS is_duplicate_copy,
  CASE WHEN hour(request_datetime) < 6 THEN '00-06 overnight' WHEN hour(request_datetime) < 10 THEN '06-10 AM peak' WHEN hour(request_datetime) < 16 THEN '10-16 midday'
    WHEN hour(request_datetime) < 20 THEN '16-20 PM peak' WHEN hour(request_datetime) < 24 THEN '20-24 evening' END AS hour_band
  FROM raw r LEFT JOIN zones z ON z.location_id = r.PULocationID LEFT JOIN licensees l ON l.hvfhs_license_num = r.hvfhs_license_num)""",
    "final": """
checked AS (SELECT *,
  coalesce(request_datetime IS NOT NULL AND on_scene_datetime IS NOT NULL AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL, false) AS pass_SCH01,
  coalesce(wav_request_flag IN ('Y', 'N') AND wav_match_flag IN ('Y', 'N'), false) AS pass_SCH02,
  licensee_found AS pass_REF01, pu_zone_found AS pass_REF02,
  coalesce(pu_borough IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), false) AS pass_REF03,
  coalesce(pickup_datetime IS NULL OR (pickup_datetime >= TIMESTAMP '2024-01-01' AND pickup_datetime < TIMESTAMP '2024-02-01'), false) AS pass_TMP01,
  coalesce(request_datetime IS NULL OR on_scene_datetime IS NULL OR request_datetime <= on_scene_datetime, false) AS pass_TMP02,
  coalesce(on_scene_datetime IS NULL OR pickup_datetime IS NULL OR on_scene_datetime <= pickup_datetime, false) AS pass_TMP03,
  coalesce(pickup_datetime IS NULL OR dropoff_datetime IS NULL OR dropoff_datetime > pickup_datetime, false) AS pass_TMP04,
  coalesce(wav_request_flag <> 'Y' OR wav_match_flag = 'Y', false) AS pass_DOM01,
  coalesce(response_s IS NULL OR response_s <= 3600, false) AS pass_DOM02,
  coalesce(on_scene_datetime IS NULL OR pickup_datetime IS NULL OR on_scene_datetime <> pickup_datetime, false) AS pass_DOM03,
  NOT is_duplicate_copy AS pass_DOM04 FROM joined),
final AS (SELECT *, pass_SCH01 AND pass_SCH02 AND pass_REF01 AND pass_REF02 AND pass_TMP01 AND pass_TMP02 AND pass_TMP03 AND pass_TMP04 AND pass_DOM04 AS is_clean,
  concat_ws(',', """ + ", ".join(f"CASE WHEN NOT pass_{r} THEN '{r}' END" for r in ("SCH01", "SCH02", "REF01", "REF02", "TMP01", "TMP02", "TMP03", "TMP04", "DOM04")) + """) AS failed_rules,
  concat_ws(',', """ + ", ".join(f"CASE WHEN NOT pass_{r} THEN '{r}' END" for r in ("REF03", "DOM01", "DOM02", "DOM03")) + """) AS warned_rules FROM checked)""",
    "agg": """
seg AS (SELECT *, wav_request_flag = 'Y' AS wav_requested, CASE WHEN pass_REF03 THEN pu_borough ELSE 'Non-borough zone' END AS b, coalesce(hour_band, 'UNKNOWN') AS h
  FROM final WHERE licensee_found AND wav_request_flag IN ('Y', 'N')),
agg AS (SELECT month, CASE WHEN grouping(b) = 0 THEN 'cell' ELSE 'dispatcher' END AS level, hvfhs_license_num, wav_requested,
  coalesce(b, 'ALL') AS pu_borough, coalesce(h, 'ALL') AS hour_band, count(*) AS n_records, count(*) FILTER (WHERE is_clean) AS n_clean,
  count(*) FILTER (WHERE is_clean AND response_s < 600) AS n_clean_under, count(*) FILTER (WHERE response_s < 600) AS n_naive_under,
  quantile_cont(response_s, 0.5) FILTER (WHERE is_clean) AS response_p50_s, quantile_cont(response_s, 0.9) FILTER (WHERE is_clean) AS response_p90_s,
  quantile_cont(curbside_s, 0.5) FILTER (WHERE is_clean) AS curbside_p50_s, quantile_cont(wait_s, 0.5) FILTER (WHERE is_clean) AS wait_p50_s,
  avg(response_s) FILTER (WHERE is_clean) AS response_mean_s, avg(curbside_s) FILTER (WHERE is_clean) AS curbside_mean_s, avg(wait_s) FILTER (WHERE is_clean) AS wait_mean_s
  FROM seg GROUP BY GROUPING SETS ((month, hvfhs_license_num, wav_requested), (month, hvfhs_license_num, wav_requested, b, h)))""",
    "kpi": f"""
tally AS (SELECT month, hvfhs_license_num, n_records AS n, n_clean AS c, n_clean_under AS u, n_naive_under AS v FROM agg WHERE level = 'dispatcher' AND wav_requested),
kpi AS (SELECT t.month, t.hvfhs_license_num, l.brand, n AS wav_requests, c AS wav_requests_clean, n - c AS wav_requests_quarantined, {share("c", "n")} AS m2_evidence_coverage,
  {share("c", "n")} >= 0.9 AS measurable, {share("v", "n")} AS naive_rate_unvalidated, {share("u", "c")} AS clean_record_rate, if({share("c", "n")} >= 0.9, {share("u", "c")}, NULL) AS m1_service_rate_10min,
  {share("u", "n")} AS m1_bound_low, {share("u + n - c", "n")} AS m1_bound_high, {VERDICT} AS kpi_status, {BASIS} AS verdict_basis, s.metric_status
  FROM tally t, licensees l, month_status s WHERE l.hvfhs_license_num = t.hvfhs_license_num AND s.month = t.month)""",
}


def sql(upto: str, select: str) -> str:
    """The oracle's definitions up to and with `upto`, and a query over them."""
    names = list(_CTES)
    return "WITH " + ",".join(_CTES[n] for n in names[: names.index(upto) + 1]) + "\n" + select
