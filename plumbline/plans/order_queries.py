"""The delivery investigations as queries, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import minutes_between
from plumbline.operators import orders as o
from plumbline.operators import tables as t
from plumbline.operators.quantiles import exact
from plumbline.plans import deliveries as x
from plumbline.plans.kpi_queries import query
from plumbline.plans.rounding import rounded
from plumbline.sources.tables import parameter_rows


@query(
    "late_rate_definitions",
    x.sql("""SELECT definition, CAST(late AS BIGINT) AS late, CAST(denominator AS BIGINT) AS denominator, round(100.0 * late / denominator, 1) AS late_rate_pct FROM (
    WITH c AS (SELECT count(*) FILTER (WHERE k AND delay_min > 0) AS l, count(*) FILTER (WHERE k) AS k, count(*) FILTER (WHERE k AND delay_min > 10) AS l10, count(*) FILTER (WHERE status = 'delivered') AS del,
      count(*) FILTER (WHERE status = 'delivered' AND actual_delivery_at IS NULL) AS unk, count(*) FILTER (WHERE status = 'cancelled') AS can
      FROM (SELECT *, status = 'delivered' AND actual_delivery_at IS NOT NULL AS k FROM ord)),
    h AS (SELECT count(*) FILTER (WHERE actual_delivery_at > promised_eta) AS hl, count(*) AS ha FROM stored WHERE final_status = 'delivered' AND actual_delivery_at IS NOT NULL)
    SELECT 'any delay, delivered at a known time' AS definition, l AS late, k AS denominator FROM c UNION ALL SELECT 'more than 10 minutes', l10, k FROM c
    UNION ALL SELECT 'as stored: exact spelling, repeated rows', hl, ha FROM h UNION ALL SELECT 'without cancelled orders', l, k FROM c
    UNION ALL SELECT 'unknown times all late', l + unk, del FROM c UNION ALL SELECT 'unknown times all on time', l, del FROM c UNION ALL SELECT 'cancelled orders as failures', l + can, k + can FROM c)"""),
)
def late_rate_definitions(spark: SparkSession, d: str) -> DataFrame:
    """One question, seven denominators."""
    return o.late_rates(x.orders(spark, d), x.stored(spark, d))


_COMPARE = "SELECT '{dim}' AS dimension, CAST({dim} AS VARCHAR) AS bucket, count(*) AS n_orders, round(avg(CAST(late AS INTEGER)), 6) AS late_rate, round(median(delay_min), 6) AS median_delay_min, round(median(promised_min), 6) AS median_promised_min, round(median(travel_min), 6) AS median_travel_min, round(median(prep_min), 6) AS median_prep_min FROM stages WHERE {dim} IS NOT NULL GROUP BY 2"
_DIMENSIONS = ("traffic", "weather_bucket", "distance_band", "time_of_day", "late")


@query("stage_by_dimension", x.sql(" UNION ALL ".join(_COMPARE.format(dim=n) for n in _DIMENSIONS)))
def stage_by_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Lateness and stages by traffic, weather, distance, hour and lateness itself."""
    return rounded(o.compared(o.staged(x.orders(spark, d)), _DIMENSIONS))


@query("delay_correlation", x.sql("SELECT round(corr(prep_min, delay_min), 6) AS corr_prep_min, round(corr(travel_min, delay_min), 6) AS corr_travel_min, round(corr(distance_km, delay_min), 6) AS corr_distance_km FROM stages"))
def delay_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Which stage moves with the delay."""
    return rounded(o.correlations(o.staged(x.orders(spark, d))))


@query("late_quantiles", x.sql("SELECT count(*) AS n_late, round(median(delay_min), 6) AS median_delay, round(quantile_cont(delay_min, 0.9), 6) AS p90_delay FROM oc WHERE late_flag = 1"))
def late_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Median and ninth decile of late orders."""
    late = o.outcomes(x.orders(spark, d)).filter("late_flag = 1")
    return rounded(exact(late, [], {"median_delay": ("delay_min", 0.5), "p90_delay": ("delay_min", 0.9)}, [F.count("*").alias("n_late")]))


@query(
    "chronology_checks",
    x.sql("""SELECT 'promised before created' AS check_name, count(*) FILTER (WHERE promised_eta < created_at) AS n FROM stored UNION ALL SELECT 'delivered before pickup', count(*) FILTER (WHERE actual_delivery_at < pickup_at) FROM stored
    UNION ALL SELECT 'status spelled differently', count(*) FILTER (WHERE final_status <> lower(trim(final_status))) FROM stored UNION ALL SELECT 'no restaurant or driver', count(*) FILTER (WHERE restaurant_id IS NULL OR driver_id IS NULL) FROM stored
    UNION ALL SELECT 'repeated order_id rows', count(*) - count(DISTINCT order_id) FROM stored"""),
)
def chronology_checks(spark: SparkSession, d: str) -> DataFrame:
    """Violations as one list of counts."""
    s = x.stored(spark, d)
    c = F.col
    counted = t.checks(s, {"promised before created": c("promised_eta") < c("created_at"), "delivered before pickup": c("actual_delivery_at") < c("pickup_at"), "status spelled differently": c("final_status") != F.lower(F.trim("final_status")), "no restaurant or driver": c("restaurant_id").isNull() | c("driver_id").isNull()})
    return counted.unionByName(s.agg((F.count("*") - F.count_distinct("order_id")).alias("n")).select(F.lit("repeated order_id rows").alias("check_name"), "n"))


@query("repeated_orders", x.sql("SELECT order_id, pos, traffic_bucket FROM stored QUALIFY count(*) OVER (PARTITION BY order_id) > 1"))
def repeated_orders(spark: SparkSession, d: str) -> DataFrame:
    """All rows of repeated keys."""
    from plumbline.operators.copies import members_of_repeated

    return members_of_repeated(x.stored(spark, d), ["order_id"]).select("order_id", "pos", "traffic_bucket")


@query("first_rows", x.sql("SELECT order_id, pos, traffic_bucket, status, traffic, round(delay_min, 6) AS delay_min FROM ord"))
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first stored row of each key, labels in one spelling."""
    return rounded(x.orders(spark, d).select("order_id", "pos", "traffic_bucket", "status", "traffic", "delay_min"))


_TV = """tv AS (SELECT ticket_id, replace(lower(trim(category)), ' ', '_') AS category_norm, coalesce(order_outcome, 'no order link') AS order_outcome
    FROM (SELECT DISTINCT * FROM tickets) t LEFT JOIN oc ON oc.order_id = t.order_id)"""


@query(
    "crosstab_margins",
    x.sql(f""", {_TV} SELECT CASE WHEN grouping(category_norm) = 1 THEN 'All' ELSE category_norm END AS category_norm, CASE WHEN grouping(order_outcome) = 1 THEN 'All' ELSE order_outcome END AS order_outcome, count(*) AS n
    FROM tv GROUP BY CUBE (category_norm, order_outcome)"""),
)
def crosstab_margins(spark: SparkSession, d: str) -> DataFrame:
    """Tickets by category and order outcome, with margins."""
    return t.crosstab(o.tickets_by_outcome(x.tickets(spark, d), x.orders(spark, d)), "category_norm", "order_outcome")


@query(
    "ticket_rates",
    x.sql("""SELECT order_outcome, count(*) AS n_orders, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM tickets t WHERE t.order_id = oc.order_id)) AS orders_with_ticket,
    round(avg(CAST(order_id IN (SELECT order_id FROM tickets WHERE order_id IS NOT NULL) AS INTEGER)), 6) AS ticket_rate FROM oc GROUP BY 1"""),
)
def ticket_rates(spark: SparkSession, d: str) -> DataFrame:
    """How many orders of each outcome had a ticket."""
    had = x.tickets(spark, d).filter("order_id is not null").select(F.col("order_id").alias("t_")).distinct()
    rows = o.outcomes(x.orders(spark, d)).join(had, F.col("order_id") == F.col("t_"), "left")
    return rounded(rows.groupBy("order_outcome").agg(F.count("*").alias("n_orders"), F.count("t_").alias("orders_with_ticket"), F.avg(F.col("t_").isNotNull().cast("int")).alias("ticket_rate")))


_LEVEL = """fl AS (SELECT order_id, count(*) FILTER (WHERE action_type = 'SUPPORT_OPENED') AS so, count(*) FILTER (WHERE action_type = 'CANCEL_ATTEMPTED') AS ca FROM actions GROUP BY 1),
  iv AS (SELECT order_id, count(*) AS ic, string_agg(DISTINCT intervention_type, '|' ORDER BY intervention_type) AS it FROM interventions GROUP BY 1),
  lev AS (SELECT oc.order_id, o.customer_id, o.restaurant_id, coalesce(so, 0) > 0 OR oc.order_id IN (SELECT order_id FROM tickets WHERE order_id IS NOT NULL) AS support_opened, coalesce(ca, 0) > 0 AS cancel_attempted,
    coalesce(ic, 0) AS intervention_count, coalesce(it, '') AS intervention_types, final_status_norm AS final_status, late_flag, oc.delay_min, order_outcome
    FROM oc JOIN ord o USING (order_id) LEFT JOIN fl USING (order_id) LEFT JOIN iv USING (order_id))"""
_SHOWN = "order_id, customer_id, restaurant_id, support_opened, cancel_attempted, intervention_count, intervention_types, final_status, late_flag, round(delay_min, 6) AS delay_min, order_outcome"


def _level(spark: SparkSession, d: str) -> DataFrame:
    return o.order_level(x.orders(spark, d), x.actions(spark, d), x.tickets(spark, d), x.interventions(spark, d))


@query("order_outcome_table", x.sql(f", {_LEVEL} SELECT {_SHOWN} FROM lev"))
def order_outcome_table(spark: SparkSession, d: str) -> DataFrame:
    """Touches, interventions and outcome, one row an order."""
    return rounded(_level(spark, d))


@query("frustrated_journeys", x.sql(f", {_LEVEL} SELECT {_SHOWN} FROM lev WHERE (support_opened OR cancel_attempted) AND intervention_count = 0"))
def frustrated_journeys(spark: SparkSession, d: str) -> DataFrame:
    """Journeys that nobody acted on."""
    return rounded(o.journeys(_level(spark, d)))


@query(
    "journey_rates",
    x.sql(f""", {_LEVEL}, c AS (SELECT count(*) FILTER (WHERE late_flag = 1) AS late_orders, count(*) FILTER (WHERE late_flag = 1 AND support_opened) AS late_with_support, count(*) FILTER (WHERE intervention_count > 0) AS intervened,
    count(*) FILTER (WHERE support_opened OR cancel_attempted) AS frustrated, count(*) FILTER (WHERE (support_opened OR cancel_attempted) AND intervention_count = 0) AS unattended,
    count(*) FILTER (WHERE (support_opened OR cancel_attempted) AND intervention_count = 0 AND late_flag = 1) AS unattended_late FROM lev)
    SELECT *, round(late_with_support / late_orders, 6) AS support_rate_of_late, round(unattended / frustrated, 6) AS unattended_share FROM c"""),
)
def journey_rates(spark: SparkSession, d: str) -> DataFrame:
    """Late orders with support, intervened and unattended journeys."""
    return rounded(o.journey_rates(_level(spark, d)))


@query(
    "rates_by_contact",
    x.sql(f""", {_LEVEL} SELECT support_opened, intervention_count > 0 AS intervened, count(*) AS n_orders, round(avg(late_flag), 6) AS late_rate, round(median(delay_min), 6) AS median_delay FROM lev WHERE late_flag IS NOT NULL GROUP BY 1, 2"""),
)
def rates_by_contact(spark: SparkSession, d: str) -> DataFrame:
    """Lateness by support contact and intervention."""
    rows = _level(spark, d).filter("late_flag is not null").withColumn("intervened", F.col("intervention_count") > 0)
    return rounded(rows.groupBy("support_opened", "intervened").agg(F.count("*").alias("n_orders"), F.avg("late_flag").alias("late_rate"), F.median("delay_min").alias("median_delay")))


_PHASE = """ph AS (SELECT i.*, CASE WHEN intervention_at < pickup_at THEN 'before pickup' WHEN intervention_at <= actual_delivery_at THEN 'in transit' WHEN actual_delivery_at IS NULL THEN 'no delivery time' ELSE 'after delivery' END AS phase,
  CASE WHEN status = 'delivered' AND actual_delivery_at IS NOT NULL THEN CAST(delay_min > 0 AS INTEGER) END AS late_flag FROM interventions i JOIN ord USING (order_id))"""


@query("phase_counts", x.sql(f", {_PHASE} SELECT CASE WHEN grouping(intervention_type) = 1 THEN 'All' ELSE intervention_type END AS intervention_type, CASE WHEN grouping(phase) = 1 THEN 'All' ELSE phase END AS phase, count(*) AS n FROM ph GROUP BY CUBE (intervention_type, phase)"))
def phase_counts(spark: SparkSession, d: str) -> DataFrame:
    """Interventions by type and phase, with margins."""
    return t.crosstab(o.phases(x.interventions(spark, d), x.orders(spark, d)), "intervention_type", "phase")


@query("intervention_rates", x.sql(f", {_PHASE} SELECT intervention_type, count(*) AS n, round(avg(late_flag), 6) AS late_rate, count(*) FILTER (WHERE phase = 'before pickup') AS n_preventive, round(avg(late_flag) FILTER (WHERE phase = 'before pickup'), 6) AS preventive_late_rate FROM ph WHERE late_flag IS NOT NULL GROUP BY 1"))
def intervention_rates(spark: SparkSession, d: str) -> DataFrame:
    """Late rate by intervention, all and preventive."""
    before = F.col("phase") == "before pickup"
    rows = o.phases(x.interventions(spark, d), x.orders(spark, d)).filter("late_flag is not null")
    return rounded(rows.groupBy("intervention_type").agg(F.count("*").alias("n"), F.avg("late_flag").alias("late_rate"), F.count_if(before).alias("n_preventive"), F.avg(F.when(before, F.col("late_flag"))).alias("preventive_late_rate")))


@query("top_share", x.sql(f""", {_LEVEL}, g AS (SELECT restaurant_id, CAST(sum(late_flag) AS BIGINT) AS l FROM lev WHERE late_flag IS NOT NULL AND restaurant_id IS NOT NULL GROUP BY 1),
  top AS (SELECT l FROM g ORDER BY l DESC, restaurant_id LIMIT 10) SELECT CAST(10 AS BIGINT) AS k, (SELECT count(*) FROM g) AS n_groups, CAST((SELECT sum(l) FROM top) AS BIGINT) AS top_total, CAST((SELECT sum(l) FROM g) AS BIGINT) AS total,
  round((SELECT sum(l) FROM top) / (SELECT sum(l) FROM g), 6) AS top_share"""))
def top_share(spark: SparkSession, d: str) -> DataFrame:
    """What the ten restaurants with most late orders hold of all."""
    g = _level(spark, d).filter("late_flag is not null and restaurant_id is not null").groupBy("restaurant_id").agg(F.sum("late_flag").alias("l"))
    return rounded(t.top_share(g, "l", 10, "restaurant_id"))


@query("mode_value", x.sql("SELECT intervention_type AS value, count(*) AS n FROM interventions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"))
def mode_value(spark: SparkSession, d: str) -> DataFrame:
    """The most common intervention."""
    return t.mode(x.interventions(spark, d), "intervention_type")


@query(
    "timeline_union",
    x.sql("""SELECT order_id, event_time, event_type, actor, source_system FROM (
    SELECT order_id, action_at AS event_time, 'APP_' || action_type AS event_type, 'customer:' || customer_id AS actor, 'customer_app' AS source_system FROM actions
    UNION ALL SELECT order_id, created_at, 'TICKET_' || trim(category), 'customer', 'support' FROM (SELECT DISTINCT * FROM tickets) WHERE order_id IS NOT NULL
    UNION ALL SELECT order_id, intervention_at, 'INTERVENTION_' || intervention_type, 'ops', 'interventions' FROM interventions
    UNION ALL SELECT order_id, promised_eta, 'PROMISED_ETA (planned)', 'order_platform', 'orders' FROM ord
    UNION ALL SELECT order_id, t, e, 'driver:' || coalesce(driver_id, '?'), 'dispatch' FROM (SELECT order_id, driver_id, unnest([created_at, pickup_at, actual_delivery_at]) AS t, unnest(['CREATED', 'PICKED_UP', 'DELIVERED']) AS e FROM ord) WHERE t IS NOT NULL)"""),
)
def timeline_union(spark: SparkSession, d: str) -> DataFrame:
    """One timeline from five sources."""
    orders = x.orders(spark, d)
    c, lit = F.col, F.lit
    drivers = orders.select(c("order_id").alias("d_"), F.coalesce("driver_id", lit("?")).alias("driver"))
    times = o.long_times(orders, {"created_at": "CREATED", "pickup_at": "PICKED_UP", "actual_delivery_at": "DELIVERED"}).join(drivers, c("order_id") == c("d_"))
    row = lambda time, kind, actor, source: {"event_time": time, "event_type": kind, "actor": actor, "source_system": lit(source)}
    return o.timeline([
        (x.actions(spark, d), row(c("action_at"), F.concat(lit("APP_"), c("action_type")), F.concat(lit("customer:"), c("customer_id")), "customer_app")),
        (x.tickets(spark, d).dropDuplicates().filter("order_id is not null"), row(c("created_at"), F.concat(lit("TICKET_"), F.trim("category")), lit("customer"), "support")),
        (x.interventions(spark, d), row(c("intervention_at"), F.concat(lit("INTERVENTION_"), c("intervention_type")), lit("ops"), "interventions")),
        (orders, row(c("promised_eta"), lit("PROMISED_ETA (planned)"), lit("order_platform"), "orders")),
        (times, row(c("event_time"), c("event_type"), F.concat(lit("driver:"), c("driver")), "dispatch")),
    ])


@query("event_gaps", "SELECT event_id, user_id, round(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 6e7, 3) AS gap_min FROM events")
def event_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Minutes since the user's event before."""
    e = x.read(spark, d, "events").select("event_id", "user_id", "ts")
    return rounded(o.gaps(e, "user_id", "ts", "event_id").drop("ts"), 3)


@query("out_of_order_pairs", "SELECT user_id, count(*) FILTER (WHERE b) AS n_backwards FROM (SELECT user_id, ts < lag(ts) OVER (PARTITION BY user_id ORDER BY event_id * 7919 % 10007, event_id) AS b FROM events) GROUP BY 1")
def out_of_order_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Stored neighbours whose time goes back (positions are shuffled here, so that some do)."""
    e = x.read(spark, d, "events").select("user_id", "ts", F.expr("(event_id * 7919 % 10007) * 100000000 + event_id").alias("pos"))
    return o.backward_pairs(e, "user_id", "pos", "ts")


@query("closest_ping", x.sql("SELECT o.order_id, round(min(sqrt(power((e.value / 100 - o.customer_id % 7) * 111, 2) + power((e.user_id % 10 - o.customer_id % 5) * 108.2, 2))), 6) AS km FROM events e JOIN ord o ON o.order_id = e.event_id % 500 GROUP BY 1"))
def closest_ping(spark: SparkSession, d: str) -> DataFrame:
    """Plane distance of an order's pings to its place, and the least of each."""
    pings = x.read(spark, d, "events").selectExpr("event_id % 500 AS order_id", "value / 100 AS lat", "CAST(user_id % 10 AS DOUBLE) AS lon")
    places = x.orders(spark, d).selectExpr("order_id", "CAST(customer_id % 7 AS DOUBLE) AS p_lat", "CAST(customer_id % 5 AS DOUBLE) AS p_lon")
    return rounded(o.closest(pings, places, "order_id"))


#: Every third order has a status; of the others the status source has nothing to say.
_LABEL = "CASE WHEN order_id % 3 = 1 THEN CASE customer_id % 3 WHEN 0 THEN 'Preparing ' WHEN 1 THEN 'ready' ELSE 'READY' END END"
_STATUS_ROWS = "SELECT order_id, " + _LABEL + " AS status_label, {at} AS last_updated_at FROM {ord}"


@query(
    "status_freshness",
    x.sql(", st AS (" + _STATUS_ROWS.format(at="CASE WHEN order_id % 3 <> 1 THEN NULL WHEN order_id % 2 = 0 THEN date_trunc('minute', pickup_at) ELSE pickup_at + to_minutes(customer_id % 40 - 30) END", ord="ord") + """),
    j AS (SELECT lower(trim(status_label)) AS s, date_diff('microsecond', pickup_at, last_updated_at) / 6e7 AS vp, date_diff('microsecond', created_at, last_updated_at) / 6e7 AS vc, second(last_updated_at) = 0 AS w FROM st JOIN ord USING (order_id))
    SELECT count(*) AS n_rows, round(avg(CAST(w AS INTEGER)), 6) AS whole_minute_share, count(*) FILTER (WHERE vc < 0) AS before_order, count(*) FILTER (WHERE s = 'preparing') AS still_preparing,
    count(*) FILTER (WHERE s = 'ready' AND vp > 0) AS ready_after_pickup, count(*) FILTER (WHERE vp > 0) AS any_after_pickup, round(median(vp), 6) AS median_vs_pickup_min FROM j"""),
)
def status_freshness(spark: SparkSession, d: str) -> DataFrame:
    """Are status updates fresh enough to be used."""
    orders = x.orders(spark, d)
    at = "CASE WHEN order_id % 3 <> 1 THEN NULL WHEN order_id % 2 = 0 THEN CAST(date_trunc('MINUTE', pickup_at) AS TIMESTAMP_NTZ) ELSE pickup_at + make_dt_interval(0, 0, CAST(customer_id % 40 - 30 AS INT), 0) END"
    rows = orders.select("order_id", F.expr(_LABEL).alias("status_label"), F.expr(at).alias("last_updated_at"))
    return rounded(o.freshness(rows, orders))


@query(
    "eta_revision",
    x.sql("""SELECT order_outcome, count(*) AS n, round(median(date_diff('microsecond', promised_eta, promised_eta + to_minutes(o.customer_id % 21 - 8)) / 6e7), 6) AS eta_revision_min,
    round(median(date_diff('microsecond', created_at + to_minutes(20), pickup_at) / 6e7), 6) AS pickup_slip_min, count(*) FILTER (WHERE abs(o.customer_id % 21 - 8) > 5) AS moved_over_5_min FROM ord o JOIN oc USING (order_id) GROUP BY 1"""),
)
def eta_revision(spark: SparkSession, d: str) -> DataFrame:
    """How promises move, by outcome."""
    orders = x.orders(spark, d)
    dispatch = orders.select(F.col("order_id").alias("d_"), F.expr("promised_eta + make_dt_interval(0, 0, CAST(customer_id % 21 - 8 AS INT), 0)").alias("current_eta"), F.expr("created_at + INTERVAL '20' MINUTE").alias("estimated_pickup_at"))
    rows = orders.join(dispatch, F.col("order_id") == F.col("d_")).withColumns({"rev": minutes_between("promised_eta", "current_eta"), "slip": minutes_between("estimated_pickup_at", "pickup_at")})
    rows = rows.withColumn("order_outcome", o.outcome(orders))
    facts = [F.count("*").alias("n"), F.count_if(F.abs("rev") > 5).alias("moved_over_5_min")]
    return rounded(exact(rows, ["order_outcome"], {"eta_revision_min": ("rev", 0.5), "pickup_slip_min": ("slip", 0.5)}, facts))


@query("gate_table", x.sql("""SELECT 'business grain' AS assumption, CASE WHEN count(*) = count(DISTINCT order_id) THEN 'PASS' ELSE 'FAIL' END AS status, count(*) - count(DISTINCT order_id) AS evidence FROM stored
  UNION ALL SELECT 'completion time', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END, count(*) FROM ord WHERE status = 'delivered' AND actual_delivery_at IS NULL
  UNION ALL SELECT 'promised ETA', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END, count(*) FROM ord WHERE promised_eta < created_at UNION ALL SELECT 'definition of late', 'UNKNOWN', NULL"""))
def gate_table(spark: SparkSession, d: str) -> DataFrame:
    """What has to hold before a number is quoted."""
    orders, c = x.orders(spark, d), F.col
    grain = t.grain(x.stored(spark, d), "orders", "order_id").select(F.lit("business grain").alias("assumption"), F.when(c("is_unique"), "PASS").otherwise("FAIL").alias("status"), (c("n_rows") - c("n_keys")).alias("evidence"))
    counted = t.checks(orders, {"completion time": (c("status") == "delivered") & c("actual_delivery_at").isNull(), "promised ETA": c("promised_eta") < c("created_at")})
    seen = counted.select(c("check_name").alias("assumption"), F.when(c("n") == 0, "PASS").otherwise("WARN").alias("status"), c("n").alias("evidence"))
    unknown = parameter_rows(spark, [("definition of late", "UNKNOWN", None)], "assumption string, status string, evidence long")
    return grain.unionByName(seen).unionByName(unknown)


@query("source_agreement", x.sql("SELECT count(*) AS n_both, count(i.pickup_at) AS n_timed, count(*) FILTER (WHERE o.pickup_at = i.pickup_at) AS n_equal FROM ord o JOIN (SELECT order_id, CASE WHEN order_id % 2 = 1 THEN NULL WHEN order_id % 61 = 3 THEN pickup_at + to_minutes(1) ELSE pickup_at END AS pickup_at FROM s1) i USING (order_id)"))
def source_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How often two sources agree on a time; the second one lacks every other."""
    app = x.stored(spark, d).filter("pos < 100000000").select("order_id", F.expr("CASE WHEN order_id % 2 = 1 THEN NULL WHEN order_id % 61 = 3 THEN pickup_at + INTERVAL '1' MINUTE ELSE pickup_at END").alias("app_at"))
    both = x.orders(spark, d).join(app, "order_id")
    return both.agg(F.count("*").alias("n_both"), F.count("app_at").alias("n_timed"), F.count_if(F.col("pickup_at") == F.col("app_at")).alias("n_equal"))
