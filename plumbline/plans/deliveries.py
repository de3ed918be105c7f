"""Deliveries, tickets, actions and interventions made from the orders, lineitem and events tables, in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import orders as o
from plumbline.plans.adapter import read

_TRAFFIC = "CASE o_orderkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN ' Medium' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'severe' END"
_WEATHER = "CASE o_custkey % 3 WHEN 0 THEN 'clear' WHEN 1 THEN 'rain' ELSE 'heavy_rain' END"
_STATUS = "CASE WHEN o_orderstatus = 'P' OR o_orderkey % 23 = 4 THEN 'cancelled' WHEN o_orderkey % 50 = 1 THEN ' Delivered' ELSE 'delivered' END"


def stored(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a source has them: spellings differ and some rows repeat. `pos` is the stored position."""
    raw = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    m = lambda e: f"make_dt_interval(0, 0, CAST({e} AS INT), 0)"
    x = raw.withColumn("created_at", F.expr(f"o_orderdate + {m('o_orderkey % 1440')}"))
    x = x.withColumn("pickup_at", F.expr(f"created_at + {m('o_orderkey * 7 % 50')} + make_dt_interval(0, 0, 0, o_orderkey % 60)"))
    x = x.withColumn("promised_eta", F.expr(f"CASE WHEN o_orderkey % 401 = 3 THEN created_at - {m('10')} ELSE created_at + {m('30 + o_custkey % 60')} END"))
    x = x.withColumn("actual_delivery_at", F.expr(f"CASE WHEN o_orderkey % 43 = 5 THEN NULL WHEN o_orderkey % 307 = 11 THEN pickup_at - {m('5')} ELSE pickup_at + {m('o_custkey * 3 % 70')} END"))
    one = x.select(
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.expr("CASE WHEN o_orderkey % 97 <> 1 THEN concat('R', o_custkey % 20) END").alias("restaurant_id"), F.expr("CASE WHEN o_orderkey % 89 <> 2 THEN concat('D', o_custkey % 30) END").alias("driver_id"),
        "created_at", "promised_eta", "pickup_at", "actual_delivery_at", F.expr(_STATUS).alias("final_status"), F.expr(_TRAFFIC).alias("traffic_bucket"), F.expr(_WEATHER).alias("weather_bucket"),
        F.expr("o_totalprice / 20000").alias("distance_km"),
    )
    again = one.filter("order_id % 199 = 7").withColumns({"pos": F.col("pos") + 100_000_000, "traffic_bucket": F.lit("low")})
    return one.unionByName(again)


def orders(spark: SparkSession, d: str) -> DataFrame:
    return o.prepared(stored(spark, d), "pos")


def tickets(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").filter("event_id % 4 = 1")
    one = e.select(
        F.col("event_id").alias("ticket_id"), F.expr("CASE WHEN event_id % 53 <> 2 THEN event_id END").alias("order_id"),
        F.expr("CASE user_id % 4 WHEN 0 THEN 'Late Order ' WHEN 1 THEN 'late order' WHEN 2 THEN 'Missing item' ELSE 'REFUND' END").alias("category"), F.col("ts").alias("created_at"),
    )
    return one.unionByName(one.filter("ticket_id % 31 = 6"))


def actions(spark: SparkSession, d: str) -> DataFrame:
    kind = "CASE user_id % 3 WHEN 0 THEN 'ETA_VIEWED' WHEN 1 THEN 'SUPPORT_OPENED' ELSE 'CANCEL_ATTEMPTED' END"
    e = read(spark, d, "events").filter("event_id % 4 <> 1")
    return e.select(F.col("event_id").alias("action_id"), F.expr("event_id % 997").alias("order_id"), F.concat(F.lit("C"), F.col("user_id")).alias("customer_id"), F.expr(kind).alias("action_type"), F.col("ts").alias("action_at"))


def interventions(spark: SparkSession, d: str) -> DataFrame:
    """Actions of the business, around the pickup of their order."""
    kind = "CASE user_id % 4 WHEN 0 THEN 'CALL' WHEN 1 THEN 'CREDIT' WHEN 2 THEN 'REASSIGN' ELSE 'MESSAGE' END"
    e = read(spark, d, "events").filter("event_id % 4 = 3").selectExpr("event_id AS intervention_id", "event_id % 1499 AS order_id", f"{kind} AS intervention_type", "user_id")
    at = stored(spark, d).filter("pos < 100000000").select(F.col("order_id").alias("o_"), "pickup_at")
    joined = e.join(at, F.col("order_id") == F.col("o_"))
    return joined.select("intervention_id", "order_id", "intervention_type", F.expr("pickup_at + make_dt_interval(0, 0, CAST(user_id % 90 - 20 AS INT), 0)").alias("intervention_at"))


SQL = f"""
x1 AS (SELECT *, o_orderdate + to_minutes(o_orderkey % 1440) AS created_at FROM orders),
x2 AS (SELECT *, created_at + to_minutes(o_orderkey * 7 % 50) + to_seconds(o_orderkey % 60) AS pickup_at FROM x1),
x3 AS (SELECT *, CASE WHEN o_orderkey % 401 = 3 THEN created_at - to_minutes(10) ELSE created_at + to_minutes(30 + o_custkey % 60) END AS promised_eta,
  CASE WHEN o_orderkey % 43 = 5 THEN NULL WHEN o_orderkey % 307 = 11 THEN pickup_at - to_minutes(5) ELSE pickup_at + to_minutes(o_custkey * 3 % 70) END AS actual_delivery_at FROM x2),
s1 AS (SELECT o_orderkey AS pos, o_orderkey AS order_id, o_custkey AS customer_id, CASE WHEN o_orderkey % 97 <> 1 THEN 'R' || (o_custkey % 20) END AS restaurant_id,
  CASE WHEN o_orderkey % 89 <> 2 THEN 'D' || (o_custkey % 30) END AS driver_id, created_at, promised_eta, pickup_at, actual_delivery_at,
  {_STATUS} AS final_status, {_TRAFFIC} AS traffic_bucket, {_WEATHER} AS weather_bucket, o_totalprice / 20000 AS distance_km FROM x3),
stored AS (SELECT * FROM s1 UNION ALL SELECT pos + 100000000, order_id, customer_id, restaurant_id, driver_id, created_at, promised_eta, pickup_at, actual_delivery_at, final_status, 'low', weather_bucket, distance_km
  FROM s1 WHERE order_id % 199 = 7),
ord AS (SELECT *, lower(trim(final_status)) AS status, lower(trim(traffic_bucket)) AS traffic, date_diff('microsecond', promised_eta, actual_delivery_at) / 6e7 AS delay_min
  FROM stored QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY pos) = 1),
oc AS (SELECT order_id, CASE WHEN status = 'cancelled' THEN 'cancelled' WHEN actual_delivery_at IS NULL THEN 'unknown_time' WHEN delay_min > 0 THEN 'late' ELSE 'on_time' END AS order_outcome,
  status AS final_status_norm, CASE WHEN status = 'delivered' AND actual_delivery_at IS NOT NULL THEN CAST(delay_min > 0 AS INTEGER) END AS late_flag,
  CASE WHEN status = 'delivered' AND actual_delivery_at IS NOT NULL THEN delay_min END AS delay_min FROM ord),
stages AS (SELECT *, delay_min > 0 AS late, date_diff('microsecond', created_at, pickup_at) / 6e7 AS prep_min, date_diff('microsecond', pickup_at, actual_delivery_at) / 6e7 AS travel_min,
  date_diff('microsecond', created_at, promised_eta) / 6e7 AS promised_min,
  CASE WHEN distance_km > 0 AND distance_km <= 6 THEN '0-6 km' WHEN distance_km <= 10 THEN '6-10 km' WHEN distance_km <= 15 THEN '10-15 km' WHEN distance_km <= 100 THEN '15+ km' END AS distance_band,
  CASE WHEN hour(created_at) < 15 THEN 'before 15:00' WHEN hour(created_at) < 18 THEN '15-18' WHEN hour(created_at) < 21 THEN '18-21' ELSE '21-24' END AS time_of_day
  FROM ord WHERE status = 'delivered' AND actual_delivery_at IS NOT NULL AND promised_eta >= created_at AND actual_delivery_at >= pickup_at),
tk1 AS (SELECT event_id AS ticket_id, CASE WHEN event_id % 53 <> 2 THEN event_id END AS order_id,
  CASE user_id % 4 WHEN 0 THEN 'Late Order ' WHEN 1 THEN 'late order' WHEN 2 THEN 'Missing item' ELSE 'REFUND' END AS category, ts AS created_at FROM events WHERE event_id % 4 = 1),
tickets AS (SELECT * FROM tk1 UNION ALL SELECT * FROM tk1 WHERE ticket_id % 31 = 6),
actions AS (SELECT event_id AS action_id, event_id % 997 AS order_id, 'C' || user_id AS customer_id,
  CASE user_id % 3 WHEN 0 THEN 'ETA_VIEWED' WHEN 1 THEN 'SUPPORT_OPENED' ELSE 'CANCEL_ATTEMPTED' END AS action_type, ts AS action_at FROM events WHERE event_id % 4 <> 1),
interventions AS (SELECT event_id AS intervention_id, event_id % 1499 AS order_id, CASE user_id % 4 WHEN 0 THEN 'CALL' WHEN 1 THEN 'CREDIT' WHEN 2 THEN 'REASSIGN' ELSE 'MESSAGE' END AS intervention_type,
  s.pickup_at + to_minutes(user_id % 90 - 20) AS intervention_at FROM events e JOIN s1 s ON s.order_id = e.event_id % 1499 WHERE event_id % 4 = 3)"""


def sql(select: str) -> str:
    return f"WITH {SQL}\n{select}"
