"""Investigating deliveries: lateness under competing definitions, stages, outcomes, timelines and interventions.

An order has order_id, customer_id, restaurant_id, driver_id, created_at, promised_eta, pickup_at, actual_delivery_at,
final_status, traffic_bucket, weather_bucket and distance_km; touches and interventions refer to it by order_id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions.columns import first_match, flat_km, half_open_band, last_match, minutes_between, normalised, right_closed_band, share
from plumbline.operators.copies import first_of_key
from plumbline.operators.tables import distinct_list, pivot_counts
from plumbline.operators.neighbours import with_before
from plumbline.operators.quantiles import exact

def is_late() -> Column:
    return F.col("delay_min") > 0


def is_known() -> Column:
    """Delivered, at a time that is known."""
    return (F.col("status") == "delivered") & F.col("actual_delivery_at").isNotNull()


def prepared(orders: DataFrame, position: str) -> DataFrame:
    """One row an order (the first stored), labels in one spelling, and the delay in minutes."""
    one = first_of_key(orders, ["order_id"], [position])
    return one.withColumns({"status": normalised("final_status"), "traffic": normalised("traffic_bucket"), "delay_min": minutes_between("promised_eta", "actual_delivery_at")})


def sound(orders: DataFrame) -> DataFrame:
    """Delivered orders of known time whose times are in order."""
    return orders.filter(is_known() & (F.col("promised_eta") >= F.col("created_at")) & (F.col("actual_delivery_at") >= F.col("pickup_at")))


def staged(orders: DataFrame) -> DataFrame:
    """Sound orders with their stages in minutes, and bands of distance and hour."""
    return sound(orders).withColumns(
        {
            "late": is_late(),
            "prep_min": minutes_between("created_at", "pickup_at"),
            "travel_min": minutes_between("pickup_at", "actual_delivery_at"),
            "promised_min": minutes_between("created_at", "promised_eta"),
            "distance_band": right_closed_band(F.col("distance_km"), [0, 6, 10, 15, 100], ["0-6 km", "6-10 km", "10-15 km", "15+ km"]),
            "time_of_day": half_open_band(F.hour("created_at"), [(0, 15, "before 15:00"), (15, 18, "15-18"), (18, 21, "18-21"), (21, 24, "21-24")]),
        }
    )


def compared(stages: DataFrame, by: Sequence[str]) -> DataFrame:
    """(dimension, bucket, ...): lateness and median stages for each value of several dimensions, in one pass.

    Every order counts once in each dimension that it has a value of.
    """
    measures = ("delay_min", "promised_min", "travel_min", "prep_min")
    placed = F.inline(F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(n).cast("string").alias("bucket")) for n in by]))
    rows = stages.select(F.col("late").cast("int").alias("late_"), *measures, placed).filter("bucket is not null")
    keys = ["dimension", "bucket"]
    return exact(rows, keys, {f"median_{c}": (c, 0.5) for c in measures}, [F.count("*").alias("n_orders"), F.avg("late_").alias("late_rate")])


def correlations(stages: DataFrame) -> DataFrame:
    """Pearson correlation of each stage with the delay."""
    return stages.agg(*[F.corr(c, "delay_min").alias(f"corr_{c}") for c in ("prep_min", "travel_min", "distance_km")])


def late_rates(orders: DataFrame, stored: DataFrame) -> DataFrame:
    """(definition, late, denominator, late_rate_pct) under seven definitions, all counted in one pass over each frame.

    orders: one row an order; stored: as the source has them, repeated rows and spellings included.
    """
    delivered, cancelled = F.col("status") == "delivered", F.col("status") == "cancelled"
    c = orders.agg(
        F.count_if(is_known() & is_late()).alias("late"), F.count_if(is_known()).alias("known"), F.count_if(is_known() & (F.col("delay_min") > 10)).alias("late10"),
        F.count_if(delivered).alias("delivered"), F.count_if(delivered & F.col("actual_delivery_at").isNull()).alias("unknown"), F.count_if(cancelled).alias("cancelled"),
    )
    exact = (F.col("final_status") == "delivered") & F.col("actual_delivery_at").isNotNull()
    h = stored.agg(F.count_if(exact & (F.col("actual_delivery_at") > F.col("promised_eta"))).alias("h_late"), F.count_if(exact).alias("h_all"))
    x = lambda name, late, of: F.struct(F.lit(name).alias("definition"), late.alias("late"), of.alias("denominator"))
    n = {k: F.col(k) for k in (*c.columns, *h.columns)}
    rows = [
        x("any delay, delivered at a known time", n["late"], n["known"]),
        x("more than 10 minutes", n["late10"], n["known"]),
        x("as stored: exact spelling, repeated rows", n["h_late"], n["h_all"]),
        x("without cancelled orders", n["late"], n["known"]),
        x("unknown times all late", n["late"] + n["unknown"], n["delivered"]),
        x("unknown times all on time", n["late"], n["delivered"]),
        x("cancelled orders as failures", n["late"] + n["cancelled"], n["known"] + n["cancelled"]),
    ]
    flat = c.crossJoin(h).select(F.inline(F.array(*rows)))  # one row each
    return flat.withColumn("late_rate_pct", F.round(100 * share("late", "denominator"), 1))


def outcome(orders: DataFrame) -> Column:
    """on_time, late, unknown_time or cancelled: each later label overrides the ones before."""
    return last_match((is_late(), "late"), (F.col("actual_delivery_at").isNull(), "unknown_time"), (F.col("status") == "cancelled", "cancelled"), otherwise="on_time")


def outcomes(orders: DataFrame) -> DataFrame:
    """(order_id, order_outcome, final_status_norm, late_flag, delay_min): late_flag is null where it can't be known."""
    label = outcome(orders)
    return orders.select("order_id", label.alias("order_outcome"), F.col("status").alias("final_status_norm"), F.when(is_known(), is_late().cast("int")).alias("late_flag"), F.when(is_known(), F.col("delay_min")).alias("delay_min"))


def tickets_by_outcome(tickets: DataFrame, orders: DataFrame) -> DataFrame:
    """Exact copies dropped, categories in one spelling, and each ticket's order outcome or 'no order link'."""
    kinds = tickets.dropDuplicates().withColumn("category_norm", normalised("category", "_"))
    known = outcomes(orders).select(F.col("order_id").alias("o_"), "order_outcome")
    joined = kinds.join(known, F.col("order_id") == F.col("o_"), "left").drop("o_")
    return joined.withColumn("order_outcome", F.coalesce("order_outcome", F.lit("no order link")))


ACTIONS = ("ETA_VIEWED", "SUPPORT_OPENED", "CANCEL_ATTEMPTED")


def order_level(orders: DataFrame, actions: DataFrame, tickets: DataFrame, interventions: DataFrame) -> DataFrame:
    """One row an order: touches, interventions and outcome. Children are aggregated before they are joined."""
    touched = pivot_counts(actions.filter("order_id is not null"), "order_id", "action_type", ACTIONS).withColumnsRenamed({a: a.lower() for a in ACTIONS})
    had = tickets.filter("order_id is not null").select("order_id").distinct().withColumn("ticket_", F.lit(True))
    acted = distinct_list(interventions.filter("order_id is not null"), "order_id", "intervention_type").withColumnsRenamed({"n": "intervention_count", "values": "intervention_types"})
    rows = outcomes(orders).join(orders.select("order_id", "customer_id", "restaurant_id"), "order_id")
    for child in (touched, had, acted):
        rows = rows.join(child, "order_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0))
    return rows.select(
        "order_id", "customer_id", "restaurant_id",
        ((count("support_opened") > 0) | F.coalesce("ticket_", F.lit(False))).alias("support_opened"),
        (count("cancel_attempted") > 0).alias("cancel_attempted"),
        count("intervention_count").cast("long").alias("intervention_count"),
        F.coalesce("intervention_types", F.lit("")).alias("intervention_types"),
        F.col("final_status_norm").alias("final_status"), "late_flag", "delay_min", "order_outcome",
    )


def is_frustrated() -> Column:
    return F.col("support_opened") | F.col("cancel_attempted")


def journeys(level: DataFrame) -> DataFrame:
    """Orders with a support contact or an attempt to cancel that nobody acted on."""
    return level.filter(is_frustrated() & (F.col("intervention_count") == 0))


def journey_rates(level: DataFrame) -> DataFrame:
    """One row of counts: late, with support, intervened, frustrated, unattended, and shares of them."""
    late, alone = F.col("late_flag") == 1, is_frustrated() & (F.col("intervention_count") == 0)
    c = level.agg(
        F.count_if(late).alias("late_orders"), F.count_if(late & F.col("support_opened")).alias("late_with_support"), F.count_if(F.col("intervention_count") > 0).alias("intervened"),
        F.count_if(is_frustrated()).alias("frustrated"), F.count_if(alone).alias("unattended"), F.count_if(alone & late).alias("unattended_late"),
    )
    return c.select("*", share("late_with_support", "late_orders").alias("support_rate_of_late"), share("unattended", "frustrated").alias("unattended_share"))


def phases(interventions: DataFrame, orders: DataFrame) -> DataFrame:
    """Interventions with their phase: before pickup, in transit, no delivery time, or after delivery."""
    at = F.col("intervention_at")
    label = first_match((at < F.col("pickup_at"), "before pickup"), (at <= F.col("actual_delivery_at"), "in transit"), (F.col("actual_delivery_at").isNull(), "no delivery time"), otherwise="after delivery")
    late = F.when(is_known(), is_late().cast("int"))
    known = orders.select("order_id", "pickup_at", "actual_delivery_at", late.alias("late_flag"))
    return interventions.join(known, "order_id").withColumn("phase", label)


def timeline(sources: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """(order_id, event_time, event_type, actor, source_system) of several sources, each given by its four expressions."""
    parts = [df.select("order_id", *[c.alias(n) for n, c in cols.items()]) for df, cols in sources]
    return reduce(DataFrame.unionByName, parts).filter("event_time is not null")


def long_times(rows: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Several time columns as rows (order_id, column's label, time), nulls left out."""
    named = rows.select("order_id", *[F.col(c).alias(label) for c, label in labels.items()])
    return named.unpivot(["order_id"], list(labels.values()), "event_type", "event_time").filter("event_time is not null")


def gaps(rows: DataFrame, group: str, time: str, tie: str) -> DataFrame:
    """Minutes since the row before in the same group; null for a group's first."""
    found = with_before(rows, group, [time, tie], [time], "before_")
    return found.withColumn("gap_min", minutes_between(F.col(f"before_.{time}"), F.col(time))).drop("before_")


def backward_pairs(rows: DataFrame, group: str, position: str, time: str) -> DataFrame:
    """(group, n_backwards): neighbours in stored order whose time goes back."""
    found = with_before(rows, group, [position], [time], "before_")
    return found.groupBy(group).agg(F.count_if(F.col(time) < F.col(f"before_.{time}")).alias("n_backwards"))


def closest(pings: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """(order_id, km): the least distance of an order's pings to its place."""
    km = flat_km(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon"))
    return pings.join(places, key).groupBy("order_id").agg(F.min(km).alias("km"))


def freshness(status: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: how late status updates are against the order's life, and how often they fall on whole minutes."""
    joined = status.join(orders.select("order_id", "created_at", "pickup_at"), "order_id")
    rows = joined.withColumns({"s_": normalised("status_label"), "vs_pickup": minutes_between("pickup_at", "last_updated_at"), "vs_created": minutes_between("created_at", "last_updated_at")})
    after = F.col("vs_pickup") > 0
    facts = [
        F.count("*").alias("n_rows"), F.avg((F.second("last_updated_at") == 0).cast("int")).alias("whole_minute_share"), F.count_if(F.col("vs_created") < 0).alias("before_order"),
        F.count_if(F.col("s_") == "preparing").alias("still_preparing"), F.count_if((F.col("s_") == "ready") & after).alias("ready_after_pickup"), F.count_if(after).alias("any_after_pickup"),
    ]
    return exact(rows, [], {"median_vs_pickup_min": ("vs_pickup", 0.5)}, facts)
