"""Staging views, dimensions, facts and aggregates of the delivery marketplace."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.keys import surrogate_key
from tidelake.operators.history import scd2_as_of_dealt, scd2_as_of_join, scd2_effective_from
from tidelake.operators.state import latest_state

SLA_GRACE_MINUTES = 0
#: Size of the sketches of minutes: a rank error of about 0.7 hundredths.
SKETCH_K = 400
#: Days before the given date that a routine run rebuilds.
REBUILT_DAYS = 3


def _minutes(a: str, b: str) -> Column:
    """Minutes from a to b in whole seconds; null until both are there."""
    return F.timestamp_diff("SECOND", F.date_trunc("second", F.col(a)), F.date_trunc("second", F.col(b))) / F.lit(60.0)


def _exact_mean(minutes: str) -> Column:
    """The mean of minutes, summed in whole microseconds: a mean of doubles depends on the order in
    which rows arrive, and its second decimal with it wherever it lies on a half."""
    sums = F.sum(F.round(F.col(minutes) * 60_000_000).cast("long"))
    return F.try_divide(sums, F.count(minutes) * F.lit(60_000_000))


# --- staging ----------------------------------------------------------------------------


def stg_orders(orders: DataFrame) -> DataFrame:
    s = F.col("status")
    return orders.select(
        "order_id", "customer_id", "restaurant_id", "rider_id", "status",
        "placed_ts", "accepted_ts", "picked_up_ts", "delivered_ts", "promised_ts", "cancel_reason",
        "subtotal_inr", "delivery_fee_inr", "discount_inr", "total_inr",
        _minutes("placed_ts", "picked_up_ts").alias("prep_minutes"),
        _minutes("picked_up_ts", "delivered_ts").alias("transit_minutes"),
        _minutes("placed_ts", "delivered_ts").alias("total_minutes"),
        _minutes("promised_ts", "delivered_ts").alias("sla_breach_minutes"),
        (s == "CANCELLED").alias("is_cancelled"), (s == "DELIVERED").alias("is_delivered"), s.isin("DELIVERED", "CANCELLED").alias("is_terminal"),
        "is_deleted", "lsn",
    )


def stg_customers(changes: DataFrame) -> DataFrame:
    """Latest customers without their phone numbers."""
    return latest_state(changes, ["customer_id"]).select(
        "customer_id", F.col("name").alias("customer_name"), "city", "signup_ts", "tier", "is_active", "updated_at", "is_deleted", "lsn"
    )


def stg_order_items(changes: DataFrame) -> DataFrame:
    return latest_state(changes, ["order_item_id"]).select(
        "order_item_id", "order_id", "menu_item_id", "qty", "unit_price_inr", (F.col("qty") * F.col("unit_price_inr")).alias("line_total_inr"), "is_deleted", "lsn"
    )


_WINDOW = ("valid_from", "valid_to", "is_current", "is_deleted", "lsn")


def stg_restaurants(dim: DataFrame) -> DataFrame:
    return dim.select("restaurant_id", F.col("name").alias("restaurant_name"), "city", "cuisine", "lat", "lon", "rating", "commission_pct", "is_open", *_WINDOW)


def stg_riders(dim: DataFrame) -> DataFrame:
    return dim.select("rider_id", F.col("name").alias("rider_name"), F.col("city").alias("rider_city"), "vehicle_type", "tier", "shift_start", "is_online", *_WINDOW)


def stg_menu_items(dim: DataFrame) -> DataFrame:
    return dim.select("menu_item_id", "restaurant_id", F.col("name").alias("menu_item_name"), F.col("price_inr").alias("menu_price_inr"), "is_available", *_WINDOW)


def stg_trips(trips: DataFrame) -> DataFrame:
    return trips.select(
        "rider_id", "trip_id", "trip_date", "started_ts", "ended_ts", (F.col("duration_s") / 60.0).alias("duration_minutes"), "ping_count",
        "avg_speed_kmph", "max_speed_kmph", "straight_line_km",
    )


# --- dimensions -------------------------------------------------------------------------


def dim_customer(staged: DataFrame) -> DataFrame:
    return staged.where("not is_deleted").select(
        surrogate_key(["customer_id"]).alias("customer_sk"), "customer_id", "customer_name", "city", "tier", "is_active", "signup_ts",
        F.date_trunc("month", "signup_ts").alias("signup_month"), "updated_at",
    )


def _dim_scd2(staged: DataFrame, key: str, sk: str) -> DataFrame:
    """A version for each window; windows of deleted rows go before the first one is opened back."""
    live = scd2_effective_from(staged.where("not is_deleted"), key)
    return live.select(surrogate_key([key, "valid_from"]).alias(sk), *[c for c in staged.columns if c not in ("is_deleted", "lsn")], "effective_from")


def dim_restaurant(staged: DataFrame) -> DataFrame:
    return _dim_scd2(staged, "restaurant_id", "restaurant_sk")


def dim_rider(staged: DataFrame) -> DataFrame:
    return _dim_scd2(staged, "rider_id", "rider_sk")


def dim_menu_item(staged: DataFrame) -> DataFrame:
    return _dim_scd2(staged, "menu_item_id", "menu_item_sk")


# --- facts ------------------------------------------------------------------------------


def fact_delivery(orders: DataFrame, dates: DataFrame, customers: DataFrame, restaurants: DataFrame, riders: DataFrame, weather: DataFrame, grace_minutes: float = SLA_GRACE_MINUTES) -> DataFrame:
    """One row for each live order with the keys of its dimensions; restaurant and rider as
    they were when the order was placed.  ``orders``, one row for each order_id, are read once for
    each as-of join and once more; so they should be a stored table."""
    rows = orders.where("not is_deleted").withColumn("__day", F.to_date("placed_ts"))
    rows = scd2_as_of_join(rows, restaurants, "restaurant_id", "placed_ts", {"restaurant_sk": "restaurant_sk", "city": "city", "cuisine": "cuisine", "commission_pct": "commission_pct"}, row_key=["order_id"])
    rows = scd2_as_of_join(rows, riders, "rider_id", "placed_ts", {"rider_sk": "rider_sk"}, row_key=["order_id"])
    rows = rows.join(dates.select("date_sk", F.col("date_day").alias("__day")), "__day", "left")
    rows = rows.join(customers.select("customer_sk", "customer_id"), "customer_id", "left")
    rows = rows.join(weather.select("weather_sk", "city", F.col("weather_date").alias("__day")), ["city", "__day"], "left")
    done, late = F.col("is_delivered"), F.col("sla_breach_minutes")
    commission = F.col("subtotal_inr") * F.col("commission_pct") / F.lit(100)
    return rows.select(
        surrogate_key(["order_id"]).alias("order_sk"), "order_id", "date_sk", "customer_sk", "restaurant_sk", "rider_sk", "weather_sk",
        "customer_id", "restaurant_id", "rider_id", "city", "cuisine", "status",
        "placed_ts", "accepted_ts", "picked_up_ts", "delivered_ts", "promised_ts", "prep_minutes", "transit_minutes", "total_minutes",
        F.when(done, late).alias("sla_breach_minutes"), F.when(done, late > grace_minutes).alias("sla_breach_flag"),
        F.col("subtotal_inr").alias("gross_revenue_inr"), "discount_inr", "delivery_fee_inr", "total_inr",
        F.round(commission, 2).alias("commission_inr"), F.col("delivery_fee_inr").alias("rider_payout_inr"),
        # the delivery fee comes in and goes out to the rider
        F.round(commission - F.col("discount_inr"), 2).alias("contribution_margin_inr"),
        F.col("is_cancelled").alias("cancelled_flag"), "cancel_reason", "is_delivered", "is_terminal",
    )


def fact_order_item(items: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    """One row for each live line of a live order, with the menu's price when it was placed.
    ``items`` are read once more, for how many lines an item of the menu has; so they should be a stored
    table.  A line travels with its menu item's times, not with its longer key, which is made of them in the end."""
    head = orders.where("not is_deleted").select("order_id", "placed_ts", "restaurant_id", F.col("status").alias("order_status"))
    rows = items.where("not is_deleted").select("order_item_id", "order_id", "menu_item_id", "qty", "unit_price_inr", "line_total_inr").join(head, "order_id")
    found = {"valid_from": "__from", "menu_item_name": "menu_item_name", "menu_price_inr": "menu_price_inr"}
    rows = scd2_as_of_dealt(rows, menu, "menu_item_id", "placed_ts", found, counted=items)
    rows = rows.withColumn("menu_item_sk", F.when(F.col("__from").isNotNull(), surrogate_key(["menu_item_id", "__from"])))
    return rows.select(
        surrogate_key(["order_item_id"]).alias("order_item_sk"), surrogate_key(["order_id"]).alias("order_sk"), "menu_item_sk",
        "order_item_id", "order_id", "menu_item_id", "restaurant_id", "menu_item_name", "qty", "unit_price_inr", "line_total_inr",
        "menu_price_inr", (F.col("unit_price_inr") - F.col("menu_price_inr")).alias("price_variance_inr"), "placed_ts", "order_status",
    )


# --- aggregates -------------------------------------------------------------------------


def agg_sla_daily(facts: DataFrame, dates: DataFrame, weather: DataFrame) -> DataFrame:
    """Delivered orders by day, city and restaurant."""
    rows = facts.where("is_delivered")
    rows = rows.join(dates.select("date_sk", "day_type", "is_weekend", "is_holiday"), "date_sk", "left")
    rows = rows.join(weather.select("weather_sk", "weather_band", "is_rainy"), "weather_sk", "left")
    breached = F.count_if("sla_breach_flag")
    whole = F.percentile_approx("total_minutes", [0.5, 0.95], 10_000)
    mean = lambda c: F.round(_exact_mean(c), 2).alias(f"avg_{c}")
    out = rows.groupBy(F.to_date("placed_ts").alias("order_date"), "city", "restaurant_id").agg(
        *[F.max(c).alias(c) for c in ("day_type", "is_weekend", "is_holiday", "weather_band", "is_rainy")],
        F.count(F.lit(1)).alias("delivered_orders"), breached.alias("breached_orders"),
        F.round(F.lit(100.0) * breached / F.count(F.lit(1)), 2).alias("sla_breach_pct"),
        mean("prep_minutes"), mean("transit_minutes"), mean("total_minutes"), whole.alias("__p"),
        *[F.sum(c).alias(c) for c in ("gross_revenue_inr", "commission_inr", "contribution_margin_inr")],
    )
    return out.withColumn("p50_total_minutes", F.round(F.col("__p")[0], 2)).withColumn("p95_total_minutes", F.round(F.col("__p")[1], 2)).drop("__p")


def agg_sla_daily_incremental(facts: DataFrame, dates: DataFrame, weather: DataFrame, as_of: dt.date, backfill: dt.date | None = None, days: int = REBUILT_DAYS) -> DataFrame:
    """The days a run rebuilds: one to backfill, else those from ``days`` before ``as_of``."""
    day = F.to_date("placed_ts")
    some = facts.where(day == F.lit(backfill)) if backfill else facts.where(day >= F.date_sub(F.lit(as_of), days))
    return agg_sla_daily(some, dates, weather)


def sla_parts(facts: DataFrame) -> DataFrame:
    """Delivered orders by day, city and restaurant as parts that add up: counts, sums, and a
    sketch of the total minutes.  Stored by day, a period's figures need no fact again."""
    minutes = F.kll_sketch_agg_double(F.col("total_minutes").cast("double"), F.lit(SKETCH_K))
    return facts.where("is_delivered").groupBy(F.to_date("placed_ts").alias("order_date"), "city", "restaurant_id").agg(
        F.count(F.lit(1)).alias("delivered_orders"), F.count_if("sla_breach_flag").alias("breached_orders"),
        *[F.sum(c).alias(c) for c in ("gross_revenue_inr", "commission_inr", "contribution_margin_inr")], minutes.alias("minutes_sketch"),
    )


def sla_period(parts: DataFrame, by: list[str]) -> DataFrame:
    """Any coarser aggregate from ``sla_parts``: sums are exact, p50 and p95 off in rank by about a
    hundredth at most (a sketch of SKETCH_K)."""
    at = lambda p: F.kll_sketch_get_quantile_double("minutes_sketch", F.lit(p))
    whole = parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("delivered_orders", "breached_orders", "gross_revenue_inr", "commission_inr", "contribution_margin_inr")], F.kll_merge_agg_double("minutes_sketch", F.lit(SKETCH_K)).alias("minutes_sketch"))
    pct = F.round(F.lit(100.0) * F.col("breached_orders") / F.col("delivered_orders"), 2)
    return whole.withColumns({"sla_breach_pct": pct, "p50_total_minutes": at(0.5), "p95_total_minutes": at(0.95)}).drop("minutes_sketch")


def sla_by_hour(facts: DataFrame) -> DataFrame:
    """Share of breaches by city, restaurant and hour of the day."""
    done = facts.where("is_delivered").groupBy("city", "restaurant_id", F.hour("placed_ts").alias("hour_of_day"))
    return done.agg(F.count(F.lit(1)).alias("delivered_orders"), F.round(F.lit(100.0) * F.count_if("sla_breach_flag") / F.count(F.lit(1)), 2).alias("sla_breach_pct"))


def unit_economics(facts: DataFrame) -> DataFrame:
    """Margin of delivered orders by city, split by whether preparation or transit took longer."""
    slower = F.when(F.col("prep_minutes") >= F.col("transit_minutes"), "PREP").otherwise("TRANSIT")
    return facts.where("is_delivered").groupBy("city", slower.alias("slower_part")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("contribution_margin_inr").alias("contribution_margin_inr"), F.round(F.avg("contribution_margin_inr"), 2).alias("avg_margin_inr")
    )


def agg_rider_utilisation(trips: DataFrame) -> DataFrame:
    """By rider and day: minutes on trips, the share of the time from first to last ping, and
    the median gap between trips."""
    order = Window.partitionBy("rider_id", "trip_date").orderBy("started_ts", "trip_id")
    until = F.max("ended_ts").over(order.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.greatest(F.timestamp_diff("SECOND", until, F.col("started_ts")), F.lit(0)) / 60.0
    covered = F.timestamp_diff("SECOND", F.greatest("started_ts", F.coalesce(until, F.col("started_ts"))), F.col("ended_ts"))
    rows = trips.withColumn("gap", gap).withColumn("covered", F.greatest(covered, F.lit(0)) / 60.0)
    span = F.timestamp_diff("SECOND", F.min("started_ts"), F.max("ended_ts")) / 60.0
    out = rows.groupBy("rider_id", "trip_date").agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("covered"), 2).alias("active_minutes"), F.round(span, 2).alias("span_minutes"), F.round(F.percentile_approx("gap", 0.5, 10_000), 2).alias("median_gap_minutes")
    )
    return out.withColumn("utilisation_pct", F.round(F.try_divide(F.lit(100.0) * F.col("active_minutes"), F.col("span_minutes")), 2))


def weather_impact(facts: DataFrame, weather: DataFrame) -> DataFrame:
    """Median transit of delivered orders by city, on rainy and other days."""
    rows = facts.where("is_delivered").join(weather.select("weather_sk", "is_rainy"), "weather_sk")
    return rows.groupBy("city", "is_rainy").agg(F.count(F.lit(1)).alias("orders"), F.round(F.percentile_approx("transit_minutes", 0.5, 10_000), 2).alias("median_transit_minutes"))


def cohort_retention(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers of each signup month that ordered so many months later."""
    rows = facts.join(customers.select("customer_id", "signup_month"), "customer_id")
    month = F.date_trunc("month", "placed_ts")
    later = (F.year(month) - F.year("signup_month")) * 12 + F.month(month) - F.month("signup_month")
    return rows.groupBy("signup_month", later.alias("months_later")).agg(F.count_distinct("customer_id").alias("customers"))


def volume_delta(facts: DataFrame, days: int = 7) -> DataFrame:
    """Orders of each day against the mean of the days before it that had orders."""
    daily = facts.groupBy(F.to_date("placed_ts").alias("order_date")).agg(F.count(F.lit(1)).alias("orders"))
    before = Window.partitionBy(F.lit(0)).orderBy("order_date").rowsBetween(-days, -1)
    return daily.withColumn("baseline", F.round(F.avg("orders").over(before), 2)).withColumn("delta_pct", F.round((F.col("orders") / F.col("baseline") - 1) * 100, 2))
