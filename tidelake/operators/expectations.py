"""Row expectations: rules declared as data, all judged in one pass.

A rule says what kind of condition a column has to meet, with which bound and for which rows.
One evaluator turns rules into columns; a row's verdicts are one map from rule to outcome.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    holds: Column

    def violated(self) -> Column:
        """Whether the condition is anything but true: false and null alike."""
        return ~F.equal_null(self.holds, F.lit(True))


class Rule(NamedTuple):
    """``column`` (a name or an expression) is of ``kind`` with respect to ``bound``, unless ``exempt`` holds."""

    name: str
    column: str
    kind: str
    bound: object = None
    exempt: str | None = None


#: How a value and a bound are compared; bounds that are strings are expressions.
KINDS: dict[str, Callable[[Column, Column], Column]] = {
    "present": lambda value, _: value.isNotNull(),
    "at least": lambda value, bound: value >= bound,
    "more than": lambda value, bound: value > bound,
    "at most": lambda value, bound: value <= bound,
    "less than": lambda value, bound: value < bound,
    "same as": lambda value, bound: value == bound,
}


def expectations(rules: Iterable[Rule]) -> list[Expectation]:
    """The rules as columns."""
    out = []
    for rule in rules:
        value = F.expr(rule.column)
        if rule.kind == "one of":
            holds = value.isin(*rule.bound)
        else:
            holds = KINDS[rule.kind](value, F.expr(rule.bound) if isinstance(rule.bound, str) else F.lit(rule.bound))
        out.append(Expectation(rule.name, F.expr(rule.exempt) | holds if rule.exempt else holds))
    return out


class Validation(NamedTuple):
    passed: DataFrame
    failed: DataFrame


def with_violations(rows: DataFrame, suite: Iterable[Expectation], name: str = "violations") -> DataFrame:
    """Rows with the names of all expectations they break, in alphabetical order."""
    verdicts = F.create_map(*[x for e in sorted(suite, key=lambda e: e.name) for x in (F.lit(e.name), e.violated())])
    return rows.withColumn(name, F.map_keys(F.map_filter(verdicts, lambda _, broken: broken)))


def validate(rows: DataFrame, suite: Iterable[Expectation]) -> Validation:
    """Rows that meet all expectations, and the others with what they break."""
    judged, clean = with_violations(rows, suite), F.cardinality(F.col("violations")) == 0
    return Validation(passed=judged.where(clean).select(*rows.columns), failed=judged.where(~clean))


def violation_counts(failed: DataFrame) -> DataFrame:
    """(violation, row_count), the most frequent first."""
    each = failed.select(F.explode("violations").alias("violation"))
    return each.groupBy("violation").agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), "violation")


def run_gate(rows: DataFrame, suite: Iterable[Expectation], table: str) -> DataFrame:
    """One report row: total, passed, quarantined and status (1 if any row failed).  The table is not touched."""
    failed = reduce(lambda a, b: a | b, [e.violated() for e in suite])
    counts = rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(~failed).alias("passed_rows"), F.count_if(failed).alias("quarantined_rows"))
    return counts.select(F.lit(table).alias("table_name"), "*", F.when(F.col("quarantined_rows") > 0, 1).otherwise(0).alias("status"))


# Domains (fixed values).
ORDER_STATUSES = ("PLACED", "ACCEPTED", "PICKED_UP", "DELIVERED", "CANCELLED")
TRANSITIONS = (
    ("PLACED", "ACCEPTED"), ("PLACED", "CANCELLED"), ("ACCEPTED", "PICKED_UP"), ("ACCEPTED", "CANCELLED"),
    ("PICKED_UP", "DELIVERED"), ("PICKED_UP", "CANCELLED"),
)
#: Rules of an order's latest state.  That of a deleted order cannot be repaired any more.
ORDER_RULES = [
    *[Rule(f"{c}_present", c, "present") for c in ("order_id", "placed_ts")],
    Rule("status_is_known", "status", "one of", ORDER_STATUSES),
    Rule("rider_assigned_once_picked_up", "rider_id", "present", exempt="is_deleted OR status NOT IN ('PICKED_UP', 'DELIVERED')"),
    *[Rule(f"{c}_after_placed", f"{c}_ts", "at least", "placed_ts", exempt) for c, exempt in (("promised", None), ("delivered", "delivered_ts IS NULL"))],
    Rule("total_not_negative", "total_inr", "at least", 0),
    # amounts have two decimals: more than a cent off is wrong
    Rule("total_reconciles", "abs(subtotal_inr + delivery_fee_inr - discount_inr - total_inr)", "at most", 0.01),
]


def order_suite() -> list[Expectation]:
    return expectations(ORDER_RULES)


def scd2_suite(key: str) -> list[Expectation]:
    """Windows of a dimension: there, forward, and open exactly if current."""
    window = [
        Rule("window_is_forward", "valid_to", "more than", "valid_from", exempt="valid_to IS NULL"),
        Rule("current_is_open_ended", "is_current", "same as", False, exempt="valid_to IS NULL"),
        Rule("closed_is_not_current", "is_current", "same as", False, exempt="valid_to IS NULL"),
    ]
    return expectations([Rule("key_present", key, "present"), Rule("valid_from_present", "valid_from", "present"), *window])


#: Rules of a trip; a rider does not cross a country.
TRIP_RULES = [
    *[Rule(f"{c}_present", c, "present") for c in ("rider_id", "trip_id")],
    Rule("ends_after_it_starts", "ended_ts", "at least", "started_ts"),
    Rule("duration_not_negative", "duration_s", "at least", 0),
    Rule("distance_is_plausible", "straight_line_km", "less than", 500),
    Rule("avg_speed_within_max", "avg_speed_kmph", "at most", "max_speed_kmph"),
    Rule("has_pings", "ping_count", "more than", 0),
]


def trips_suite() -> list[Expectation]:
    return expectations(TRIP_RULES)


#: Rules of a position ping.
PING_RULES = [
    *[Rule(f"{c}_present", c, "present") for c in ("rider_id", "event_ts")],
    *[Rule(f"{c}_in_range", f"abs({c})", "at most", most) for c, most in (("lat", 90), ("lon", 180))],
    Rule("speed_not_negative", "speed_kmph", "at least", 0),
    Rule("heading_in_range", "heading_deg >= 0 AND heading_deg < 360", "same as", True),
]


def ping_suite() -> list[Expectation]:
    return expectations(PING_RULES)


#: Stamps of the lifecycle in order, and how many of them a status has earned (fixed values).
STAMPS = ("placed_ts", "accepted_ts", "picked_up_ts", "delivered_ts")
EARNED = {"PLACED": 1, "ACCEPTED": 2, "PICKED_UP": 3, "DELIVERED": 4}


def lifecycle_suite() -> list[Expectation]:
    """Stamps in order, those a status needs there, those it cannot have absent, and a reason exactly if cancelled."""
    c = F.col
    out = []
    for i, later in enumerate(STAMPS[1:], 1):
        before = F.greatest(*[c(s) for s in STAMPS[:i]]) if i > 1 else c(STAMPS[0])
        out.append(Expectation(f"{later}_in_order", c(later).isNull() | before.isNull() | (c(later) >= before)))
    depth = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in EARNED.items() for x in p]), c("status")), F.lit(0))
    for i, stamp in enumerate(STAMPS[1:], 2):
        out.append(Expectation(f"{stamp}_once_earned", (depth < i) | c(stamp).isNotNull()))
        out.append(Expectation(f"{stamp}_not_before", (c("status") == "CANCELLED") | (depth >= i) | c(stamp).isNull()))
    out.append(Expectation("reason_exactly_if_cancelled", (c("status") == "CANCELLED") == c("cancel_reason").isNotNull()))
    return out


def transition_check(changes: DataFrame, key: str = "order_id", status: str = "status", order: str = "lsn") -> DataFrame:
    """Changes whose status does not follow from the key's status before by an allowed step.
    A change that keeps the status is no step."""
    before = F.lag(status).over(Window.partitionBy(key).orderBy(order))
    rows = changes.withColumn("from_status", before)
    step = F.struct(F.col("from_status"), F.col(status))
    allowed = reduce(lambda a, b: a | b, [(step.getField("from_status") == a) & (step.getField(status) == b) for a, b in TRANSITIONS])
    return rows.where(F.col("from_status").isNotNull() & (F.col("from_status") != F.col(status)) & ~allowed)


#: Column domains of the source tables (fixed values).
DOMAINS: dict[str, dict[str, str]] = {
    "customers": {"tier_known": "tier IN ('STANDARD', 'PLUS', 'PRO')"},
    "restaurants": {
        "rating_in_range": "rating IS NULL OR rating BETWEEN 0 AND 5",
        "commission_in_range": "commission_pct BETWEEN 0 AND 100",
    },
    "menu_items": {"price_not_negative": "price_inr >= 0"},
    "riders": {"vehicle_known": "vehicle_type IN ('BIKE', 'SCOOTER', 'BICYCLE', 'CAR')", "tier_known": "tier IN ('BRONZE', 'SILVER', 'GOLD')"},
    "orders": {
        "status_known": "status IN ('PLACED', 'ACCEPTED', 'PICKED_UP', 'DELIVERED', 'CANCELLED')",
        "amounts_not_negative": "subtotal_inr >= 0 AND delivery_fee_inr >= 0 AND discount_inr >= 0 AND total_inr >= 0",
    },
    "order_items": {"qty_positive": "qty > 0", "unit_price_not_negative": "unit_price_inr >= 0"},
    "payments": {
        "method_known": "method IN ('UPI', 'CARD', 'NETBANKING', 'COD', 'WALLET')",
        "status_known": "status IN ('PENDING', 'AUTHORISED', 'CAPTURED', 'FAILED', 'REFUNDED')",
        "amount_not_negative": "amount_inr >= 0",
    },
}


def domain_suite(table: str) -> list[Expectation]:
    """The source table's own column rules as expectations."""
    return [Expectation(name, F.expr(rule)) for name, rule in DOMAINS[table].items()]
