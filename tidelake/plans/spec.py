"""What the operators need to know of an entity, and the delivery marketplace's entities."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EntitySpec:
    """One source table.  payload: DDL of its JSON; tracked: attributes whose change opens a
    new version; timestamps: payload fields that hold ISO-8601 texts."""

    table: str
    key: str
    payload: str
    tracked: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ("updated_at",)

    @property
    def types(self) -> dict[str, str]:
        return dict(f.split(None, 1) for f in _split(self.payload))

    @property
    def fields(self) -> list[str]:
        return list(self.types)


def _split(ddl: str) -> list[str]:
    """Fields of a DDL; commas in parentheses do not separate."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(ddl[at:i].strip())
            at = i + 1
    return [*out, ddl[at:].strip()]


# Payload shapes (fixed values: they must equal what the sources write).
ORDERS = EntitySpec(
    "orders",
    "order_id",
    "order_id bigint, customer_id bigint, restaurant_id bigint, rider_id bigint, status string, placed_ts string,"
    " accepted_ts string, picked_up_ts string, delivered_ts string, promised_ts string, cancel_reason string,"
    " subtotal_inr decimal(10,2), delivery_fee_inr decimal(10,2), discount_inr decimal(10,2), total_inr decimal(10,2),"
    " payment_id bigint, updated_at string",
    timestamps=("placed_ts", "accepted_ts", "picked_up_ts", "delivered_ts", "promised_ts", "updated_at"),
)
RESTAURANTS = EntitySpec(
    "restaurants",
    "restaurant_id",
    "restaurant_id bigint, name string, city string, lat decimal(9,6), lon decimal(9,6), cuisine string,"
    " rating decimal(2,1), commission_pct decimal(5,2), is_open boolean, updated_at string",
    ("name", "city", "lat", "lon", "cuisine", "rating", "commission_pct", "is_open"),
)
RIDERS = EntitySpec(
    "riders",
    "rider_id",
    "rider_id bigint, name string, city string, vehicle_type string, tier string, shift_start string, is_online boolean, updated_at string",
    ("name", "city", "vehicle_type", "tier", "shift_start", "is_online"),
)
MENU_ITEMS = EntitySpec(
    "menu_items",
    "menu_item_id",
    "menu_item_id bigint, restaurant_id bigint, name string, price_inr decimal(10,2), is_available boolean, updated_at string",
    ("restaurant_id", "name", "price_inr", "is_available"),
)
CUSTOMERS = EntitySpec(
    "customers",
    "customer_id",
    "customer_id bigint, name string, phone string, city string, signup_ts string, tier string, is_active boolean, updated_at string",
    timestamps=("signup_ts", "updated_at"),
)
ORDER_ITEMS = EntitySpec(
    "order_items",
    "order_item_id",
    "order_item_id bigint, order_id bigint, menu_item_id bigint, qty int, unit_price_inr decimal(10,2), updated_at string",
)
PAYMENTS = EntitySpec(
    "payments",
    "payment_id",
    "payment_id bigint, order_id bigint, method string, status string, amount_inr decimal(10,2), gateway_ref string, updated_at string",
)
ENTITIES = {e.table: e for e in (ORDERS, RESTAURANTS, RIDERS, MENU_ITEMS, CUSTOMERS, ORDER_ITEMS, PAYMENTS)}
