"""Column layouts shared by the batch and the streaming side."""

from __future__ import annotations

# The lifecycle event types, in lifecycle order.
EVENT_TYPES = (
    "order_created",
    "kitchen_started",
    "kitchen_finished",
    "order_ready",
    "driver_arrived",
    "driver_picked_up",
    "driver_ping",
    "delivered",
)

# Output column of the lifecycle table -> the event it comes from.
MILESTONES = {
    "created_at": "order_created",
    "kitchen_started_at": "kitchen_started",
    "kitchen_finished_at": "kitchen_finished",
    "order_ready_at": "order_ready",
    "driver_arrived_at": "driver_arrived",
    "pickup_at": "driver_picked_up",
    "delivered_at": "delivered",
}

# Duration column -> (later milestone, earlier milestone).
DURATIONS = {
    "kitchen_duration_min": ("kitchen_finished_at", "kitchen_started_at"),
    "delivery_duration_min": ("delivered_at", "pickup_at"),
    "total_duration_min": ("delivered_at", "created_at"),
}

# Fields of an order event, as parquet columns or message payload.
EVENT_FIELDS = (
    "event_id string, event_type string, ts string, ts_seconds int, "
    "order_id string, location_id int, sequence int, body string"
)

# A click/purchase message and an order message of the stream jobs.
CLICK_FIELDS = (
    "event_id int, timestamp string, user_id string, event_type string, "
    "product string, price double, quantity int"
)
SALE_FIELDS = (
    "event_id string, event_type string, timestamp string, order_id string, "
    "customer_id string, product_id string, product_name string, "
    "quantity int, unit_price double, total double"
)
CREATED_FIELDS = (
    "event_id string, event_type string, order_id string, location_id int, ts string"
)


def body_fields(money: str = "double") -> dict[str, str]:
    """Keys of the event body and their types; `money` is the type of the total.

    With a decimal type sums do not depend on the order rows arrive in.
    Fixed values: the JSON keys, `lng` included.
    """
    return {
        "brand_id": "int",
        "item_ids": "string",
        "total": money,
        "lat": "double",
        "lng": "double",
        "driver_id": "string",
    }


# Body key -> column of the enriched events.
BODY_COLUMNS = {
    "brand_id": "brand_id",
    "total": "order_total",
    "lat": "latitude",
    "lng": "longitude",
    "driver_id": "driver_id",
}
