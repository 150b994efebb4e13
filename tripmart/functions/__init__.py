"""Scalar column helpers."""

from tripmart.functions.columns import (
    constant,
    month_label,
    month_start,
    payment_type_description,
    pickup_date,
    service_zone_label,
    surrogate_key,
    to_integer,
    to_numeric,
    to_wall_clock,
    utc_wall_clock,
)

__all__ = [
    "constant",
    "month_label",
    "month_start",
    "payment_type_description",
    "pickup_date",
    "service_zone_label",
    "surrogate_key",
    "to_integer",
    "to_numeric",
    "to_wall_clock",
    "utc_wall_clock",
]
