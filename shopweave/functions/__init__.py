"""Column functions: each takes columns and returns a column."""

from .coerce import (
    default_order_key,
    from_unixtime,
    int_pct,
    round_pct,
    to_decimal,
    to_unsigned,
    true_flag,
    yes_flag,
)
from .text import (
    clean_text,
    image_url,
    now_stamp,
    price_fallback,
    product_type,
    strip_status_all,
    strip_status_prefix,
    strip_status_substr,
)

__all__ = [
    "clean_text",
    "default_order_key",
    "from_unixtime",
    "image_url",
    "int_pct",
    "now_stamp",
    "price_fallback",
    "product_type",
    "round_pct",
    "strip_status_all",
    "strip_status_prefix",
    "strip_status_substr",
    "to_decimal",
    "to_unsigned",
    "true_flag",
    "yes_flag",
]
