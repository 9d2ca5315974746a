"""Key/value metadata into columns.

Every pivot here filters to its own keys first, takes the maximum per key before the shuffle
(so a post with very many rows sends one row per task) and shuffles once on ``post_id``. The
join with the orders then needs no further shuffle of the metadata.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    BILLING_FIELDS,
    BILLING_PATTERN,
    CORE_KEYS,
    OPERATIONAL_KEYS,
    SHIPPING_FIELDS,
    SHIPPING_PATTERN,
)
from .filters import meta_by_prefix, meta_of_keys, order_ids


def pivot_max(postmeta: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row per post; each column holds the largest text found under its key."""
    return postmeta.groupBy("post_id").agg(
        *(F.max(_value_of(key)).alias(column) for column, key in columns.items())
    )


def pivot_first(postmeta: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row per post with any of the keys; each column holds the value with the lowest meta_id."""
    return (
        meta_of_keys(postmeta, columns.values())
        .groupBy("post_id")
        .agg(
            *(
                F.min_by("meta_value", F.when(F.col("meta_key") == key, F.col("meta_id"))).alias(column)
                for column, key in columns.items()
            )
        )
    )


def first_meta(entities: DataFrame, postmeta: DataFrame, key: str, default: str) -> DataFrame:
    """Each entity id with the first value of one key, or the default."""
    first = pivot_first(postmeta, {"value": key})
    return (
        entities.select("id")
        .join(first.withColumnRenamed("post_id", "id"), "id", "left")
        .select("id", F.coalesce("value", F.lit(default)).alias("value"))
    )


def _value_of(key: str) -> Column:
    return F.when(F.col("meta_key") == key, F.col("meta_value"))


def _of_orders(per_post: DataFrame, posts: DataFrame) -> DataFrame:
    return per_post.join(order_ids(posts, "post_id"), "post_id", "left_semi")


def _pivot_every_post(postmeta: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``pivot_max`` with a row for each post that has metadata of any key, in one scan.

    Rows of other keys count for their post alone; their key and value are dropped before anything
    is sorted or shuffled.
    """
    wanted = F.col("meta_key").isin(list(columns.values()))
    narrow = (F.when(wanted, F.col(c)).alias(c) for c in ("meta_key", "meta_value"))
    return pivot_max(postmeta.select("post_id", *narrow), columns)


def pivot_addresses(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Billing and shipping columns of each order that has a key of either pattern, from one scan and
    one aggregate; ``has_billing`` and ``has_shipping`` tell which of the two it has."""
    sides = {
        "billing": (BILLING_PATTERN, BILLING_FIELDS),
        "shipping": (SHIPPING_PATTERN, SHIPPING_FIELDS),
    }
    matches = {side: F.col("meta_key").like(pattern) for side, (pattern, _) in sides.items()}
    per_post = postmeta.where(matches["billing"] | matches["shipping"]).groupBy("post_id").agg(
        *(
            F.max(_value_of(f"_{side}_{field}")).alias(f"{side}_{field}")
            for side, (_, fields) in sides.items()
            for field in fields
        ),
        *(F.bool_or(match).alias(f"has_{side}") for side, match in matches.items()),
    )
    return _of_orders(per_post, posts)


def core_values(postmeta: DataFrame) -> DataFrame:
    """Core columns of the posts that have any core key."""
    return pivot_max(meta_of_keys(postmeta, CORE_KEYS.values()), CORE_KEYS)


def pivot_order_core(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Ten core columns for each order that has metadata."""
    return _of_orders(_pivot_every_post(postmeta, CORE_KEYS), posts)


def pivot_billing(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Billing columns for each order with a key of the billing pattern."""
    keys = {field: f"_billing_{field}" for field in BILLING_FIELDS}
    return _of_orders(pivot_max(meta_by_prefix(postmeta, BILLING_PATTERN), keys), posts)


def pivot_shipping(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Shipping columns for each order with a key of the shipping pattern."""
    keys = {field: f"_shipping_{field}" for field in SHIPPING_FIELDS}
    return _of_orders(pivot_max(meta_by_prefix(postmeta, SHIPPING_PATTERN), keys), posts)


def pivot_operational(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Sixteen operational columns for each order that has metadata."""
    return _of_orders(_pivot_every_post(postmeta, OPERATIONAL_KEYS), posts)
