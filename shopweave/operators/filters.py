"""Row filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    ACCEPTED_STATUSES,
    ANY_TRANSIENT_PATTERN,
    CUSTOM_STATUSES,
    CUSTOMER_KEY,
    GUEST,
    IN_STOCK,
    ORDER_TYPE,
    OUT_OF_STOCK,
    PRODUCT_TYPE,
    PUBLISHED,
    STANDARD_STATUSES,
    STOCK_KEY,
    TRANSIENT_PATTERNS,
)


def is_order() -> Column:
    return F.col("post_type") == ORDER_TYPE


def orders_only(posts: DataFrame) -> DataFrame:
    return posts.where(is_order())


def order_ids(posts: DataFrame, name: str = "id") -> DataFrame:
    """Ids of the orders, under the column name a join needs."""
    return orders_only(posts).select(F.col("id").alias(name))


def published_products(posts: DataFrame) -> DataFrame:
    return posts.where((F.col("post_type") == PRODUCT_TYPE) & (F.col("post_status") == PUBLISHED))


def custom_status_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("post_status").isin(CUSTOM_STATUSES))


def nonstandard_status_orders(orders: DataFrame) -> DataFrame:
    return orders.where(~F.col("post_status").isin(ACCEPTED_STATUSES))


def standard_status_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("post_status").isin(STANDARD_STATUSES))


def meta_by_prefix(postmeta: DataFrame, pattern: str) -> DataFrame:
    """Rows whose key matches a LIKE pattern; ``_`` stands for any one character."""
    return postmeta.where(F.col("meta_key").like(pattern))


def meta_of_keys(postmeta: DataFrame, keys) -> DataFrame:
    """Rows of the given keys; the list reaches the scan as a pushed filter."""
    return postmeta.where(F.col("meta_key").isin(list(keys)))


def non_guest_meta(postmeta: DataFrame) -> DataFrame:
    return postmeta.where((F.col("meta_key") == CUSTOMER_KEY) & (F.col("meta_value") != GUEST))


def stock_flags(postmeta: DataFrame) -> DataFrame:
    """Per post: whether it has an out-of-stock row and whether it has an in-stock row."""
    value = F.col("meta_value")
    return (
        postmeta.where((F.col("meta_key") == STOCK_KEY) & value.isin(OUT_OF_STOCK, IN_STOCK))
        .groupBy("post_id")
        .agg(
            F.bool_or(value == OUT_OF_STOCK).alias("has_out"),
            F.bool_or(value == IN_STOCK).alias("has_in"),
        )
    )


def without_blocked(products: DataFrame, postmeta: DataFrame) -> DataFrame:
    """Drop products that are out of stock and not in stock as well.

    One aggregate over the stock rows answers both existence questions, and leaves one row per
    product to join.
    """
    blocked = (
        stock_flags(postmeta).where("has_out AND NOT has_in").select(F.col("post_id").alias("id"))
    )
    return products.join(blocked, "id", "left_anti")


def in_stock_products(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """Products that pass the stock filter; one without a stock row, or on backorder, passes."""
    return without_blocked(posts.where(F.col("post_type") == PRODUCT_TYPE), postmeta)


def purge_transients(options: DataFrame) -> DataFrame:
    return _without(options, TRANSIENT_PATTERNS)


def purge_transients_any(options: DataFrame) -> DataFrame:
    return _without(options, [ANY_TRANSIENT_PATTERN])


def _without(options: DataFrame, patterns: list[str]) -> DataFrame:
    for pattern in patterns:
        # a row without a name matches no pattern, and stays
        options = options.where(~F.coalesce(F.col("option_name").like(pattern), F.lit(False)))
    return options


def distinct_statuses(orders: DataFrame) -> DataFrame:
    return orders.select("post_status").distinct()
