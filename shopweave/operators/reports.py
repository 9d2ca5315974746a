"""Validation and reconciliation: one row of counts and a verdict each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    EMAIL_KEY,
    FULL_PERCENT,
    MAX_ORDERS_WITHOUT_CUSTOMER,
    MIN_USERS,
    PARTIAL_PERCENT,
    STATUS_KEY,
    TOTAL_KEY,
)
from ..functions import int_pct
from .counting import count_row, counted, with_counts
from .filters import meta_of_keys, orders_only
from .orders import integrity_counts, order_and_meta_counts


def user_validation(src_users: DataFrame, dst_users: DataFrame, dst_usermeta: DataFrame) -> DataFrame:
    counts = count_row(
        {
            "source_users": counted(src_users),
            "destination_users": counted(dst_users),
            "destination_usermeta": counted(dst_usermeta),
        }
    )
    enough = F.col("destination_users") >= MIN_USERS
    return counts.withColumn("result", F.when(enough, "success").otherwise("low"))


def order_validation(
    src_posts: DataFrame, dst_posts: DataFrame, dst_postmeta: DataFrame, dst_items: DataFrame
) -> DataFrame:
    pair = order_and_meta_counts(dst_posts, dst_postmeta).select(
        F.col("orders").alias("destination_orders"),
        F.col("order_meta").alias("destination_order_meta"),
    )
    counts = with_counts(
        pair,
        {
            "source_orders": counted(orders_only(src_posts)),
            "destination_order_items": counted(dst_items),
        },
    )
    percent = F.col("percent")
    return counts.withColumn(
        "percent", int_pct(F.col("destination_orders"), F.col("source_orders"))
    ).withColumn(
        "level",
        F.when(percent.isNull(), "no_source")
        .when(percent >= FULL_PERCENT, "success")
        .when(percent >= PARTIAL_PERCENT, "partial")
        .otherwise("low"),
    )


def critical_meta_counts(postmeta: DataFrame) -> DataFrame:
    """Rows, not distinct orders, of the three critical keys in one pass."""
    key = F.col("meta_key")
    return meta_of_keys(postmeta, [TOTAL_KEY, EMAIL_KEY, STATUS_KEY]).agg(
        F.count_if(key == TOTAL_KEY).alias("totals"),
        F.count_if(key == EMAIL_KEY).alias("emails"),
        F.count_if(key == STATUS_KEY).alias("statuses"),
    )


def meta_validation(postmeta: DataFrame) -> DataFrame:
    working = (F.col("totals") > 0) & (F.col("emails") > 0)
    return critical_meta_counts(postmeta).withColumn(
        "result", F.when(working, "functional").otherwise("needs_attention")
    )


def integrity_check(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    counts = integrity_counts(posts, postmeta)
    good = (F.col("orphaned_meta") == 0) & (
        F.col("orders_without_customer") < MAX_ORDERS_WITHOUT_CUSTOMER
    )
    return counts.withColumn("result", F.when(good, "good").otherwise("issues"))


def wide_reconciliation(posts: DataFrame, wc_orders: DataFrame) -> DataFrame:
    counts = count_row(
        {"traditional_orders": counted(orders_only(posts)), "wide_orders": counted(wc_orders)}
    )
    wide = F.col("wide_orders")
    complete = (wide == F.col("traditional_orders")) & (wide > 0)
    return counts.withColumn("result", F.when(complete, "complete").otherwise("differs"))


def import_reconciliation(src_posts: DataFrame, dst_posts: DataFrame) -> DataFrame:
    counts = count_row(
        {"imported": counted(orders_only(dst_posts)), "expected": counted(orders_only(src_posts))}
    )
    same = F.col("imported") == F.col("expected")
    return counts.withColumn("result", F.when(same, "complete").otherwise("mismatch"))
