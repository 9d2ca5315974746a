"""Customers that the destination lacks, and their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CUSTOMER_KEY, PREFIXED_USER_KEYS, PREVIEW_ROWS
from ..functions import to_unsigned
from .counting import counted, with_counts
from .filters import non_guest_meta, order_ids


def customers_with_orders(users: DataFrame, postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Distinct ids of users that placed an order.

    Guests (id 0) leave before any shuffle. One customer may own a third of the orders, and one
    order may hold a third of the rows: pairs, and then customer ids, are made distinct with
    partial results per task before each join, so no join sees more than one copy of a row.
    """
    owned = (
        postmeta.where(F.col("meta_key") == CUSTOMER_KEY)
        .select("post_id", to_unsigned(F.col("meta_value")).alias("id"))
        .where("id <> 0")
        .distinct()
        .join(order_ids(posts, "post_id"), "post_id", "left_semi")
    )
    return owned.select("id").distinct().join(users.select("id"), "id", "left_semi")


def missing_customers(customers: DataFrame, dst_users: DataFrame) -> DataFrame:
    return customers.join(dst_users.select("id"), "id", "left_anti")


def existing_customers(customers: DataFrame, dst_users: DataFrame) -> DataFrame:
    return customers.join(dst_users.select("id"), "id", "left_semi")


def missing_preview(missing: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first missing ids, for a report."""
    return missing.orderBy("id").limit(n)


def export_users(users: DataFrame, ids: DataFrame) -> DataFrame:
    return users.join(ids, "id", "left_semi").select(*users.columns)


def export_usermeta(usermeta: DataFrame, ids: DataFrame) -> DataFrame:
    owners = ids.select(F.col("id").alias("user_id"))
    return usermeta.join(owners, "user_id", "left_semi").select(*usermeta.columns)


def rename_prefixed_meta_keys(usermeta: DataFrame, old: str, new: str) -> DataFrame:
    """The two keys that carry a table prefix change it; values are left alone."""
    key = F.col("meta_key")
    renamed = [F.when(key == f"{old}{name}", f"{new}{name}") for name in PREFIXED_USER_KEYS]
    return usermeta.withColumn("meta_key", F.coalesce(*renamed, key))


def distinct_customer_count(postmeta: DataFrame) -> DataFrame:
    """How many different customer values the orders name, guests left out."""
    return non_guest_meta(postmeta).agg(F.count_distinct("meta_value").alias("n"))


def customer_import_stats(missing: DataFrame, dst_users: DataFrame, postmeta: DataFrame) -> DataFrame:
    """One row: how many were missing, how many of them are there now, and the new totals."""
    present = dst_users.select("id", F.lit(1).alias("found"))
    row = missing.join(present, "id", "left").agg(
        F.count("*").alias("missing_customers"), F.count("found").alias("imported_customers")
    )
    return with_counts(
        row,
        {
            "total_users": counted(dst_users),
            "customers_with_orders": distinct_customer_count(postmeta),
        },
    )
