"""Order exports, wide order tables and order counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    BILLING_FIELDS,
    CUSTOMER_KEY,
    DEFAULT_CREATED_VIA,
    DEFAULT_CURRENCY,
    DEFAULT_VERSION,
    EMAIL_KEY,
    ENTITY_LABELS,
    ORDER_TYPE,
    SHIPPING_FIELDS,
    TOTAL_KEY,
)
from ..functions import (
    default_order_key,
    from_unixtime,
    strip_status_all,
    to_decimal,
    to_unsigned,
    true_flag,
    yes_flag,
)
from .counting import counted, labelled_counts
from .eav import core_values, pivot_addresses, pivot_first, pivot_operational
from .filters import is_order, order_ids, orders_only
from .keysets import only_keys, without_keys

# --- exports ---------------------------------------------------------------------------


def export_orders(posts: DataFrame) -> DataFrame:
    return orders_only(posts)


def export_order_meta(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    return only_keys(postmeta, order_ids(posts, "post_id"), "post_id")


def export_order_items(items: DataFrame, posts: DataFrame) -> DataFrame:
    return only_keys(items, order_ids(posts, "order_id"), "order_id")


def export_order_itemmeta(itemmeta: DataFrame, items: DataFrame, posts: DataFrame) -> DataFrame:
    return only_keys(itemmeta, export_order_items(items, posts), "order_item_id")


def copy_order_meta(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Metadata rows of the orders, under the order's name."""
    return export_order_meta(postmeta, posts).select(
        F.col("post_id").alias("order_id"), "meta_key", "meta_value"
    )


# --- wide tables -----------------------------------------------------------------------


def _or_blank(name: str) -> Column:
    return F.coalesce(name, F.lit("")).alias(name)


def orders_left_pivot(orders: DataFrame, pivot: DataFrame) -> DataFrame:
    """Orders with their pivoted columns; an order without metadata keeps nulls."""
    return orders.join(pivot.withColumnRenamed("post_id", "id"), "id", "left")


def orders_wide(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """The typed order table, 17 columns."""
    orders = orders_only(posts).select(
        "id", "post_status", "post_date_gmt", "post_modified_gmt", "post_parent", "post_excerpt"
    )
    return orders_left_pivot(orders, core_values(postmeta)).select(
        "id",
        strip_status_all(F.col("post_status")).alias("status"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.lit(ORDER_TYPE).alias("type"),
        to_decimal(F.col("tax")).alias("tax_amount"),
        to_decimal(F.col("total")).alias("total_amount"),
        to_unsigned(F.col("customer_id")).alias("customer_id"),
        _or_blank("billing_email"),
        F.col("post_date_gmt").alias("date_created_gmt"),
        F.col("post_modified_gmt").alias("date_updated_gmt"),
        F.col("post_parent").alias("parent_order_id"),
        _or_blank("payment_method"),
        _or_blank("payment_method_title"),
        _or_blank("transaction_id"),
        F.col("post_excerpt").alias("customer_note"),
        _or_blank("ip_address"),
        _or_blank("user_agent"),
    )


def orders_wide_light(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """The nine-column variant: fixed currency, the author as customer, first values."""
    first = pivot_first(postmeta, {"total": TOTAL_KEY, "billing_email": EMAIL_KEY})
    orders = orders_only(posts).select(
        "id", "post_status", "post_author", "post_date_gmt", "post_modified_gmt"
    )
    return orders_left_pivot(orders, first).select(
        "id",
        strip_status_all(F.col("post_status")).alias("status"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        F.lit(ORDER_TYPE).alias("type"),
        F.col("post_author").alias("customer_id"),
        F.col("post_date_gmt").alias("date_created_gmt"),
        F.col("post_modified_gmt").alias("date_updated_gmt"),
        to_decimal(F.col("total")).alias("total_amount"),
        _or_blank("billing_email"),
    )


def _addresses(pivot: DataFrame, kind: str) -> DataFrame:
    return pivot.select(
        F.col("post_id").alias("order_id"),
        F.lit(kind).alias("address_type"),
        *(
            _or_blank(field) if field in pivot.columns else F.lit("").alias(field)
            for field in BILLING_FIELDS
        ),
    )


def append_addresses(billing: DataFrame, shipping: DataFrame) -> DataFrame:
    """Billing and shipping pivots as rows of one table; absent fields are blank."""
    return _addresses(billing, "billing").unionByName(_addresses(shipping, "shipping"))


def order_addresses(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Billing and shipping address of each order as rows of one table, from one pass over metadata."""

    def address(side: str, fields) -> Column:
        parts = [
            F.coalesce(f"{side}_{field}", F.lit("")) if field in fields else F.lit("")
            for field in BILLING_FIELDS
        ]
        row = F.struct(
            F.lit(side).alias("address_type"),
            *(part.alias(field) for part, field in zip(parts, BILLING_FIELDS, strict=True)),
        )
        return F.when(F.col(f"has_{side}"), row)

    both = F.array(address("billing", BILLING_FIELDS), address("shipping", SHIPPING_FIELDS))
    return pivot_addresses(postmeta, posts).select(
        F.col("post_id").alias("order_id"), F.inline(F.array_compact(both))
    )


def order_operational(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Typed operational columns for each order that has metadata."""
    return pivot_operational(postmeta, posts).select(
        F.col("post_id").alias("order_id"),
        F.coalesce("created_via", F.lit(DEFAULT_CREATED_VIA)).alias("created_via"),
        F.coalesce("version", F.lit(DEFAULT_VERSION)).alias("woocommerce_version"),
        yes_flag(F.col("prices_include_tax")).alias("prices_include_tax"),
        yes_flag(F.col("coupons_counted")).alias("coupon_usages_are_counted"),
        yes_flag(F.col("downloads_granted")).alias("download_permission_granted"),
        _or_blank("cart_hash"),
        true_flag(F.col("email_sent")).alias("new_order_email_sent"),
        default_order_key(F.col("order_key"), F.col("post_id")).alias("order_key"),
        yes_flag(F.col("stock_reduced")).alias("order_stock_reduced"),
        from_unixtime(F.col("date_paid")).alias("date_paid_gmt"),
        from_unixtime(F.col("date_completed")).alias("date_completed_gmt"),
        to_decimal(F.col("shipping_tax")).alias("shipping_tax_amount"),
        to_decimal(F.col("shipping_total")).alias("shipping_total_amount"),
        to_decimal(F.col("discount_tax")).alias("discount_tax_amount"),
        to_decimal(F.col("discount_total")).alias("discount_total_amount"),
        yes_flag(F.col("recorded_sales")).alias("recorded_sales"),
    )


# --- counts and integrity --------------------------------------------------------------


def rows_per_post(postmeta: DataFrame) -> DataFrame:
    """Row count per post: what the counts below join instead of the rows themselves."""
    return postmeta.groupBy("post_id").agg(F.count("*").alias("n"))


def orphaned_meta(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Metadata rows whose post does not exist, whatever its type."""
    known = posts.select(F.col("id").alias("post_id"))
    return postmeta.join(known, "post_id", "left_anti").select(*postmeta.columns)


def orphaned_meta_count(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    known = posts.select(F.col("id").alias("post_id"))
    orphans = rows_per_post(postmeta).join(known, "post_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def orders_without_customer(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """Rows of the left join of orders to their customer key that hold no value, counted.

    An order without the key counts once; an order with null values counts once for each.
    """
    named = (
        postmeta.where(F.col("meta_key") == CUSTOMER_KEY)
        .groupBy("post_id")
        .agg(F.count_if(F.col("meta_value").isNull()).alias("blanks"))
    )
    joined = order_ids(posts, "post_id").join(named, "post_id", "left")
    return joined.agg(F.coalesce(F.sum(F.coalesce("blanks", F.lit(1))), F.lit(0)).alias("n"))


def integrity_counts(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """Both integrity counts in one row, from one pass over each table.

    Metadata shrinks to a row per post before it meets the posts, so a post with very many rows
    is no hot key in the full join, and both sides hold each key once.
    """
    is_customer = F.col("meta_key") == CUSTOMER_KEY
    per_post = postmeta.groupBy(F.col("post_id").alias("id")).agg(
        F.count("*").alias("n"),
        F.count_if(is_customer).alias("named"),
        F.count_if(is_customer & F.col("meta_value").isNull()).alias("blanks"),
    )
    known = posts.select("id", F.coalesce(is_order(), F.lit(False)).alias("is_order"))
    unnamed = F.when(F.coalesce("named", F.lit(0)) == 0, 1).otherwise(F.col("blanks"))
    return known.join(per_post, "id", "full").agg(
        F.coalesce(F.sum(F.when(F.col("is_order").isNull(), F.col("n"))), F.lit(0)).alias(
            "orphaned_meta"
        ),
        F.coalesce(F.sum(F.when(F.col("is_order"), unnamed)), F.lit(0)).alias(
            "orders_without_customer"
        ),
    )


def order_and_meta_counts(posts: DataFrame, postmeta: DataFrame) -> DataFrame:
    """One row: orders, and metadata rows of orders."""
    joined = order_ids(posts, "post_id").join(rows_per_post(postmeta), "post_id", "left")
    return joined.agg(
        F.count("*").alias("orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("order_meta")
    )


def order_meta_joined_count(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    of_orders = rows_per_post(postmeta).join(order_ids(posts, "post_id"), "post_id", "left_semi")
    return of_orders.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def table_counts(
    posts: DataFrame, postmeta: DataFrame, items: DataFrame, itemmeta: DataFrame
) -> DataFrame:
    """(table_name, n): orders, their metadata, and all items and item metadata."""
    pair = order_and_meta_counts(posts, postmeta)
    of_orders = pair.unpivot([], ["orders", "order_meta"], "table_name", "n")
    rest = {"order_items": counted(items), "order_itemmeta": counted(itemmeta)}
    return of_orders.unionByName(labelled_counts(rest, label="table_name"))


def entity_counts_report(posts: DataFrame, wc_orders: DataFrame, users: DataFrame) -> DataFrame:
    """(entity, n): orders in the post table, orders in the wide table, users."""
    counts = [counted(orders_only(posts)), counted(wc_orders), counted(users)]
    return labelled_counts(dict(zip(ENTITY_LABELS, counts, strict=True)), label="entity")


# --- deletion --------------------------------------------------------------------------


def posts_without_orders(posts: DataFrame) -> DataFrame:
    return posts.where(~F.coalesce(F.col("post_type") == ORDER_TYPE, F.lit(False)))


def meta_without_orders(postmeta: DataFrame, posts: DataFrame) -> DataFrame:
    """Metadata that belongs to no order."""
    return without_keys(postmeta, order_ids(posts, "post_id"), "post_id")
