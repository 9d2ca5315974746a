"""Order status profiles, conversion, backup and synchronisation."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    ACCEPTED_STATUSES,
    BARE_STATUS_MAP,
    PROFILED_STATUSES,
    STATUS_KEY,
    STATUS_MAP,
)
from ..functions import now_stamp, round_pct, strip_status_prefix
from .filters import is_order, orders_only
from .merge import insert_ignore

# --- profiles --------------------------------------------------------------------------


def status_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("post_status").agg(F.count("*").alias("n"))


def status_distribution_sorted(orders: DataFrame) -> DataFrame:
    """Most frequent first; ties by status."""
    return status_distribution(orders).orderBy(F.desc("n"), "post_status")


def status_distribution_pct(orders: DataFrame) -> DataFrame:
    """Counts with their share of all orders, from the counts already made."""
    counts = status_distribution(orders)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("percentage", round_pct(F.col("n"), total))


def per_status_counts(orders: DataFrame) -> DataFrame:
    """One row, one exact count for each profiled status, in one pass."""
    status = F.col("post_status")
    return orders.agg(
        *(F.count_if(status == value).alias(name) for name, value in PROFILED_STATUSES.items())
    )


def conversion_metrics(status: Column) -> dict[str, Column]:
    """Aggregates: the orders that each conversion would change, and in total."""
    converted = {name: value for name, value in PROFILED_STATUSES.items() if value in STATUS_MAP}
    metrics = {name: F.count_if(status == value) for name, value in converted.items()}
    return metrics | {"total": F.count_if(status.isin(list(STATUS_MAP)))}


def conversion_counts(orders: DataFrame) -> DataFrame:
    """How many orders each conversion would change, and in total."""
    metrics = conversion_metrics(F.col("post_status"))
    return orders.agg(*(metric.alias(name) for name, metric in metrics.items()))


def leftover(status: Column) -> Column:
    """Aggregate: orders whose status is none of those accepted after a conversion."""
    return F.count_if(~status.isin(ACCEPTED_STATUSES))


def status_metrics(status: Column, of: Column | None = None) -> dict[str, Column]:
    """Aggregates: orders of each status that has a name here, of all others together, and of all.

    ``of``: which rows are orders, where other rows are among them.
    """
    order = F.lit(True) if of is None else of
    known = list(dict.fromkeys([*ACCEPTED_STATUSES, *STATUS_MAP]))
    metrics = {value: F.count_if(order & (status == value)) for value in known}
    other = ~F.coalesce(status, F.lit("")).isin(known)
    return metrics | {"other": F.count_if(order & other), "total": F.count_if(order)}


# --- conversion ------------------------------------------------------------------------


def mapped(status: Column, mapping: Mapping[str, str]) -> Column:
    """The status the mapping gives, or the status itself. A literal map: no join, no shuffle."""
    table = F.create_map(*(F.lit(word) for word in chain(*mapping.items())))
    return F.coalesce(table[status], status)


def convert_statuses(posts: DataFrame) -> DataFrame:
    """Custom statuses of orders become standard ones; other posts stay as they are."""
    status = F.col("post_status")
    return posts.withColumn(
        "post_status", F.when(is_order(), mapped(status, STATUS_MAP)).otherwise(status)
    )


def convert_statuses_wide(wc_orders: DataFrame) -> DataFrame:
    return wc_orders.withColumn("status", mapped(F.col("status"), BARE_STATUS_MAP))


def convert_statuses_meta(postmeta: DataFrame) -> DataFrame:
    value = F.col("meta_value")
    return postmeta.withColumn(
        "meta_value",
        F.when(F.col("meta_key") == STATUS_KEY, mapped(value, BARE_STATUS_MAP)).otherwise(value),
    )


def backup_statuses(backup: DataFrame | None, posts: DataFrame, now: datetime) -> DataFrame:
    """Remember the status of each order; a status saved earlier is kept."""
    current = orders_only(posts).select(
        F.col("id").alias("order_id"),
        F.col("post_status").alias("original_status"),
        now_stamp(now).alias("backup_date"),
    )
    return current if backup is None else insert_ignore(backup, current, "order_id", unique=True)


# --- synchronisation -------------------------------------------------------------------


def orders_by_id(posts: DataFrame) -> DataFrame:
    """The status feed: (id, status) of every order, by id."""
    return orders_only(posts).select("id", F.col("post_status").alias("status")).orderBy("id")


#: Columns by which the lines of a feed are ordered, where it has them.
LINE_ORDER = ["file", "block", "place"]


def _feed(feed: DataFrame) -> DataFrame:
    """One status per id, so that the joins below cannot multiply orders.

    Of a feed that knows the order of its lines the last line of an id counts, as one update after
    another would have it; else the largest status does.
    """
    status = F.coalesce("status", F.lit(""))
    if set(LINE_ORDER) <= set(feed.columns):
        last = F.max(F.struct(*LINE_ORDER, status.alias("status")))
        return feed.groupBy("id").agg(last.alias("last")).select("id", F.col("last.status").alias("feed_status"))
    return feed.groupBy("id").agg(F.max(status).alias("feed_status"))


def sync_statuses_exact(
    dst_posts: DataFrame,
    feed: DataFrame,
    now: datetime,
    watch: Callable[[DataFrame], DataFrame] = lambda orders: orders,
) -> DataFrame:
    """Orders take the status of the feed and a new modification time; the rest is unchanged.

    Only orders are joined. Other posts, which carry the long texts, are not shuffled. ``watch`` may put
    metrics on the orders while they have both states: post_status, and feed_status or null.
    """
    found = F.col("feed_status").isNotNull()
    orders = (
        watch(orders_only(dst_posts).join(_feed(feed), "id", "left"))
        .withColumn("post_status", F.coalesce("feed_status", "post_status"))
        .withColumns(
            {
                c: F.when(found, now_stamp(now)).otherwise(F.col(c))
                for c in ("post_modified", "post_modified_gmt")
            }
        )
    )
    others = dst_posts.where(~F.coalesce(is_order(), F.lit(False)))
    return others.unionByName(orders.select(*dst_posts.columns))


def sync_statuses_wide(
    wc_orders: DataFrame,
    feed: DataFrame,
    now: datetime,
    strip: Callable[[Column], Column] = strip_status_prefix,
    skip_blank: bool = True,
) -> DataFrame:
    """The same for the wide table, without the status prefix; a blank status changes nothing."""
    statuses = _feed(feed)
    if skip_blank:
        statuses = statuses.where(F.col("feed_status") != "")
    found = F.col("feed_status").isNotNull()
    return (
        wc_orders.join(statuses, "id", "left")
        .withColumn("status", F.coalesce(strip(F.col("feed_status")), "status"))
        .withColumn(
            "date_updated_gmt", F.when(found, now_stamp(now)).otherwise(F.col("date_updated_gmt"))
        )
        .select(*wc_orders.columns)
    )


def converted_feed(feed: DataFrame) -> DataFrame:
    return feed.withColumn("status", mapped(F.col("status"), STATUS_MAP))


def sync_statuses_converted(dst_posts: DataFrame, feed: DataFrame, now: datetime) -> DataFrame:
    """Synchronise to standard statuses only."""
    return sync_statuses_exact(dst_posts, converted_feed(feed), now)


def sync_statuses_preserved(dst_posts: DataFrame, feed: DataFrame, now: datetime) -> DataFrame:
    """Synchronise and keep custom statuses: the exact synchronisation under its other name."""
    return sync_statuses_exact(dst_posts, feed, now)
