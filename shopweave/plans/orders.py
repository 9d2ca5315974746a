"""Copy orders, build the wide tables, and the full migration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import WIDE_TABLE_OPTIONS
from ..operators.filters import is_order, orders_only
from ..operators.increment import increment, insert_increment
from ..operators.merge import insert_ignore, upsert_options
from ..operators.orders import (
    copy_order_meta,
    entity_counts_report,
    export_order_itemmeta,
    export_order_items,
    export_order_meta,
    export_orders,
    meta_without_orders,
    order_addresses,
    order_operational,
    orders_wide,
    orders_wide_light,
    posts_without_orders,
    table_counts,
)
from ..operators.reports import wide_reconciliation
from ..operators.statuses import convert_statuses
from ..session import Workspace
from .customers import job_migrate_customers
from .steps import Steps
from .store import Store
from .validation import job_validate


def delete_orders_cascade(dst: Store) -> Store:
    """Without orders and their metadata; all items and item metadata go as well. A destination without
    orders keeps its items."""
    if orders_only(dst.posts).isEmpty():
        return dst
    return dst.having(
        posts=posts_without_orders(dst.posts),
        postmeta=meta_without_orders(dst.postmeta, dst.posts),
        order_items=dst.order_items.limit(0),
        order_itemmeta=dst.order_itemmeta.limit(0),
    )


def job_migrate_orders(
    src: Store,
    dst: Store,
    replace: bool,
    workspace: Workspace | None = None,
    steps: Steps | None = None,
    buckets: int = 0,
) -> tuple[Store, DataFrame]:
    """The destination with the source's orders, and its table counts.

    ``replace`` first deletes the orders the destination has. With a workspace the source's orders are
    written first, as an increment that the other exports read in place of all posts, and so are the new
    posts and metadata, which later steps read again. ``steps`` then gets, from these writes, the orders
    that were expected and those that arrived.
    """
    incoming = None
    if workspace is None:
        orders, posts_of = export_orders(src.posts), src.posts
        if orders.isEmpty():
            raise ValueError("the source has no orders")
    else:
        incoming = increment(export_orders(src.posts), "id", workspace, unique=True, name="orders")
        orders = posts_of = incoming.rows
        if not incoming.count:
            raise ValueError("the source has no orders")
    kept = delete_orders_cascade(dst) if replace else dst
    if incoming is None:
        posts = insert_ignore(kept.posts, orders, "id", unique=True)
    else:
        posts = insert_increment(kept.posts, incoming)
    meta = export_order_meta(src.postmeta, posts_of)
    items = export_order_items(src.order_items, posts_of)
    itemmeta = export_order_itemmeta(src.order_itemmeta, src.order_items, posts_of)
    after = dst.having(
        posts=convert_statuses(posts),
        postmeta=insert_ignore(kept.postmeta, meta, "meta_id", unique=True),
        order_items=insert_ignore(kept.order_items, items, "order_item_id", unique=True),
        order_itemmeta=insert_ignore(kept.order_itemmeta, itemmeta, "meta_id", unique=True),
    )
    if incoming is not None:
        steps = steps or Steps()
        steps.add("orders", expected=incoming.count)
        arrived = steps.watch("orders", after.posts, {"imported": F.count_if(is_order())})
        if buckets:
            kept_posts = workspace.keep_bucketed(arrived, "posts", "id", buckets)
            kept_meta = workspace.keep_bucketed(after.postmeta, "postmeta", "post_id", buckets)
        else:
            kept_posts = workspace.keep(arrived, "posts")
            kept_meta = workspace.keep(after.postmeta, "postmeta")
        after = after.having(posts=kept_posts, postmeta=kept_meta)
    counts = table_counts(after.posts, after.postmeta, after.order_items, after.order_itemmeta)
    return after, counts


WIDE_TABLES = ("wc_orders", "wc_orders_meta", "wc_order_addresses", "wc_order_operational_data")


def job_convert_wide(dst: Store, workspace: Workspace) -> tuple[Store, DataFrame]:
    """The four wide tables rebuilt from posts and metadata and written, their settings, and the check
    of what is stored. The orders' metadata is written first, and the other tables are built from what is
    stored of it: all metadata is read once."""
    copied = dst.having(wc_orders_meta=copy_order_meta(dst.postmeta, dst.posts)).written(workspace, "wc_orders_meta")
    own = copied.wc_orders_meta.withColumnRenamed("order_id", "post_id")
    after = copied.having(
        wc_orders=orders_wide(dst.posts, own),
        wc_order_addresses=order_addresses(own, dst.posts),
        wc_order_operational_data=order_operational(own, dst.posts),
        options=upsert_options(dst.options, WIDE_TABLE_OPTIONS),
    )
    after = after.written(workspace, *(n for n in (*WIDE_TABLES, "options") if n != "wc_orders_meta"))
    return after, wide_reconciliation(after.posts, after.wc_orders)


def job_orders_complete(
    src: Store,
    dst: Store,
    replace: bool,
    workspace: Workspace | None = None,
    steps: Steps | None = None,
    buckets: int = 0,
) -> tuple[Store, DataFrame]:
    """Orders copied, then the light wide table; that table is the report."""
    after, _ = job_migrate_orders(src, dst, replace, workspace, steps, buckets)
    wide = orders_wide_light(after.posts, after.postmeta)
    return after.having(wc_orders=wide), wide


def job_full(
    src: Store,
    dst: Store,
    workspace: Workspace,
    replace: bool = True,
    convert_again: bool = False,
    steps: Steps | None = None,
) -> tuple[Store, DataFrame]:
    """Customers, orders and the light wide table; reports the three entity counts.

    ``convert_again`` maps the statuses once more at the end, as the menu does; a second mapping
    changes nothing. ``steps`` gets the orders that were expected and that arrived.
    """
    with_customers, _ = job_migrate_customers(src, dst, workspace)
    after, wide = job_orders_complete(src, with_customers, replace, workspace, steps)
    if convert_again:
        after = after.having(posts=convert_statuses(after.posts))
    return after, entity_counts_report(after.posts, wide, after.users)


def job_full_validated(
    src: Store, dst: Store, workspace: Workspace, replace: bool = True, steps: Steps | None = None
) -> tuple[Store, DataFrame]:
    """The full migration, its tables written, and the validation of what is stored in place of counts."""
    after, _ = job_full(src, dst, workspace, replace, steps=steps)
    stored = after.written(workspace, "users", "usermeta", "order_items", "order_itemmeta", "wc_orders", "options")
    return stored, job_validate(src, stored)
