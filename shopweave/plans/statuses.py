"""Convert and synchronise order statuses."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strip_status_substr
from ..operators.filters import (
    custom_status_orders,
    is_order,
    orders_only,
    purge_transients,
    purge_transients_any,
)
from ..operators.statuses import (
    backup_statuses,
    conversion_metrics,
    convert_statuses,
    convert_statuses_meta,
    convert_statuses_wide,
    converted_feed,
    leftover,
    orders_by_id,
    status_distribution,
    status_metrics,
    sync_statuses_converted,
    sync_statuses_exact,
    sync_statuses_preserved,
    sync_statuses_wide,
)
from ..session import Workspace
from ..sources.files import (
    accepted_lines,
    read_status_lines,
    read_status_tsv,
    rejected_lines,
    write_status_rows,
)
from .steps import Steps
from .store import Store


def _distribution(store: Store) -> DataFrame:
    return status_distribution(orders_only(store.posts))


def job_convert_statuses(dst: Store) -> tuple[Store, DataFrame]:
    """Custom statuses become standard ones. Nothing is touched if there are none."""
    if not custom_status_orders(orders_only(dst.posts)).isEmpty():
        dst = dst.having(
            posts=convert_statuses(dst.posts), options=purge_transients(dst.options)
        )
    return dst, _distribution(dst)


def job_fix_statuses(
    dst: Store, now: datetime, workspace: Workspace | None = None, steps: Steps | None = None
) -> tuple[Store, DataFrame]:
    """Back up the statuses, then convert them in posts, wide table and metadata.

    With a workspace the posts are written once, and ``steps`` gets, from that write, what the conversion
    changes, the statuses before and after, and how many orders are left with no accepted status.
    """
    if custom_status_orders(orders_only(dst.posts)).isEmpty():
        return dst, _distribution(dst)
    converted = convert_statuses(dst.posts)
    if workspace is not None:
        converted = workspace.keep(_watched_conversion(dst.posts, steps or Steps()), "posts")
    after = dst.having(
        status_backup=backup_statuses(dst.status_backup, dst.posts, now),
        posts=converted,
        postmeta=convert_statuses_meta(dst.postmeta),
        options=purge_transients_any(dst.options),
    )
    if dst.wc_orders is not None:
        after = after.having(wc_orders=convert_statuses_wide(dst.wc_orders))
    return after, _distribution(after)


def _watched_conversion(posts: DataFrame, steps: Steps) -> DataFrame:
    """The converted posts; both states of a status meet in the row before the old one is dropped."""
    orders = F.coalesce(is_order(), F.lit(False))
    old, new = F.col("old_status_"), F.col("post_status")
    both = convert_statuses(posts.withColumn("old_status_", new))
    both = steps.watch("conversion", both, conversion_metrics(F.when(orders, old)) | {"left": leftover(F.when(orders, new))})
    both = steps.watch("before", both, status_metrics(old, orders))
    both = steps.watch("after", both, status_metrics(new, orders))
    return both.drop("old_status_")


def status_feed(
    spark: SparkSession, src: Store, workspace: Workspace, steps: Steps | None = None
) -> DataFrame:
    """The source's statuses, exchanged as a file between the two sides. ``steps`` gets the source's
    statuses as they were written."""
    path = workspace.location("status_feed")
    rows = orders_by_id(src.posts)
    if steps is not None:
        rows = steps.watch("source", rows, status_metrics(F.col("status")))
    write_status_rows(rows, path)
    return read_status_tsv(spark, path)


def job_sync_exact(
    spark: SparkSession,
    src: Store,
    dst: Store,
    now: datetime,
    workspace: Workspace,
    steps: Steps | None = None,
) -> tuple[Store, DataFrame]:
    """Destination orders take the statuses of the source as they are.

    With ``steps`` the new posts are written by the job, and the statuses of the source, and of the
    destination before and after, come from the writes of the feed and of the posts.
    """
    feed = status_feed(spark, src, workspace, steps)
    return _synced(dst, feed, now, workspace, steps)


def job_sync_file(
    spark: SparkSession,
    dst: Store,
    path: str,
    now: datetime,
    workspace: Workspace,
    header: bool = False,
    steps: Steps | None = None,
) -> tuple[Store, DataFrame]:
    """Destination orders take the statuses of a feed that came from outside, the last line of an order
    counting. The lines are read and written once; those that can't be used are returned, and ``steps``
    gets how many there were of both kinds."""
    steps = steps or Steps()
    kinds = {"accepted": F.count_if(F.col("reason").isNull()), "rejected": F.count("reason")}
    lines = workspace.keep(steps.watch("feed", read_status_lines(spark, path, header), kinds), "feed")
    after, _ = _synced(dst, accepted_lines(lines), now, workspace, steps)
    return after, rejected_lines(lines)


def _synced(
    dst: Store, feed: DataFrame, now: datetime, workspace: Workspace, steps: Steps | None
) -> tuple[Store, DataFrame]:
    """The destination with the statuses of a feed, and its new status distribution."""

    def watch(orders: DataFrame) -> DataFrame:
        before, found = F.col("post_status"), F.col("feed_status")
        orders = steps.watch("destination before", orders, status_metrics(before))
        orders = steps.watch("destination after", orders, status_metrics(F.coalesce(found, before)))
        return steps.watch("orders", orders, {"found": F.count(found), "not_found": F.count_if(found.isNull())})

    if steps is None:
        posts = sync_statuses_exact(dst.posts, feed, now)
    else:
        posts = workspace.keep(sync_statuses_exact(dst.posts, feed, now, watch), "posts")
    after = dst.having(posts=posts, options=purge_transients(dst.options))
    if dst.wc_orders is not None:
        after = after.having(wc_orders=sync_statuses_wide(dst.wc_orders, feed, now))
    return after, _distribution(after)


def job_sync_statuses(
    spark: SparkSession,
    src: Store,
    dst: Store,
    now: datetime,
    workspace: Workspace,
    convert: bool,
) -> tuple[Store, DataFrame]:
    """The menu's two synchronisations: with conversion to standard statuses, or preserving."""
    feed = status_feed(spark, src, workspace)
    sync = sync_statuses_converted if convert else sync_statuses_preserved
    after = dst.having(
        posts=sync(dst.posts, feed, now), options=purge_transients_any(dst.options)
    )
    if dst.wc_orders is not None:
        wide = (
            sync_statuses_wide(
                dst.wc_orders, converted_feed(feed), now, strip_status_substr, skip_blank=False
            )
            if convert
            else sync_statuses_wide(dst.wc_orders, feed, now, skip_blank=False)
        )
        after = after.having(wc_orders=wide)
    return after, _distribution(after)
