"""All validation reports of a migration as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import orders_only
from ..operators.reports import (
    integrity_check,
    meta_validation,
    order_validation,
    user_validation,
)
from ..operators.statuses import status_distribution_pct
from .store import Store


def _long(report: DataFrame, name: str) -> DataFrame:
    """A one-row report as (report, metric, value)."""
    names = report.columns
    texts = report.select(F.lit(name).alias("report"), *(F.col(c).cast("string") for c in names))
    return texts.unpivot("report", names, "metric", "value")


def _statuses(store: Store) -> DataFrame:
    rows = status_distribution_pct(orders_only(store.posts))
    percentage = F.col("percentage").cast("decimal(10,2)").cast("string")
    return rows.select(
        "post_status", F.col("n").cast("string").alias("orders"), percentage.alias("percentage")
    ).select(
        F.lit("statuses").alias("report"),
        F.expr(
            "stack(2, concat(post_status, ' orders'), orders, concat(post_status, ' percent'), "
            "percentage) AS (metric, value)"
        ),
    )


def job_validate(src: Store, dst: Store) -> DataFrame:
    reports = [
        _long(user_validation(src.users, dst.users, dst.usermeta), "users"),
        _long(order_validation(src.posts, dst.posts, dst.postmeta, dst.order_items), "orders"),
        _statuses(dst),
        _long(meta_validation(dst.postmeta), "metadata"),
        _long(integrity_check(dst.posts, dst.postmeta), "integrity"),
    ]
    return reduce(DataFrame.unionByName, reports)
