"""Bring over the customers a destination lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.customers import (
    customer_import_stats,
    customers_with_orders,
    export_usermeta,
    export_users,
    rename_prefixed_meta_keys,
)
from ..operators.filters import purge_transients
from ..operators.increment import absent_rows, increment, insert_increment
from ..session import Workspace
from .store import Store


def job_migrate_customers(
    src: Store, dst: Store, workspace: Workspace, src_prefix: str = "src_", dst_prefix: str = "dst_"
) -> tuple[Store, DataFrame]:
    """The destination with its missing customers, and the import statistics.

    Customers and the metadata to bring over are increments: written once, their number known from that
    write, and met by the destination's scans through their keys' range and Bloom filter. Users that are
    missing by definition need no second look. Source tables have primary keys, so their rows need no
    deduplication.
    """
    customers = customers_with_orders(src.users, src.postmeta, src.posts)
    ordering = increment(customers, "id", workspace, unique=True, name="customers")
    absent = increment(absent_rows(dst.users, ordering), "id", workspace, unique=True, name="missing_customers")
    missing = absent.rows
    if not absent.count:
        return dst, customer_import_stats(missing, dst.users, dst.postmeta)
    usermeta = rename_prefixed_meta_keys(
        export_usermeta(src.usermeta, missing), src_prefix, dst_prefix
    )
    incoming = increment(usermeta, "umeta_id", workspace, unique=True, name="usermeta")
    users = export_users(src.users, missing)
    after = dst.having(
        users=dst.users.unionByName(users, allowMissingColumns=True),
        usermeta=insert_increment(dst.usermeta, incoming),
        options=purge_transients(dst.options),
    )
    return after, customer_import_stats(missing, after.users, after.postmeta)
