"""One query per operator over the derived store tables, whole tables every time."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..fixed_values import (
    BILLING_PATTERN,
    EMAIL_KEY,
    FILE_KEY,
    PRICE_KEY,
    PRODUCT_TYPE,
    REGULAR_PRICE_KEY,
    SHIPPING_PATTERN,
    TOTAL_KEY,
    WIDE_TABLE_OPTIONS,
)
from ..operators import increment as increments
from ..operators import catalog, compare, customers, eav, filters, merge, orders, reports, statuses
from ..operators.counting import count_row, counted
from ..plans.catalog import job_export_catalog
from ..plans.customers import job_migrate_customers
from ..plans.live import job_convert_wide_live, swap_in
from ..plans.orders import (
    WIDE_TABLES,
    delete_orders_cascade,
    job_convert_wide,
    job_full,
    job_full_validated,
    job_migrate_orders,
    job_orders_complete,
)
from ..plans.statuses import (
    job_convert_statuses,
    job_fix_statuses,
    job_sync_exact,
    job_sync_file,
    job_sync_statuses,
)
from ..plans.steps import Steps
from ..plans.store import Store
from ..plans.validation import job_validate
from ..session import Workspace, configure
from ..sources.files import (
    accepted_lines,
    overwrite_wide,
    read_catalog_csv,
    read_status_lines,
    read_status_tsv,
    rejected_lines,
    write_catalog_csv,
    write_status_tsv,
)
from ..sources.snapshots import read_manifest, restore_snapshot, snapshot_tables
from ..sources.tables import key_predicates, scan_table, split_points
from .digests import digests
from .store_frames import DerivedStore, Side, StoredStore

DOMAIN = "shop.example.com"
NOW = datetime(2025, 9, 14, 12, 0, 0)
BATCH = 100


class Inputs:
    """The frames a query may need; each is built only when asked for."""

    def __init__(self, spark: SparkSession, store: DerivedStore | StoredStore):
        self.spark = configure(spark)
        self.store = store

    @cached_property
    def src(self) -> Side:
        return self.store.src()

    @cached_property
    def dst(self) -> Side:
        return self.store.dst()

    @cached_property
    def src_orders(self) -> DataFrame:
        return filters.orders_only(self.src.posts)

    @cached_property
    def dst_orders(self) -> DataFrame:
        return filters.orders_only(self.dst.posts)

    @cached_property
    def dst_wide(self) -> DataFrame:
        return orders.orders_wide(self.dst.posts, self.dst.postmeta)

    @cached_property
    def products(self) -> DataFrame:
        return filters.published_products(self.src.posts)

    @cached_property
    def named_terms(self) -> DataFrame:
        return catalog.product_terms(
            self.src.term_relationships, self.src.term_taxonomy, self.src.terms
        )

    @cached_property
    def customers(self) -> DataFrame:
        return customers.customers_with_orders(self.src.users, self.src.postmeta, self.src.posts)

    @cached_property
    def missing(self) -> DataFrame:
        return customers.missing_customers(self.customers, self.dst.users)

    @cached_property
    def missing_usermeta(self) -> DataFrame:
        exported = customers.export_usermeta(self.src.usermeta, self.missing)
        return customers.rename_prefixed_meta_keys(exported, "src_", "dst_")

    @property
    def incoming_usermeta(self) -> increments.Increment:
        return increments.increment(self.missing_usermeta, "umeta_id", self.workspace)

    @cached_property
    def feed(self) -> DataFrame:
        return self.src_orders.select("id", F.col("post_status").alias("status"))

    @cached_property
    def workspace(self) -> Workspace:
        return Workspace(self.spark)


Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    # a trailing underscore only keeps the name apart from the imported function it checks
    QUERIES[build.__name__.rstrip("_")] = build
    return build


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_table_(q: Inputs) -> DataFrame:
    root = q.workspace.location("tables")
    overwrite_wide(q.dst.users, f"{root}/dst/users")
    return scan_table(q.spark, root, "dst", "users")


@query
def export_orders(q: Inputs) -> DataFrame:
    return orders.export_orders(q.src.posts)


@query
def export_users(q: Inputs) -> DataFrame:
    return customers.export_users(q.src.users, q.missing)


@query
def export_usermeta(q: Inputs) -> DataFrame:
    return customers.export_usermeta(q.src.usermeta, q.missing)


@query
def write_catalog_csv_(q: Inputs) -> DataFrame:
    path = q.workspace.location("catalog.csv")
    rows = catalog.catalog_rows(q.src.posts, q.src.postmeta, q.named_terms, DOMAIN)
    write_catalog_csv(rows, path)
    return read_catalog_csv(q.spark, path)


@query
def write_status_tsv_(q: Inputs) -> DataFrame:
    path = q.workspace.location("statuses.tsv")
    write_status_tsv(q.src.posts, path)
    lines = F.split("value", "\t")
    return q.spark.read.text(path).select(lines[0].alias("id"), lines[1].alias("status"))


@query
def read_status_tsv_(q: Inputs) -> DataFrame:
    path = q.workspace.location("statuses.tsv")
    write_status_tsv(q.dst.posts, path)
    return read_status_tsv(q.spark, path)


@query
def snapshot_tables_(q: Inputs) -> DataFrame:
    """Rows of every table as its manifest has them."""
    folder = q.workspace.location("snapshots")
    snapshot_tables(q.dst.store(), folder, "20250914_120000")
    return read_manifest(q.spark, folder, "20250914_120000").select("table_name", F.col("n_rows").alias("n"))


@query
def restore_snapshot_(q: Inputs) -> DataFrame:
    """Every table written, held against the manifest and read back; shown are the users' metadata."""
    folder, place = q.workspace.location("snapshots"), q.workspace.location("restored")
    snapshot_tables(q.dst.store(), folder, "20250914_120000")
    return restore_snapshot(q.spark, folder, "20250914_120000", None, place).usermeta


def _odd_feed(q: Inputs) -> str:
    """A feed as it may come from outside: after all orders' lines come those of orders on hold again, now
    as completed, then a line without a status and one with a field too many for some others."""
    status, number = F.col("status"), F.col("id").cast("string")
    values = [
        F.concat_ws("\t", number, status),
        F.when(status == "wc-on-hold", F.concat(number, F.lit("\twc-completed"))),
        F.when(status == "wc-failed", F.concat(F.lit("#"), number)),
        F.when(status == "wc-cancelled", F.concat(number, F.lit("\t"), status, F.lit("\tmore"))),
    ]
    lines = F.array(*(F.struct(F.lit(i).alias("turn"), v.alias("value")) for i, v in enumerate(values)))
    rows = q.feed.select("id", F.inline(lines)).where("value IS NOT NULL").orderBy("turn", "id")
    path = q.workspace.location("odd_feed")
    rows.select("value").write.text(path)
    return path


@query
def rejected_status_lines(q: Inputs) -> DataFrame:
    return rejected_lines(read_status_lines(q.spark, _odd_feed(q))).select("line", "reason")


@query
def overwrite_wide_(q: Inputs) -> DataFrame:
    path = q.workspace.location("wc_orders")
    light = orders.orders_wide_light(q.src.posts, q.src.postmeta)
    overwrite_wide(light.select("id", "status"), path)
    overwrite_wide(light, path)
    return q.spark.read.parquet(path)


# --- filters ---------------------------------------------------------------------------


@query
def orders_only(q: Inputs) -> DataFrame:
    return filters.orders_only(q.src.posts)


@query
def published_products(q: Inputs) -> DataFrame:
    return filters.published_products(q.src.posts)


@query
def custom_status_orders(q: Inputs) -> DataFrame:
    return filters.custom_status_orders(q.src_orders)


@query
def nonstandard_status_orders(q: Inputs) -> DataFrame:
    return filters.nonstandard_status_orders(q.src_orders)


@query
def standard_status_orders(q: Inputs) -> DataFrame:
    return filters.standard_status_orders(q.src_orders)


@query
def meta_by_prefix(q: Inputs) -> DataFrame:
    billing = filters.meta_by_prefix(q.src.postmeta, BILLING_PATTERN)
    return billing.unionByName(filters.meta_by_prefix(q.src.postmeta, SHIPPING_PATTERN))


@query
def non_guest_meta(q: Inputs) -> DataFrame:
    return filters.non_guest_meta(q.src.postmeta)


@query
def in_stock_products(q: Inputs) -> DataFrame:
    return filters.in_stock_products(q.src.posts, q.src.postmeta)


@query
def products_with_image(q: Inputs) -> DataFrame:
    return catalog.products_with_image(q.products.select("id"), q.src.postmeta)


@query
def purge_transients(q: Inputs) -> DataFrame:
    return filters.purge_transients(q.dst.options)


@query
def purge_transients_any(q: Inputs) -> DataFrame:
    return filters.purge_transients_any(q.dst.options)


@query
def distinct_statuses(q: Inputs) -> DataFrame:
    return filters.distinct_statuses(q.src_orders)


# --- joins -----------------------------------------------------------------------------


@query
def customers_with_orders(q: Inputs) -> DataFrame:
    return q.customers


@query
def missing_customers(q: Inputs) -> DataFrame:
    return q.missing


@query
def missing_customers_increment(q: Inputs) -> DataFrame:
    ordering = increments.increment(q.customers, "id", q.workspace, unique=True)
    return increments.absent_rows(q.dst.users, ordering)


@query
def existing_customers(q: Inputs) -> DataFrame:
    return customers.existing_customers(q.customers, q.dst.users)


@query
def export_order_meta(q: Inputs) -> DataFrame:
    return orders.export_order_meta(q.src.postmeta, q.src.posts)


@query
def export_order_items(q: Inputs) -> DataFrame:
    return orders.export_order_items(q.src.order_items, q.src.posts)


@query
def export_order_itemmeta(q: Inputs) -> DataFrame:
    return orders.export_order_itemmeta(q.src.order_itemmeta, q.src.order_items, q.src.posts)


@query
def orders_left_pivot(q: Inputs) -> DataFrame:
    pivot = eav.pivot_order_core(q.src.postmeta, q.src.posts)
    return orders.orders_left_pivot(q.src_orders.select("id", "post_status"), pivot)


@query
def product_images(q: Inputs) -> DataFrame:
    return catalog.product_images(q.products.select("id"), q.src.postmeta)


@query
def product_terms(q: Inputs) -> DataFrame:
    return q.named_terms


@query
def orphaned_meta(q: Inputs) -> DataFrame:
    return orders.orphaned_meta(q.src.postmeta, q.src.posts)


@query
def orders_without_customer(q: Inputs) -> DataFrame:
    return orders.orders_without_customer(q.src.posts, q.src.postmeta)


@query
def first_meta(q: Inputs) -> DataFrame:
    return eav.first_meta(q.src_orders, q.src.postmeta, TOTAL_KEY, "0")


@query
def has_tag(q: Inputs) -> DataFrame:
    tagged = catalog.has_tag(q.products, q.named_terms, "buynow")
    return tagged.withColumn("has_tag", F.col("has_tag").cast("int"))


@query
def order_meta_joined_count(q: Inputs) -> DataFrame:
    return orders.order_meta_joined_count(q.src.postmeta, q.src.posts)


# --- aggregates ------------------------------------------------------------------------


@query
def table_counts(q: Inputs) -> DataFrame:
    s = q.src
    return orders.table_counts(s.posts, s.postmeta, s.order_items, s.order_itemmeta)


@query
def distinct_customer_count(q: Inputs) -> DataFrame:
    return customers.distinct_customer_count(q.src.postmeta)


@query
def status_distribution(q: Inputs) -> DataFrame:
    return statuses.status_distribution(q.src_orders)


@query
def status_distribution_pct(q: Inputs) -> DataFrame:
    return statuses.status_distribution_pct(q.src_orders)


@query
def per_status_counts(q: Inputs) -> DataFrame:
    return statuses.per_status_counts(q.src_orders)


@query
def pivot_order_core(q: Inputs) -> DataFrame:
    return eav.pivot_order_core(q.src.postmeta, q.src.posts)


@query
def pivot_billing(q: Inputs) -> DataFrame:
    return eav.pivot_billing(q.src.postmeta, q.src.posts)


@query
def pivot_shipping(q: Inputs) -> DataFrame:
    return eav.pivot_shipping(q.src.postmeta, q.src.posts)


@query
def pivot_operational(q: Inputs) -> DataFrame:
    return eav.pivot_operational(q.src.postmeta, q.src.posts)


@query
def product_categories(q: Inputs) -> DataFrame:
    return catalog.product_categories(q.named_terms)


@query
def product_tags(q: Inputs) -> DataFrame:
    return catalog.product_tags(q.named_terms)


@query
def critical_meta_counts(q: Inputs) -> DataFrame:
    return reports.critical_meta_counts(q.src.postmeta)


@query
def catalog_count(q: Inputs) -> DataFrame:
    every = catalog.catalog_count(q.src.posts, q.src.postmeta)
    in_stock = catalog.catalog_count(q.src.posts, q.src.postmeta, in_stock=True)
    return count_row({"every_product": every, "in_stock": in_stock})


# --- sorts, limits, pages --------------------------------------------------------------


@query
def status_distribution_sorted(q: Inputs) -> DataFrame:
    return statuses.status_distribution_sorted(q.src_orders)


@query
def latest_products(q: Inputs) -> DataFrame:
    return catalog.latest_products(
        q.src.posts, q.src.postmeta, q.named_terms, DOMAIN, workspace=q.workspace
    )


@query
def catalog_batches(q: Inputs) -> DataFrame:
    return catalog.catalog_pages(
        q.src.posts, q.src.postmeta, q.named_terms, DOMAIN, q.workspace, BATCH
    )


@query
def orders_by_id(q: Inputs) -> DataFrame:
    return statuses.orders_by_id(q.src.posts)


@query
def missing_preview(q: Inputs) -> DataFrame:
    return customers.missing_preview(q.missing)


# --- set operations and mutations ------------------------------------------------------


@query
def insert_ignore(q: Inputs) -> DataFrame:
    return merge.insert_ignore(q.dst.usermeta, q.missing_usermeta, "umeta_id")


@query
def insert_ignore_rejects(q: Inputs) -> DataFrame:
    return merge.insert_ignore_rejects(q.dst.usermeta, q.missing_usermeta, "umeta_id")


@query
def insert_increment(q: Inputs) -> DataFrame:
    return increments.insert_increment(q.dst.usermeta, q.incoming_usermeta)


@query
def increment_rejects(q: Inputs) -> DataFrame:
    return increments.increment_rejects(q.dst.usermeta, q.incoming_usermeta)


@query
def rename_prefixed_meta_keys(q: Inputs) -> DataFrame:
    return customers.rename_prefixed_meta_keys(q.src.usermeta, "src_", "dst_")


@query
def delete_orders_cascade_(q: Inputs) -> DataFrame:
    left = delete_orders_cascade(q.dst.store())
    parts = {
        "posts": left.posts.select(F.col("id").alias("row_id")),
        "postmeta": left.postmeta.select(F.col("meta_id").alias("row_id")),
        "order_items": left.order_items.select(F.col("order_item_id").alias("row_id")),
        "order_itemmeta": left.order_itemmeta.select(F.col("meta_id").alias("row_id")),
    }
    rows = [frame.select(F.lit(name).alias("table_name"), "row_id") for name, frame in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query
def convert_statuses(q: Inputs) -> DataFrame:
    return statuses.convert_statuses(q.src.posts)


@query
def convert_statuses_wide(q: Inputs) -> DataFrame:
    return statuses.convert_statuses_wide(q.dst_wide)


@query
def convert_statuses_meta(q: Inputs) -> DataFrame:
    return statuses.convert_statuses_meta(q.dst.postmeta)


@query
def conversion_counts(q: Inputs) -> DataFrame:
    return statuses.conversion_counts(q.src_orders)


@query
def backup_statuses(q: Inputs) -> DataFrame:
    earlier = statuses.backup_statuses(None, q.dst.posts, datetime(2025, 9, 1))
    return statuses.backup_statuses(earlier, q.src.posts, NOW)


@query
def sync_statuses_exact(q: Inputs) -> DataFrame:
    return statuses.sync_statuses_exact(q.dst.posts, q.feed, NOW)


@query
def sync_statuses_last_line(q: Inputs) -> DataFrame:
    """The last line of an id decides, as updates in the order of the lines would."""
    feed = accepted_lines(read_status_lines(q.spark, _odd_feed(q)))
    return statuses.sync_statuses_exact(q.dst.posts, feed, NOW)


@query
def job_sync_file_(q: Inputs) -> DataFrame:
    steps, store = Steps(), q.dst.store()
    job_sync_file(q.spark, store, _odd_feed(q), NOW, q.workspace, steps=steps)
    return steps.report(q.spark)


@query
def sync_statuses_wide(q: Inputs) -> DataFrame:
    return statuses.sync_statuses_wide(q.dst_wide, q.feed, NOW)


@query
def sync_statuses_converted(q: Inputs) -> DataFrame:
    return statuses.sync_statuses_converted(q.dst.posts, q.feed, NOW)


@query
def sync_statuses_preserved(q: Inputs) -> DataFrame:
    return statuses.sync_statuses_preserved(q.dst.posts, q.feed, NOW)


@query
def upsert_options(q: Inputs) -> DataFrame:
    return merge.upsert_options(q.dst.options, WIDE_TABLE_OPTIONS)


@query
def append_addresses(q: Inputs) -> DataFrame:
    billing = eav.pivot_billing(q.dst.postmeta, q.dst.posts)
    shipping = eav.pivot_shipping(q.dst.postmeta, q.dst.posts)
    return orders.append_addresses(billing, shipping)


@query
def copy_order_meta(q: Inputs) -> DataFrame:
    return orders.copy_order_meta(q.src.postmeta, q.src.posts)


@query
def entity_counts_report(q: Inputs) -> DataFrame:
    return orders.entity_counts_report(q.dst.posts, q.dst_wide, q.dst.users)


# --- wide tables and reports -----------------------------------------------------------


@query
def orders_wide(q: Inputs) -> DataFrame:
    return orders.orders_wide(q.src.posts, q.src.postmeta)


@query
def orders_wide_light(q: Inputs) -> DataFrame:
    return orders.orders_wide_light(q.src.posts, q.src.postmeta)


@query
def order_addresses(q: Inputs) -> DataFrame:
    return orders.order_addresses(q.src.postmeta, q.src.posts)


@query
def order_operational(q: Inputs) -> DataFrame:
    return orders.order_operational(q.src.postmeta, q.src.posts)


@query
def product_catalog(q: Inputs) -> DataFrame:
    return catalog.product_catalog(q.src.posts, q.src.postmeta, q.named_terms, DOMAIN)


@query
def product_catalog_in_stock(q: Inputs) -> DataFrame:
    return catalog.product_catalog(
        q.src.posts, q.src.postmeta, q.named_terms, DOMAIN, in_stock=True
    )


@query
def user_validation(q: Inputs) -> DataFrame:
    return reports.user_validation(q.src.users, q.dst.users, q.dst.usermeta)


@query
def order_validation(q: Inputs) -> DataFrame:
    return reports.order_validation(
        q.src.posts, q.dst.posts, q.dst.postmeta, q.dst.order_items
    )


@query
def meta_validation(q: Inputs) -> DataFrame:
    return reports.meta_validation(q.dst.postmeta)


@query
def integrity_check(q: Inputs) -> DataFrame:
    return reports.integrity_check(q.src.posts, q.src.postmeta)


@query
def wide_reconciliation(q: Inputs) -> DataFrame:
    stored = q.workspace.keep(q.dst_wide, "wc_orders")
    return reports.wide_reconciliation(q.src.posts, stored)


@query
def import_reconciliation(q: Inputs) -> DataFrame:
    return reports.import_reconciliation(q.src.posts, q.dst.posts)


@query
def order_differences(q: Inputs) -> DataFrame:
    """Orders that differ between the sides, by content."""
    sides = filters.orders_only(q.src.posts), filters.orders_only(q.dst.posts)
    return compare.differences(*sides, "id", workspace=q.workspace)


@query
def usermeta_differences(q: Inputs) -> DataFrame:
    return compare.differences(q.src.usermeta, q.dst.usermeta, "umeta_id", workspace=q.workspace)


@query
def import_differences(q: Inputs) -> DataFrame:
    """What a replacing import left different: the statuses that it maps, and nothing else."""
    after, _ = job_migrate_orders(q.src.store(), q.dst.store(), True, q.workspace)
    sides = filters.orders_only(q.src.posts), filters.orders_only(after.posts)
    return compare.differences(*sides, "id")


@query
def customer_import_stats(q: Inputs) -> DataFrame:
    missing = q.workspace.keep(q.missing, "missing_customers")
    exported = customers.export_users(q.src.users, missing)
    users = merge.insert_ignore(q.dst.users, exported, "id", unique=True)
    return customers.customer_import_stats(missing, users, q.dst.postmeta)


# --- jobs ------------------------------------------------------------------------------


@query
def job_migrate_customers_(q: Inputs) -> DataFrame:
    return job_migrate_customers(q.src.store(), q.dst.store(), q.workspace)[1]


@query
def job_migrate_orders_(q: Inputs) -> DataFrame:
    return job_migrate_orders(q.src.store(), q.dst.store(), replace=True)[1]


@query
def job_convert_wide_(q: Inputs) -> DataFrame:
    return job_convert_wide(q.dst.store(), q.workspace)[1]


@query
def job_orders_complete_(q: Inputs) -> DataFrame:
    return job_orders_complete(q.src.store(), q.dst.store(), replace=True)[1]


@query
def job_full_(q: Inputs) -> DataFrame:
    return job_full(q.src.store(), q.dst.store(), q.workspace)[1]


@query
def job_fix_statuses_(q: Inputs) -> DataFrame:
    return job_fix_statuses(q.dst.store().having(wc_orders=q.dst_wide), NOW)[1]


@query
def job_sync_exact_(q: Inputs) -> DataFrame:
    return job_sync_exact(q.spark, q.src.store(), q.dst.store(), NOW, q.workspace)[1]


@query
def job_migrate_orders_steps(q: Inputs) -> DataFrame:
    steps = Steps()
    job_migrate_orders(q.src.store(), q.dst.store(), True, q.workspace, steps)
    return steps.report(q.spark)


@query
def job_orders_complete_bucketed(q: Inputs) -> DataFrame:
    """The same job over kept tables in buckets of the post's id."""
    _, wide = job_orders_complete(q.src.store(), q.dst.store(), True, q.workspace, buckets=8)
    return q.workspace.keep(wide, "wc_orders")


@query
def split_shares(q: Inputs) -> DataFrame:
    """Rows of the order metadata by the shares that a parallel scan would read, added up again."""
    keys = q.src.postmeta.select("meta_id")
    shares = key_predicates(split_points(keys, "meta_id", 8), "meta_id")
    share = F.coalesce(*(F.when(F.expr(x), i) for i, x in enumerate(shares)))
    sizes = keys.groupBy(share.alias("share")).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("shares"),
        (F.max("n") * 8 <= F.sum("n") * 1.1).alias("even"),
    )


@query
def job_fix_statuses_steps(q: Inputs) -> DataFrame:
    steps = Steps()
    job_fix_statuses(q.dst.store(), NOW, q.workspace, steps)
    return steps.report(q.spark)


@query
def job_sync_exact_steps(q: Inputs) -> DataFrame:
    steps = Steps()
    job_sync_exact(q.spark, q.src.store(), q.dst.store(), NOW, q.workspace, steps)
    return steps.report(q.spark)


@query
def job_full_validated_(q: Inputs) -> DataFrame:
    return job_full_validated(q.src.store(), q.dst.store(), q.workspace)[1]


@query
def job_validate_(q: Inputs) -> DataFrame:
    return job_validate(q.src.store(), q.dst.store())


def _left_behind(q: Inputs, after: Store, *names: str) -> DataFrame:
    """All of the named tables that a job leaves behind, written and read back."""
    tables = Store(**{n: getattr(after, n) for n in names}).written(q.workspace).tables()
    return digests(tables)


ORDER_TABLES = ("posts", "postmeta", "order_items", "order_itemmeta")


@query
def delete_orders_cascade_tables(q: Inputs) -> DataFrame:
    return _left_behind(q, delete_orders_cascade(q.dst.store()), *ORDER_TABLES)


@query
def restore_snapshot_tables(q: Inputs) -> DataFrame:
    folder, store = q.workspace.location("snapshots"), q.dst.store()
    snapshot_tables(store, folder, "20250914_120000")
    place = q.workspace.location("restored")
    return digests(restore_snapshot(q.spark, folder, "20250914_120000", None, place).tables())


@query
def job_migrate_customers_tables(q: Inputs) -> DataFrame:
    after, _ = job_migrate_customers(q.src.store(), q.dst.store(), q.workspace)
    return _left_behind(q, after, "users", "usermeta", "options")


@query
def job_migrate_orders_tables(q: Inputs) -> DataFrame:
    after, _ = job_migrate_orders(q.src.store(), q.dst.store(), replace=True)
    return _left_behind(q, after, *ORDER_TABLES)


@query
def job_convert_wide_tables(q: Inputs) -> DataFrame:
    after, _ = job_convert_wide(q.dst.store(), q.workspace)
    return digests({n: after.tables()[n] for n in (*WIDE_TABLES, "options")})


@query
def job_convert_wide_live_tables(q: Inputs) -> DataFrame:
    """What readers of the views see after older tables were swapped for the rebuilt ones."""
    prefix = f"live_{uuid.uuid4().hex}_"
    names = (*WIDE_TABLES, "options")
    first = Store(wc_orders=q.dst_wide.limit(0), options=q.dst.options).written(q.workspace)
    swap_in(q.spark, first.folders, prefix)
    after, _ = job_convert_wide_live(q.spark, q.dst.store(), q.workspace, prefix)
    found = digests({n: after.tables()[n] for n in names})
    for name in names:
        q.spark.sql(f"DROP VIEW {prefix}{name}")
    return found


@query
def job_full_tables(q: Inputs) -> DataFrame:
    after, _ = job_full(q.src.store(), q.dst.store(), q.workspace)
    return _left_behind(q, after, "users", "usermeta", "options", *ORDER_TABLES, "wc_orders")


@query
def job_fix_statuses_tables(q: Inputs) -> DataFrame:
    after, _ = job_fix_statuses(q.dst.store().having(wc_orders=q.dst_wide), NOW)
    return _left_behind(q, after, "status_backup", "posts", "postmeta", "options", "wc_orders")


@query
def job_convert_statuses_tables(q: Inputs) -> DataFrame:
    return _left_behind(q, job_convert_statuses(q.dst.store())[0], "posts", "options")


def _synced(q: Inputs, job: Callable[..., tuple[Store, DataFrame]], **mode) -> DataFrame:
    store = q.dst.store().having(wc_orders=q.dst_wide)
    after, _ = job(q.spark, q.src.store(), store, NOW, q.workspace, **mode)
    return _left_behind(q, after, "posts", "options", "wc_orders")


@query
def job_sync_exact_tables(q: Inputs) -> DataFrame:
    return _synced(q, job_sync_exact)


@query
def job_sync_converted_tables(q: Inputs) -> DataFrame:
    return _synced(q, job_sync_statuses, convert=True)


@query
def job_sync_preserved_tables(q: Inputs) -> DataFrame:
    return _synced(q, job_sync_statuses, convert=False)


@query
def job_export_catalog_(q: Inputs) -> DataFrame:
    return job_export_catalog(q.spark, q.src.store(), q.workspace.location("catalog"), DOMAIN)


# --- column functions ------------------------------------------------------------------


@query
def clean_text(q: Inputs) -> DataFrame:
    texts = ["post_title", "post_excerpt", "post_content"]
    return q.src.posts.select("id", *(fn.clean_text(F.col(c)).alias(c) for c in texts))


@query
def strip_status_all(q: Inputs) -> DataFrame:
    return q.src.posts.select("id", fn.strip_status_all(F.col("post_status")).alias("status"))


@query
def strip_status_prefix(q: Inputs) -> DataFrame:
    return q.src.posts.select("id", fn.strip_status_prefix(F.col("post_status")).alias("status"))


@query
def strip_status_substr(q: Inputs) -> DataFrame:
    return q.src.posts.select("id", fn.strip_status_substr(F.col("post_status")).alias("status"))


@query
def image_url(q: Inputs) -> DataFrame:
    files = q.src.postmeta.where(F.col("meta_key") == FILE_KEY)
    return files.select("post_id", fn.image_url(DOMAIN, F.col("meta_value")).alias("url"))


@query
def price_fallback(q: Inputs) -> DataFrame:
    prices = eav.pivot_first(q.src.postmeta, {"own": PRICE_KEY, "regular": REGULAR_PRICE_KEY})
    products = q.src.posts.where(F.col("post_type") == PRODUCT_TYPE)
    return products.select("id").join(
        prices.withColumnRenamed("post_id", "id"), "id", "left"
    ).select("id", fn.price_fallback(F.col("own"), F.col("regular")).alias("price"))


@query
def product_type(q: Inputs) -> DataFrame:
    buynow = catalog.has_tag(q.products, q.named_terms, "buynow").withColumnRenamed("has_tag", "b")
    thirty = catalog.has_tag(q.products, q.named_terms, "30days").withColumnRenamed("has_tag", "t")
    kind = fn.product_type(F.col("b"), F.col("t")).alias("product_type")
    return buynow.join(thirty, "id").select("id", kind)


@query
def to_unsigned(q: Inputs) -> DataFrame:
    return q.src.postmeta.select("meta_id", fn.to_unsigned(F.col("meta_value")).alias("number"))


@query
def to_decimal(q: Inputs) -> DataFrame:
    return q.src.postmeta.select("meta_id", fn.to_decimal(F.col("meta_value")).alias("number"))


@query
def from_unixtime(q: Inputs) -> DataFrame:
    dates = filters.meta_of_keys(q.src.postmeta, ["_date_paid", "_date_completed", EMAIL_KEY])
    return dates.select("meta_id", fn.from_unixtime(F.col("meta_value")).alias("moment"))


@query
def yes_flag(q: Inputs) -> DataFrame:
    return q.src.postmeta.select("meta_id", fn.yes_flag(F.col("meta_value")).alias("flag"))


@query
def true_flag(q: Inputs) -> DataFrame:
    return q.src.postmeta.select("meta_id", fn.true_flag(F.col("meta_value")).alias("flag"))


@query
def default_order_key(q: Inputs) -> DataFrame:
    keys = eav.pivot_first(q.src.postmeta, {"own": "_order_key"}).withColumnRenamed("post_id", "id")
    key = fn.default_order_key(F.col("own"), F.col("id")).alias("order_key")
    return q.src_orders.select("id").join(keys, "id", "left").select("id", key)


@query
def round_pct(q: Inputs) -> DataFrame:
    per_note = q.src_orders.groupBy("post_excerpt").agg(
        F.count("*").alias("n"), F.count_if(F.col("post_status") == "wc-completed").alias("done")
    )
    return per_note.select("post_excerpt", fn.round_pct(F.col("done"), F.col("n")).alias("pct"))


@query
def int_pct(q: Inputs) -> DataFrame:
    counts = q.src_orders.groupBy("post_excerpt").agg(
        F.count_if(F.col("post_status") == "wc-completed").alias("done"),
        F.count_if(F.col("post_status") == "wc-cancelled").alias("lost"),
        F.count_if(F.col("post_status") == "wc-trash").alias("none"),
    )
    return counts.select(
        "post_excerpt",
        fn.int_pct(F.col("done"), F.col("lost")).alias("pct"),
        F.coalesce(fn.int_pct(F.col("done"), F.col("none")), F.lit(-1)).alias("no_pct"),
    )


@query
def now_stamp(q: Inputs) -> DataFrame:
    return q.src_orders.select("id", fn.now_stamp(NOW).alias("stamp"))


def comparable(frame: DataFrame) -> DataFrame:
    """Money as doubles: the two engines print decimals with a different number of zeros."""
    return frame.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in frame.schema.fields
        )
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Query):
        return lambda spark, sf_dir: comparable(build(Inputs(spark, DerivedStore(spark, sf_dir))))

    return {name: bound(build) for name, build in QUERIES.items()}
