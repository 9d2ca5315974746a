"""What reaches the scans, and where data is shuffled."""

import pytest

from shopweave.checks.store_frames import DerivedStore
from shopweave.operators import catalog, customers, eav, orders, reports, statuses
from shopweave.operators.filters import orders_only
from shopweave.plans.orders import job_migrate_orders
from shopweave.plans.store import Store
from shopweave.session import Workspace
from shopweave.sources.snapshots import snapshot_tables
from shopweave.sources.tables import overwrite_bucketed, scan_table

NAMES = [
    "users",
    "posts",
    "postmeta",
    "order_items",
    "order_itemmeta",
    "terms",
    "term_taxonomy",
    "term_relationships",
]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The source store as Parquet tables, broadcasts off as for large tables."""
    root = str(tmp_path_factory.mktemp("stored"))
    derived = DerivedStore(spark, sf_dir).src()
    snapshot_tables(Store(**{n: getattr(derived, n) for n in NAMES}), root, "src")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Store(**{n: scan_table(spark, root, "src", n) for n in NAMES})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return plan(frame).count("Exchange hashpartitioning")


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(orders_only(stored.posts).select("id"))
    assert "EqualTo(post_type,shop_order)" in text
    assert "ReadSchema: struct<id:bigint,post_type:string>" in text
    text = plan(eav.core_values(stored.postmeta))
    assert "PushedFilters: [In(meta_key" in text
    assert "ReadSchema: struct<post_id:bigint,meta_key:string,meta_value:string>" in text


def test_wide_orders_shuffle_each_side_once(stored):
    assert shuffles(orders.orders_wide(stored.posts, stored.postmeta)) == 2
    for frame in (
        orders.order_addresses(stored.postmeta, stored.posts),
        orders.order_operational(stored.postmeta, stored.posts),
        eav.pivot_order_core(stored.postmeta, stored.posts),
    ):
        assert shuffles(frame) == 2
        assert plan(frame).count("/postmeta]") == 1


def test_catalog_shuffles_the_texts_once(stored):
    named = catalog.product_terms(stored.term_relationships, stored.term_taxonomy, stored.terms)
    text = plan(catalog.product_catalog(stored.posts, stored.postmeta, named, "shop.example.com"))
    assert text.count("post_content#") and text.count("/posts]") == 1


def test_reports_read_each_table_once(stored):
    text = plan(reports.integrity_check(stored.posts, stored.postmeta))
    assert text.count("FileScan") == 2
    text = plan(statuses.per_status_counts(orders_only(stored.posts)))
    assert text.count("FileScan") == 1


def test_small_join_side_is_hashed(stored):
    """The large side of an export is shuffled but not sorted."""
    exported = orders.export_order_meta(stored.postmeta, stored.posts)
    exported.collect()
    final = plan(exported).split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final and "Sort " not in final


def test_no_cross_or_nested_loop_joins(stored):
    named = catalog.product_terms(stored.term_relationships, stored.term_taxonomy, stored.terms)
    for frame in (
        orders.order_operational(stored.postmeta, stored.posts),
        customers.customers_with_orders(stored.users, stored.postmeta, stored.posts),
        catalog.product_catalog(stored.posts, stored.postmeta, named, "d", in_stock=True),
        orders.export_order_itemmeta(stored.order_itemmeta, stored.order_items, stored.posts),
    ):
        assert "NestedLoop" not in plan(frame) and "Cartesian" not in plan(frame)


def test_bucketed_tables_meet_without_a_shuffle(spark, stored, tmp_path):
    for name, key in (("posts", "id"), ("postmeta", "post_id")):
        overwrite_bucketed(getattr(stored, name), f"bucketed_{name}", key, 8, str(tmp_path / name))
    posts, postmeta = spark.table("bucketed_posts"), spark.table("bucketed_postmeta")
    try:
        for frame in (
            orders.orders_wide(posts, postmeta),
            orders.order_operational(postmeta, posts),
            orders.export_order_meta(postmeta, posts),
        ):
            assert shuffles(frame) == 0
        assert (
            orders.orders_wide(posts, postmeta)
            .exceptAll(orders.orders_wide(stored.posts, stored.postmeta))
            .isEmpty()
        )
    finally:
        spark.sql("DROP TABLE bucketed_posts")
        spark.sql("DROP TABLE bucketed_postmeta")


def test_bucketed_jobs_shuffle_once(spark, stored, tmp_path):
    """Later joins and aggregates over the tables that a job keeps have no shuffle of their own."""
    workspace = Workspace(spark, str(tmp_path))
    empty = Store(**{n: f.limit(0) for n, f in stored.tables().items()})
    plain, _ = job_migrate_orders(stored, empty, False, workspace)
    after, counts = job_migrate_orders(stored, empty, False, workspace, buckets=8)
    try:
        wide = orders.orders_wide_light(after.posts, after.postmeta)
        for frame in (
            wide,
            orders.orders_wide(after.posts, after.postmeta),
            orders.order_operational(after.postmeta, after.posts),
            orders.order_addresses(after.postmeta, after.posts),
            orders.copy_order_meta(after.postmeta, after.posts),
        ):
            assert shuffles(frame) == 0
        assert shuffles(orders.orders_wide_light(plain.posts, plain.postmeta)) > 0
        expected = orders.orders_wide_light(plain.posts, plain.postmeta)
        assert wide.exceptAll(expected).isEmpty() and wide.count() == expected.count() > 0
        assert counts.count() == 4
    finally:
        workspace.forget()
    assert wide.count() > 0
