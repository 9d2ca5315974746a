from datetime import datetime

import pytest
from pyspark.sql.utils import AnalysisException
from rows import DAY, post, postmeta, posts, table, values

from shopweave.plans.customers import job_migrate_customers
from shopweave.plans.orders import (
    delete_orders_cascade,
    job_convert_wide,
    job_full,
    job_full_validated,
    job_migrate_orders,
)
from shopweave.plans.statuses import (
    job_convert_statuses,
    job_fix_statuses,
    job_sync_exact,
    job_sync_statuses,
)
from shopweave.plans.steps import Steps
from shopweave.plans.store import Store
from shopweave.plans.validation import job_validate
from shopweave.session import Workspace, shared_root
from shopweave.sources.files import read_status_tsv, write_status_tsv
from shopweave.sources.snapshots import read_snapshot, restore_snapshot, snapshot_tables
from shopweave.sources.tables import jdbc_options, key_predicates, scan_table, split_points

NOW = datetime(2025, 9, 14, 12)


@pytest.fixture
def src(spark):
    return Store(
        users=table(spark, "users", [(5, "ann", "a@example.com", "Ann"), (6, "bob", "b@example.com", "Bob")]),
        usermeta=table(spark, "usermeta", [(50, 5, "src_capabilities", "c"), (60, 6, "nick", "bob")]),
        posts=posts(spark, post(1, status="wc-delivered"), post(2, status="wc-failed")),
        postmeta=postmeta(
            spark, (1, "_customer_user", "5"), (1, "_order_total", "7.5"), (2, "_customer_user", "0")
        ),
        order_items=table(spark, "order_items", [(10, 1, "line_item")]),
        order_itemmeta=table(spark, "order_itemmeta", [(100, 10, "_qty", "1")]),
        options=table(spark, "options", []),
    )


@pytest.fixture
def dst(spark):
    return Store(
        users=table(spark, "users", [(9, "eve", "e@example.com", "Eve")]),
        usermeta=table(spark, "usermeta", [(90, 9, "dst_capabilities", "admin")]),
        posts=posts(spark, post(1, status="wc-pending"), post(8, kind="product", status="publish")),
        postmeta=table(spark, "postmeta", [(801, 1, "old", "x"), (802, 8, "_sku", "s")]),
        order_items=table(spark, "order_items", [(77, 1, "line_item")]),
        order_itemmeta=table(spark, "order_itemmeta", [(770, 77, "_qty", "1")]),
        options=table(spark, "options", [(1, "_transient_a", "", "no"), (2, "keep", "", "yes")]),
    )


def test_missing_customers_arrive(src, dst, workspace):
    after, stats = job_migrate_customers(src, dst, workspace)
    assert values(after.users.select("id")) == [(5,), (9,)]
    assert values(after.usermeta.select("umeta_id", "meta_key")) == [
        (50, "dst_capabilities"),
        (90, "dst_capabilities"),
    ]
    assert values(after.options.select("option_name")) == [("keep",)]
    assert tuple(stats.first()) == (1, 1, 2, 0)


def test_no_missing_customer_changes_nothing(src, dst, workspace):
    here = dst.having(users=src.users)
    after, stats = job_migrate_customers(src, here, workspace)
    assert after is here and stats.first().missing_customers == 0


def test_replace_removes_old_orders_first(src, dst, workspace):
    left = delete_orders_cascade(dst)
    assert values(left.posts.select("id")) == [(8,)]
    assert values(left.postmeta.select("meta_id")) == [(802,)]
    assert left.order_items.count() == left.order_itemmeta.count() == 0
    after, counts = job_migrate_orders(src, dst, replace=True, workspace=workspace)
    assert values(counts) == [
        ("order_itemmeta", 1),
        ("order_items", 1),
        ("order_meta", 3),
        ("orders", 2),
    ]
    assert values(after.posts.select("id", "post_status")) == [
        (1, "wc-completed"),
        (2, "wc-cancelled"),
        (8, "publish"),
    ]


def test_without_replace_existing_orders_win(src, dst):
    after, _ = job_migrate_orders(src, dst, replace=False)
    assert values(after.posts.select("id", "post_status"))[0] == (1, "wc-pending")
    assert after.order_items.count() == 2


def test_source_without_orders_is_refused(spark, src, dst):
    with pytest.raises(ValueError):
        job_migrate_orders(src.having(posts=posts(spark, post(8, kind="product"))), dst, replace=True)


def test_full_migration(src, dst, workspace):
    after, report = job_full(src, dst, workspace, convert_again=True)
    assert dict(values(report)) == {"Traditional Orders": 2, "HPOS Orders": 2, "Customers": 2}
    assert values(after.wc_orders.select("id", "total_amount"))[0][0] == 1


def test_wide_conversion(dst, workspace):
    after, check = job_convert_wide(dst, workspace)
    assert tuple(check.first()) == (1, 1, "complete")
    assert values(after.wc_orders_meta) == [(1, "old", "x")]
    assert after.options.count() == 6
    assert after.wc_order_operational_data.count() == 1 and after.wc_order_addresses.count() == 0


def test_metadata_is_read_once_for_the_wide_tables(spark, dst, workspace):
    """Its rows are counted where they are read; the wide tables are those of the orders alone."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [
        (101, 1, "_order_total", "7.5"),
        (102, 1, "_billing_city", "Rome"),
        (103, 1, "_billing_city", "Pisa"),
        (104, None, "_order_total", "1"),
        (802, 8, "_shipping_city", "Bari"),
    ]
    meta = table(spark, "postmeta", rows)
    watched = meta.mapInArrow(counted, meta.schema)
    after, check = job_convert_wide(dst.having(postmeta=watched), workspace)
    assert check.first().result == "complete"
    assert read.value == len(rows)
    assert values(after.wc_orders_meta) == [(1, "_billing_city", "Pisa"), (1, "_billing_city", "Rome"), (1, "_order_total", "7.5")]
    assert [(r.order_id, r.address_type, r.city) for r in after.wc_order_addresses.collect()] == [(1, "billing", "Rome")]
    assert [(r.id, float(r.total_amount)) for r in after.wc_orders.collect()] == [(1, 7.5)]
    assert after.wc_order_operational_data.count() == 1
    assert set(after.folders) == {"wc_orders", "wc_orders_meta", "wc_order_addresses", "wc_order_operational_data", "options"}


def test_fix_statuses(src):
    after, distribution = job_fix_statuses(src, NOW)
    assert dict(values(distribution)) == {"wc-completed": 1, "wc-cancelled": 1}
    assert values(after.status_backup.select("order_id", "original_status")) == [
        (1, "wc-delivered"),
        (2, "wc-failed"),
    ]
    again, _ = job_fix_statuses(after, NOW)
    assert again is after
    unchanged, _ = job_convert_statuses(after)
    assert unchanged is after


def test_sync_jobs(spark, src, dst, workspace):
    wide = spark.createDataFrame([(1, "pending", DAY)], "id bigint, status string, date_updated_gmt timestamp_ntz")
    with_wide = dst.having(wc_orders=wide)
    after, distribution = job_sync_exact(spark, src, with_wide, NOW, workspace)
    assert values(distribution) == [("wc-delivered", 1)]
    assert values(after.wc_orders) == [(1, "delivered", NOW)]
    after, distribution = job_sync_statuses(spark, src, with_wide, NOW, workspace, convert=True)
    assert values(distribution) == [("wc-completed", 1)]
    assert values(after.wc_orders) == [(1, "completed", NOW)]


def test_validation_is_one_long_table(src, dst):
    report = {(r.report, r.metric): r.value for r in job_validate(src, dst).collect()}
    assert report["orders", "percent"] == "50" and report["orders", "level"] == "low"
    assert report["statuses", "wc-pending percent"] == "100.00"


def test_status_file(spark, src, tmp_path):
    path = str(tmp_path / "feed")
    write_status_tsv(src.posts, path)
    assert [r.value for r in spark.read.text(path).collect()] == ["1\twc-delivered", "2\twc-failed"]
    assert values(read_status_tsv(spark, path)) == [(1, "wc-delivered"), (2, "wc-failed")]
    named = str(tmp_path / "named")
    spark.createDataFrame([("ID\tpost_status",), ("7\twc-x",), ("8\t",)], "value string").coalesce(
        1
    ).write.text(named)
    assert values(read_status_tsv(spark, named, header=True)) == [(7, "wc-x"), (8, "")]


def test_one_workspace_serves_two_runs(src, dst, workspace):
    for _ in range(2):
        after, counts = job_migrate_orders(src, dst, replace=True, workspace=workspace)
    assert after.posts.count() == 3 and counts.count() == 4


def test_snapshot_and_restore(spark, dst, tmp_path):
    folder = str(tmp_path / "snapshots")
    snapshot_tables(dst, folder, "t1")
    with pytest.raises(AnalysisException):
        snapshot_tables(dst, folder, "t1")
    names = dst.tables()
    assert set(names) == set(read_snapshot(spark, folder, "t1", names).tables())
    restored = restore_snapshot(spark, folder, "t1", names, str(tmp_path / "live" / "dst"))
    assert values(restored.postmeta) == values(dst.postmeta)
    assert values(scan_table(spark, str(tmp_path / "live"), "dst", "options")) == values(dst.options)
    with pytest.raises(ValueError):
        restore_snapshot(spark, folder, "t1", names, f"{folder}/t1")


def test_parallel_database_scan_options():
    options = jdbc_options("jdbc:x", "posts", "ID", (1, 900), 12, {"user": "u"})
    assert options["partitionColumn"] == "ID" and options["numPartitions"] == "12"
    assert options["user"] == "u"


def test_shared_root_is_the_cluster_setting():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Context:
        master = "spark://host"

        def getConf(self):
            return Conf(None)

    class Session:
        sparkContext = Context()

        def __init__(self, value):
            self.conf = Conf(value)

    assert shared_root(Session("hdfs://x/dir/")) == "hdfs://x/dir"
    with pytest.raises(ValueError):
        shared_root(Session(None))


def steps_of(job, *args, **kwargs):
    steps = Steps()
    after, _ = job(*args, **kwargs, steps=steps)
    return after, steps.values()


def test_steps_of_an_order_migration(spark, src, dst, workspace):
    after, seen = steps_of(job_migrate_orders, src, dst, True, workspace)
    assert seen == {("orders", "expected"): 2, ("orders", "imported"): 2}
    after, seen = steps_of(job_full, src, dst, workspace, replace=False)
    assert seen == {("orders", "expected"): 2, ("orders", "imported"): 2}
    # the destination's order 1 stays and counts as imported, as in the comparison of both sides
    assert values(after.posts.select("id", "post_status"))[0] == (1, "wc-pending")


def test_steps_of_fixing_statuses(spark, src, workspace):
    posts_ = src.posts.unionByName(posts(spark, post(3, status="wc-odd"), post(4, kind="product", status="wc-failed")))
    after, seen = steps_of(job_fix_statuses, src.having(posts=posts_), NOW, workspace)
    assert (seen["conversion", "total"], seen["conversion", "left"]) == (2, 1)
    assert (seen["before", "wc-delivered"], seen["after", "wc-delivered"]) == (1, 0)
    assert (seen["before", "total"], seen["after", "total"], seen["after", "other"]) == (3, 3, 1)
    assert after.posts.columns == src.posts.columns
    _, nothing = steps_of(job_fix_statuses, after, NOW, workspace)
    assert nothing == {}


def test_steps_of_a_synchronisation(spark, src, dst, workspace):
    after, seen = steps_of(job_sync_exact, spark, src, dst, NOW, workspace)
    assert (seen["source", "wc-delivered"], seen["source", "total"]) == (1, 2)
    assert (seen["destination before", "wc-pending"], seen["destination after", "wc-delivered"]) == (1, 1)
    assert (seen["orders", "found"], seen["orders", "not_found"]) == (1, 0)
    plain, _ = job_sync_exact(spark, src, dst, NOW, workspace)
    assert values(after.posts) == values(plain.posts)


def test_steps_need_no_pass_of_their_own(spark, src, dst, workspace, monkeypatch):
    """The posts are read for the write alone: the metrics are part of its plan."""
    written = []
    keep = Workspace.keep
    monkeypatch.setattr(
        Workspace, "keep", lambda self, frame, name: written.append((name, frame)) or keep(self, frame, name)
    )
    steps = Steps()
    job_fix_statuses(src, NOW, workspace, steps)
    plans = {name: frame._jdf.queryExecution().optimizedPlan().toString() for name, frame in written}
    assert list(plans) == ["posts"] and plans["posts"].count("CollectMetrics") == 3
    assert len(steps.values()) == 5 + 2 * 12


def test_empty_report_has_its_columns(spark):
    assert Steps().report(spark).columns == ["step", "metric", "value"]


def test_items_stay_where_the_destination_has_no_orders(spark, src, dst, workspace):
    bare = dst.having(posts=posts(spark, post(8, kind="product", status="publish")))
    assert delete_orders_cascade(bare) is bare
    after, _ = job_migrate_orders(src, bare, replace=True, workspace=workspace)
    assert values(after.order_items.select("order_item_id")) == [(10,), (77,)]


def test_full_migration_validated(src, dst, workspace):
    after, report = job_full_validated(src, dst, workspace)
    found = {(r.report, r.metric): r.value for r in report.collect()}
    assert found["orders", "percent"] == "100" and found["users", "destination_users"] == "2"
    assert {"users", "order_items", "wc_orders"} <= set(after.folders)


def test_split_points_give_even_shares(spark):
    """Keys with gaps: equal ranges would put nearly all rows into one share."""
    keys = spark.range(20_000).selectExpr("CAST(pow(1.0005, id) * 100 AS bigint) + id AS k")
    points = split_points(keys, "k", 10)
    shares = [keys.where(p).count() for p in key_predicates(points, "k")]
    assert sum(shares) == 20_000 and max(shares) <= 2_200 and len(shares) == 10
    low, high = keys.selectExpr("min(k)", "max(k)").first()
    equal = keys.where(f"k < {low + (high - low) // 10}").count()
    assert equal > 10_000


def test_predicates_hold_each_row_once(spark):
    keys = spark.createDataFrame([(x,) for x in [None, 1, 1, 1, 2, 9, None]], "k bigint")
    for points in ([], [1], [1, 2], [5, 7, 100]):
        assert sum(keys.where(p).count() for p in key_predicates(points, "k")) == 7
    assert split_points(keys.where("false"), "k", 4) == []
    assert split_points(keys, "k", 1) == []
