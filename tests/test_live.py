"""Live views over the folders that jobs write."""

import uuid

import pytest
from rows import post, postmeta, posts, table, values

from shopweave.plans.live import job_convert_wide_live, live_folder, live_store, swap_back, swap_in
from shopweave.plans.orders import WIDE_TABLES
from shopweave.plans.store import Store


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex}_"
    yield name
    for view in spark.catalog.listTables():
        if view.name.startswith(name):
            spark.sql(f"DROP VIEW {view.name}")


@pytest.fixture
def dst(spark):
    return Store(
        posts=posts(spark, post(1, status="wc-pending"), post(8, kind="product")),
        postmeta=postmeta(spark, (1, "_order_total", "5"), (8, "_sku", "s")),
        options=table(spark, "options", [(2, "keep", "", "yes")]),
    )


def users(spark, *ids):
    return Store(users=table(spark, "users", [(i, f"u{i}", "", "") for i in ids]))


def test_readers_see_one_state_or_the_other(spark, workspace, prefix):
    view = f"{prefix}users"
    assert live_folder(spark, view) is None
    first, second = (users(spark, *ids).written(workspace).folders for ids in ([1], [1, 2]))
    live = swap_in(spark, first, prefix)
    assert live.users.count() == 1 and live_folder(spark, view) == first["users"]
    swap_in(spark, second, prefix)
    assert spark.table(view).count() == 2
    swap_in(spark, second, prefix)  # again: nothing changes, and the way back stays open
    assert swap_back(spark, ["users"], prefix).users.count() == 1
    assert swap_back(spark, ["users"], prefix).users.count() == 2


def test_columns_follow_the_new_tables(spark, workspace, prefix):
    swap_in(spark, users(spark, 1).written(workspace).folders, prefix)
    more = Store(users=spark.range(3).withColumnRenamed("id", "number")).written(workspace)
    assert swap_in(spark, more.folders, prefix).users.columns == ["number"]


def test_first_swap_has_no_way_back(spark, workspace, prefix):
    swap_in(spark, users(spark, 1).written(workspace).folders, prefix)
    with pytest.raises(ValueError, match="no earlier tables of users"):
        swap_back(spark, ["users"], prefix)


def test_foreign_views_are_left_alone(spark, workspace, prefix):
    spark.sql(f"CREATE VIEW {prefix}users AS SELECT 1 AS one")
    both = users(spark, 1).having(options=table(spark, "options", [])).written(workspace)
    with pytest.raises(ValueError, match="no swap has made it"):
        swap_in(spark, both.folders, prefix)
    assert spark.table(f"{prefix}users").columns == ["one"]
    assert not spark.catalog.tableExists(f"{prefix}options")


def test_wide_tables_go_live_once_they_are_complete(spark, dst, workspace, prefix):
    after, check = job_convert_wide_live(spark, dst, workspace, prefix)
    assert tuple(check.first()) == (1, 1, "complete")
    live = live_store(spark, WIDE_TABLES, prefix)
    assert values(live.wc_orders.select("id", "status")) == [(1, "pending")]
    empty = dst.having(posts=posts(spark, post(8, kind="product")))
    with pytest.raises(ValueError, match="the old ones stay"):
        job_convert_wide_live(spark, empty, workspace, prefix)
    assert spark.table(f"{prefix}wc_orders").count() == 1


def test_a_changed_table_is_not_the_stored_one(spark, dst, workspace):
    stored = dst.written(workspace, "posts", "options")
    assert set(stored.folders) == {"posts", "options"}
    assert set(stored.having(posts=dst.posts).folders) == {"options"}
    assert "folders" not in stored.tables()
