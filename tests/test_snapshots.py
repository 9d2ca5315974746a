"""Snapshots: complete ones only, and restored as they were."""

import pytest
from pyspark.sql import functions as F
from rows import post, postmeta, posts, table, values

from shopweave.plans.store import Store
from shopweave.sources.snapshots import (
    digest_of,
    read_manifest,
    read_snapshot,
    restore_snapshot,
    snapshot_tables,
)


@pytest.fixture
def store(spark):
    return Store(
        users=table(spark, "users", [(9, "eve", "e@example.com", "Eve"), (9, "eve", None, "Eve")]),
        posts=posts(spark, post(1, status="wc-pending"), post(8, kind="product")),
        postmeta=postmeta(spark, (1, "a", "x"), (8, "_sku", None)),
        options=table(spark, "options", []),
    )


def test_manifest_has_every_table(spark, store, tmp_path):
    snapshot_tables(store, str(tmp_path), "t1")
    lines = {r.table_name: r for r in read_manifest(spark, str(tmp_path), "t1").collect()}
    assert {n: r.n_rows for n, r in lines.items()} == {"users": 2, "posts": 2, "postmeta": 2, "options": 0}
    assert lines["options"].digest == "0" and "post_status:string" in lines["posts"].columns


def test_whole_store_comes_back(spark, store, tmp_path):
    snapshot_tables(store, str(tmp_path / "s"), "t1")
    restored = restore_snapshot(spark, str(tmp_path / "s"), "t1", None, str(tmp_path / "live"))
    assert set(restored.tables()) == set(store.tables())
    for name, frame in store.tables().items():
        assert values(restored.tables()[name]) == values(frame)


def test_snapshot_that_stopped_half_way_is_refused(spark, store, tmp_path):
    folder, live = str(tmp_path / "s"), str(tmp_path / "live")
    broken = store.having(posts=store.posts.withColumn("id", F.raise_error(F.lit("lost")).cast("bigint")))
    with pytest.raises(Exception, match="lost"):
        snapshot_tables(broken, folder, "t1")
    assert (tmp_path / "s" / "t1" / "users").is_dir()
    for use in (
        lambda: read_manifest(spark, folder, "t1"),
        lambda: read_snapshot(spark, folder, "t1", ["users"]),
        lambda: restore_snapshot(spark, folder, "t1", ["users"], live),
    ):
        with pytest.raises(ValueError, match="not completed"):
            use()
    assert not (tmp_path / "live").exists()


def test_changed_files_are_noticed(spark, store, tmp_path):
    folder = str(tmp_path / "s")
    snapshot_tables(store, folder, "t1")
    store.users.limit(1).write.mode("append").parquet(f"{folder}/t1/users")
    with pytest.raises(ValueError, match="differs from its manifest in users"):
        restore_snapshot(spark, folder, "t1", None, str(tmp_path / "live"))


def test_unknown_table_and_empty_store_are_refused(spark, store, tmp_path):
    snapshot_tables(store, str(tmp_path), "t1")
    with pytest.raises(ValueError, match="has no terms"):
        read_snapshot(spark, str(tmp_path), "t1", ["users", "terms"])
    with pytest.raises(ValueError):
        snapshot_tables(Store(), str(tmp_path), "t2")


def test_digest_tells_rows_apart_and_not_their_order(spark):
    def digest(*rows):
        frame = spark.createDataFrame(list(rows), "a string, b string, m map<string,int>, t timestamp_ntz")
        return frame.agg(digest_of(frame)).first()[0]

    one, two = ("x", None, {"k": 1}, None), (None, "x", None, None)
    assert digest(one, two) == digest(two, one)
    assert len({digest(one), digest(two), digest(one, one), digest(("x", "", {"k": 1}, None)), digest()}) == 5
