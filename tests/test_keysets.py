"""Rows by keys that are packed: the same rows as a join, without a shuffle of them."""

import pytest
from rows import post, posts, postmeta, values

from shopweave.operators import keysets, merge, orders

EDGES = [-(2**63), -257, -256, -65, -64, -1, 0, 1, 62, 63, 64, 65, 127, 128, 191, 192, 255, 256, 257, 10**15, 2**63 - 1, None]


def frame(spark, ids, name="k"):
    return spark.createDataFrame([(i, f"row {n}") for n, i in enumerate(ids)], f"{name} bigint, t string")


def held(node, found):
    """Nodes of an executed plan, those of adaptive stages included."""
    found.append(node.nodeName())
    children = node.children()
    for inner in [children.apply(i) for i in range(children.size())]:
        held(inner, found)
    if node.nodeName() == "AdaptiveSparkPlan":
        held(node.executedPlan(), found)
    elif "QueryStage" in node.nodeName():
        held(node.plan(), found)
    return found


@pytest.mark.parametrize("most", [keysets.MOST_BLOCKS, 2, -1])
@pytest.mark.parametrize("keys", [[], [None], EDGES, EDGES[::2], EDGES[1::2] + EDGES[1::2], list(range(60, 70))])
def test_same_rows_as_a_join(spark, monkeypatch, keys, most):
    monkeypatch.setattr(keysets, "MOST_BLOCKS", most)
    rows, others = frame(spark, EDGES + [63, 64, None]), frame(spark, keys)
    for use, how in ((keysets.only_keys, "left_semi"), (keysets.without_keys, "left_anti")):
        assert values(use(rows, others, "k")) == values(rows.join(others.select("k"), "k", how))


def test_rows_are_not_shuffled(spark, tmp_path):
    """Ids that are too many for a broadcast as they are; the metadata stays where it is."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        all_posts = posts(spark, *(post(i, kind="shop_order" if i % 3 else "product") for i in range(300)))
        all_posts.write.parquet(str(tmp_path / "posts"))
        postmeta(spark, *((i, "a", "x") for i in range(310))).write.parquet(str(tmp_path / "meta"))
        stored, meta = spark.read.parquet(str(tmp_path / "posts")), spark.read.parquet(str(tmp_path / "meta"))
        exported = orders.export_order_meta(meta, stored)
        kept = orders.meta_without_orders(meta, stored)
        merged = merge.insert_ignore(kept, exported, "meta_id", unique=True)
        assert (len(exported.collect()), len(kept.collect()), len(merged.collect())) == (200, 110, 310)
        for rows in (exported, kept, merged):
            names = held(rows._jdf.queryExecution().executedPlan(), [])
            assert "BroadcastHashJoin" in names and not {"ShuffledHashJoin", "SortMergeJoin"} & set(names)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
