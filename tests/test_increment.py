"""Merging few rows into a large table: same rows as the ordinary merge, and what reaches the scan."""

import pytest
from pyspark.sql import functions as F
from rows import values

from shopweave.operators import merge
from shopweave.operators.increment import (
    absent_rows,
    increment,
    increment_rejects,
    insert_increment,
    present_keys,
)

DST = "id bigint, t string"


@pytest.fixture
def large(spark, tmp_path):
    """20,000 rows with every third id, in key order as a table grows."""
    path = str(tmp_path / "large")
    rows = spark.range(20_000).select((F.col("id") * 3).alias("id"), F.lit("old").alias("t"))
    rows.repartitionByRange(4, "id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def as_large(spark):
    """Settings under which the small test tables are treated as large ones."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def incoming(spark, *ids):
    return spark.createDataFrame([(i, f"new {i}") for i in ids], DST)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "ids",
    [[], [None], [3, 4, 5, 6], [4, 4, 3], [60_001, 70_000], [-5, 59_997, None, None], list(range(0, 60_000, 7))],
)
def test_same_rows_as_the_ordinary_merge(spark, large, workspace, ids):
    rows = incoming(spark, *ids)
    new = increment(rows, "id", workspace)
    assert values(insert_increment(large, new)) == values(merge.insert_ignore(large, rows, "id"))
    rejected = merge.insert_ignore_rejects(large, merge.one_per_key(rows, "id"), "id")
    assert values(increment_rejects(large, new)) == values(rejected)


def test_bounds_come_from_the_write(spark, workspace):
    new = increment(incoming(spark, 9, 4, 4, None), "id", workspace)
    assert (new.count, new.low, new.high) == (3, 4, 9)
    assert increment(incoming(spark), "id", workspace).low is None


def test_nothing_new_leaves_the_destination(spark, large, workspace):
    assert insert_increment(large, increment(incoming(spark), "id", workspace)) is large


def test_columns_of_one_side_stay(spark, large, workspace):
    more = incoming(spark, 1).withColumn("extra", F.lit(7))
    after = insert_increment(large, increment(more, "id", workspace, unique=True))
    assert values(after.where("id < 2")) == [(0, "old", None), (1, "new 1", 7)]


def test_range_and_bloom_filter_reach_the_scan(spark, large, workspace, as_large):
    new = increment(incoming(spark, *range(30_000, 30_400)), "id", workspace)
    frame = present_keys(large, new)
    text = plan(frame)
    scan = next(x for x in text.splitlines() if "FileScan" in x and "/large]" in x)
    assert "GreaterThanOrEqual(id,30000), LessThanOrEqual(id,30399)" in scan
    assert "ReadSchema: struct<id:bigint>" in scan
    assert "might_contain" in text and "bloom_filter_agg" in text
    assert frame.count() == 134


def test_few_destination_keys_are_shuffled(spark, large, workspace, as_large):
    """Rows that enter the shuffles: some hundreds, not the destination's 20,000."""
    new = increment(incoming(spark, *range(30_000, 30_400)), "id", workspace)
    frame = absent_rows(large, new)
    assert frame.count() == 266
    frame.collect()
    node, written = frame._jdf.queryExecution().executedPlan(), []

    def walk(node):
        metrics = node.metrics()
        if "Exchange" in node.nodeName() and metrics.contains("shuffleRecordsWritten"):
            written.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        for inner in [children.apply(i) for i in range(children.size())]:
            walk(inner)
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(node)
    assert written and sum(written) < 2_000
