"""Tables held against each other by content."""

import random

import pytest
from pyspark.sql import functions as F
from rows import values

from shopweave.operators import compare

SCHEMA = "id bigint, a string, b double, c timestamp_ntz"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(left, right):
    """Keys whose bags of rows differ."""
    out = []
    for key in {r[0] for r in left} | {r[0] for r in right}:
        here, there = (sorted((r for r in side if r[0] == key), key=repr) for side in (left, right))
        if here != there:
            out.append((key, "missing" if not there else "extra" if not here else "changed"))
    return sorted(out, key=repr)


BASE = [(i * 7 - 300, f"t{i}", i / 2, None) for i in range(200)]


@pytest.mark.parametrize("ranges", [1, 16, 1024])
def test_rows_that_differ_though_counts_agree(spark, workspace, ranges):
    dice = random.Random(ranges)
    other = [r for r in BASE if dice.random() > 0.03]
    other = [(k, a if dice.random() > 0.03 else None, b, c) for k, a, b, c in other]
    other += [(k, "new", None, None) for k in range(1, 1 + len(BASE) - len(other))]
    assert len(other) == len(BASE)
    found = compare.differences(rows_of(spark, BASE), rows_of(spark, other), "id", ranges=ranges, workspace=workspace)
    assert values(found) == plain(BASE, other) != []


def test_nulls_repeats_and_empty_sides(spark):
    left = [(None, "x", 1.0, None), (5, None, None, None), (6, "", None, None), (7, "r", 1.0, None), (7, "r", 1.0, None)]
    right = [(None, "y", 1.0, None), (5, None, None, None), (6, None, None, None), (7, "r", 1.0, None)]
    frames = [rows_of(spark, x) for x in (left, right, [])]
    assert values(compare.differences(frames[0], frames[1], "id")) == plain(left, right)
    assert values(compare.differences(frames[0], frames[2], "id")) == plain(left, [])
    assert values(compare.differences(frames[2], frames[1], "id")) == plain([], right)
    assert values(compare.differences(frames[2], frames[2], "id")) == []
    assert values(compare.differences(frames[0], frames[0], "id")) == []


def test_columns_of_one_side_and_chosen_ones(spark):
    left, right = rows_of(spark, BASE), rows_of(spark, BASE).withColumn("more", F.lit(1)).withColumn("a", F.lit("z"))
    assert compare.differences(left, right, "id").count() == len(BASE)
    assert compare.differences(left, right.select("more", "b", "id", "c"), "id").count() == 0
    assert compare.differences(left, right, "id", columns=["b"]).count() == 0


def test_bounds_of_the_ranges_reach_the_scans(spark, tmp_path):
    left = spark.range(100_000).select("id", F.lit("same").alias("a"))
    right = left.withColumn("a", F.when(F.col("id") == 50_123, "other").otherwise(F.col("a")))
    frames = []
    for name, frame in (("left", left), ("right", right)):
        frame.write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    found = compare.differences(*frames, "id")
    scans = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert len(scans) == 2 and all("GreaterThanOrEqual(id,50" in x and "LessThanOrEqual(id,50" in x for x in scans)
    assert values(found) == [(50_123, "changed")]


def test_stretches_cover_their_ranges():
    parts = list(range(1, 1000, 3))
    runs = compare._stretches(parts, -50, 10_000, 1024)
    assert len(runs) <= compare.STRETCHES
    width = 10_051 / 1024
    for part in parts:
        first, last = -50 + (part - 1) * width, -50 + part * width
        assert any(a <= first and last <= b for a, b in runs)
