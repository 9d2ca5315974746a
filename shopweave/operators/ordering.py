"""Global positions of rows without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(frame: DataFrame, order: Sequence[Column], workspace) -> DataFrame:
    """``frame`` with ``position`` 1, 2, 3 … in a total order.

    A window over all rows would sort them in one task. Here rows are range-partitioned, sorted
    and counted off within each partition; the partition's start is then added. Only the list of
    partition sizes passes through one task and is broadcast: a row per partition, not per data
    row. The sorted rows are written to the workspace first, because the ranges of a second run
    of the same plan may differ.
    """
    part = F.spark_partition_id()
    placed = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumns(
        {"part": part, "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    kept = workspace.keep(placed, "sorted")
    sizes = kept.groupBy("part").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    return (
        kept.join(F.broadcast(starts), "part")
        .withColumn("position", F.col("start") + F.col("place") + 1)
        .drop("part", "place", "start")
    )
