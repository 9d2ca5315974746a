"""Comparing all members of groups of any size: groups cut into tiles, pairs of tiles as cells.

A group of n members is dealt over ceil(n / tile) tiles by a hash, and each pair of tiles is a cell of
its own, so that a group that holds a third of all rows is spread over many tasks of equal size. A
cell emits a forest of its links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deal(rows: DataFrame, group: list[str], member: str, size: Column, tile: int) -> DataFrame:
    """Rows copied to the cells of their group and sorted by cell: adds own, first, second.

    ``size``: upper bound of the group's members. A row of tile t goes to the cells (t, u) and (u, t).
    """
    tiles = F.ceil(size / tile).cast("int")
    dealt = rows.withColumn("tiles_", tiles).withColumn("own", F.pmod(F.xxhash64(member), "tiles_").cast("int"))
    dealt = dealt.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("tiles_") - 1)))
    cells = dealt.select(
        *rows.columns,
        "own",
        F.least("own", "other_").alias("first"),
        F.greatest("own", "other_").alias("second"),
    )
    keys = [*group, "first", "second"]
    return cells.repartition(*keys).sortWithinPartitions(*keys, "own")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in the first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        differs = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            differs |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(differs) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            key = tuple(column[start] for column in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Components of a cell's members: the smallest position that each one reaches."""

    def __init__(self, members: int):
        self.label = np.arange(members)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        label = self.label
        while True:
            least = np.minimum(label[left], label[right])
            if (least == label[left]).all() and (least == label[right]).all():
                return
            # roots move too, so that all that hang on them follow
            np.minimum.at(label, label[left], least)
            np.minimum.at(label, label[right], least)
            while (label[label] != label).any():
                label[:] = label[label]
