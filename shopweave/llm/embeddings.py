"""Embedding near-duplicates by int8 quantised tile products with rigorous error bounds.

A unit vector x is stored as a scale s and int8 codes q; r = |x - s q| is measured, so that the
product of two vectors differs from s s' (q . q') by at most r |s' q'| + r' |s q| + r r'. A tile's
products of codes are whole numbers, exact in single precision. A pair whose upper bound is below the
threshold is no link, one whose lower bound is above it is one, and only the pairs between are
computed again, in double precision.

Equal vectors are one class first. Classes meet in cells of two tiles each; a cell emits counts and a
forest of links. Vectors that are null, empty, zero or hold null or non-finite components link with
nothing, and vectors of different lengths don't link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .components import components
from .tiles import Forest, deal, runs

THRESHOLD = 0.9
TILE = 4096
ROWS = 512
#: Covers the rounding of the bounds themselves, which are computed in single precision.
SLACK = 1e-5
#: Whole numbers up to 2^24 are exact in single precision: so many products of two codes.
EXACT = (1 << 24) // (127 * 127)


def usable(vector: str) -> Column:
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


class Tile:
    """Unit vectors in double precision with their codes, scales and measured errors."""

    def __init__(self, vectors: np.ndarray):
        largest = np.abs(vectors).max(axis=1, keepdims=True)
        scaled = vectors / largest
        self.unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
        self.scale = np.abs(self.unit).max(axis=1) / 127
        codes = np.rint(self.unit / self.scale[:, None])
        self.codes = codes.astype(np.int8)
        self.error = np.sqrt(((self.unit - codes * self.scale[:, None]) ** 2).sum(axis=1))

    def products(self, other: Tile, rows: slice) -> np.ndarray:
        """Products of codes; long vectors in parts that stay exact."""
        total = None
        for start in range(0, self.codes.shape[1], EXACT):
            own, their = (x[:, start : start + EXACT].astype(np.float32) for x in (self.codes[rows], other.codes))
            part = own @ their.T
            total = part if total is None else total + part
        return total


def linked(left: Tile, right: Tile, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in left, in right) of the pairs with at least the threshold, a block at a time."""
    # |s q| <= 1 + r, so the error of a pair is at most r (1 + r') + r' (1 + r) + r r'
    worst = right.error.max()
    for start in range(0, len(left.unit), ROWS):
        rows = slice(start, start + ROWS)
        bound = left.error[rows] * (1 + worst) + worst * (1 + left.error[rows]) + left.error[rows] * worst
        value = left.products(right, rows)
        value *= right.scale.astype(np.float32)
        scale = left.scale[rows]
        i, j = np.nonzero(value >= ((threshold - bound - SLACK) / scale).astype(np.float32)[:, None])
        if not len(i):
            continue
        near = value[i, j] * scale[i]
        e, f = left.error[rows][i], right.error[j]
        own = e * (1 + f) + f * (1 + e) + e * f + SLACK
        sure, open_ = near - own >= threshold, np.abs(near - threshold) <= own
        at = np.flatnonzero(open_)
        for begin in range(0, len(at), 1 << 16):
            k = at[begin : begin + (1 << 16)]
            exact = np.einsum("ij,ij->i", left.unit[rows][i[k]], right.unit[j[k]])
            sure[k] = exact >= threshold
        yield start + i[sure], j[sure]


def compare_cells(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (node, links, root) of each cell's members that have links in it."""
    for cell in runs(batches, 3):
        own, first = cell.column("own").to_numpy(), cell.column("first")[0].as_py()
        alone = first == cell.column("second")[0].as_py()
        left = np.flatnonzero(own == first)
        right = left if alone else np.flatnonzero(own != first)
        if not len(left) or not len(right):
            continue
        flat = pa.concat_arrays(cell.column("vector").chunks).flatten().to_numpy(zero_copy_only=False)
        vectors = flat.astype(np.float64).reshape(cell.num_rows, -1)
        copies = cell.column("copies").to_numpy()
        tile = Tile(vectors[left])
        other = tile if alone else Tile(vectors[right])
        forest, count = Forest(cell.num_rows), np.zeros(cell.num_rows, np.int64)
        for i, j in linked(tile, other, threshold):
            i, j = left[i], right[j]
            if alone:
                i, j = i[i != j], j[i != j]
            else:
                count += np.bincount(j, copies[i], cell.num_rows).astype(np.int64)
            count += np.bincount(i, copies[j], cell.num_rows).astype(np.int64)
            forest.link(i, j)
        at = np.flatnonzero(count)
        if len(at):
            nodes = pa.concat_arrays(cell.column("node").chunks)
            yield pa.RecordBatch.from_arrays(
                [nodes.take(pa.array(at)), pa.array(count[at]), nodes.take(pa.array(forest.label[at]))],
                names=["node", "links", "root"],
            )


def near_duplicates(
    rows: DataFrame,
    workspace: Workspace,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Each row's key with n_links, and component_id: the smallest key it reaches by links.

    Equal rows are vectors of their own that link with each other. Null keys are passed over in the
    minimum, unless a component has no other.
    """
    content = F.col("vector").cast("array<double>").cast("string").cast("binary")
    keyed = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    keyed = keyed.select("key", "vector", F.when(usable("vector"), F.unhex(F.md5(content))).alias("node"))
    classes = keyed.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("key").alias("least"), F.first("vector").alias("vector")
    )
    classes = workspace.keep(classes, "classes")
    members = classes.select("node", F.size("vector").alias("dim"), "copies", "vector")
    cells = deal(members, ["dim"], "node", F.lit(max(1, classes.count())), TILE)
    found = cells.select("dim", "first", "second", "own", "node", "copies", "vector").mapInArrow(
        lambda batches: compare_cells(batches, threshold), "node binary, links long, root binary"
    )
    found = workspace.keep(found, "cells")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), workspace)
    rooted = classes.select("node", "copies", "least").join(roots, "node", "left").join(counts, "node", "left")
    rooted = rooted.select(
        "node", "least", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rooted = workspace.keep(rooted, "rooted")
    least = workspace.keep(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    known = workspace.keep(rooted.join(least, "root").select("node", "n_links", "component_id"), "known")
    alone = keyed.where("node is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    linked_rows = keyed.where("node is not null").select("key", "node").join(known, "node")
    return linked_rows.select("key", "n_links", "component_id").unionByName(alone).withColumnRenamed("key", key)
