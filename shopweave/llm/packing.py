"""Best-fit packing of token sequences, with the large items matched in pairs.

The plan is made from the number of pieces of each length alone, of which there are at most
``capacity``: pieces longer than a third of the capacity, at most two of which fit into a sequence,
are matched greedily, the longest with the longest that still fits; the others, from long to short,
go to the smallest gap that holds them. Pieces of a length are alike, so a step fills many sequences
at once and the plan's size doesn't depend on the number of pieces.

Every piece then gets its place by its rank among the pieces of its length. The rank is counted
within each written part first, then parts are added up, so that no task sees all of a length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .bpe import encoded

CAPACITY = 4096


def token_pieces(docs: DataFrame, path: str, capacity: int, text: str, key: str, end_id: int = 1) -> DataFrame:
    """Each document's ids, then ``end_id``, cut into pieces of ``capacity``: key, piece, start,
    length, ids_crc32, and the piece's part and rank among the part's pieces of its length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out = defaultdict(list)
            rows = []
            for first, ids, counts in encoded(path, batch.column(1)):
                ends = np.cumsum(counts)
                for row, (end, count) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True), first):
                    own = np.append(ids[end - count : end], end_id).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        cut_ids = own[start : start + capacity]
                        rows.append(row)
                        out["piece"].append(piece)
                        out["start"].append(start)
                        out["length"].append(len(cut_ids))
                        out["ids_crc32"].append(zlib.crc32(cut_ids.tobytes()))
                        out["rank"].append(int(seen[len(cut_ids)]))
                        seen[len(cut_ids)] += 1
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(out["piece"], pa.int32())]
            columns += [pa.array(out[x], pa.int64()) for x in ("start", "length", "ids_crc32", "rank")]
            columns += [pa.array([part] * len(rows), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["key", "piece", "start", "length", "ids_crc32", "rank", "part"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, rank long, part int"
    return docs.select(F.col(key), F.col(text)).mapInArrow(cut, schema)


class Plan:
    """Where the pieces of each length go: for ranks from ``ranks[k]`` on, sequence ``bases[k]`` and
    the following ones take ``each[k]`` pieces each, from ``offsets[k]`` on."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(counts)
        self.used: dict[int, int] = defaultdict(int)
        self.steps: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: (base, sequences)
        self.sequences = 0
        self.match_large()
        self.fill_gaps()

    def put(self, length: int, base: int, bins: int, each: int, offset: int) -> None:
        self.steps[length].append((self.used[length], base, each, offset))
        self.used[length] += bins * each
        self.left[length] -= bins * each

    def open(self, bins: int) -> int:
        self.sequences += bins
        return self.sequences - bins

    def match_large(self) -> None:
        large = [n for n in range(self.capacity, self.capacity // 3, -1) if self.left.get(n)]
        for length in large:
            while count := self.left[length]:
                room = self.capacity - length
                mate = next((n for n in large if n <= min(room, length) and self.left[n]), 0)
                if mate == length and count == 1:
                    mate = next((n for n in large if n < length and self.left[n]), 0)
                bins = count if not mate else count // 2 if mate == length else min(count, self.left[mate])
                base = self.open(bins)
                if mate == length:
                    self.put(length, base, bins, 2, 0)
                else:
                    self.put(length, base, bins, 1, 0)
                    if mate:
                        self.put(mate, base, bins, 1, length)
                self.gaps[room - mate].append((base, bins))

    def fill_gaps(self) -> None:
        for length in range(self.capacity // 3, 0, -1):
            while count := self.left.get(length, 0):
                gap = next((n for n in range(length, self.capacity) if self.gaps.get(n)), self.capacity)
                if gap == self.capacity:
                    each = gap // length
                    self.gaps[gap].append((self.open(-(-count // each)), -(-count // each)))
                base, bins = self.gaps[gap].pop()
                # the gap just filled is the smallest that still holds the length
                each = min(gap // length, count)
                filled = min(bins, count // each)
                self.put(length, base, filled, each, self.capacity - gap)
                self.gaps[gap - each * length].append((base, filled))
                if bins > filled:
                    self.gaps[gap].append((base + filled, bins - filled))

    def arrays(self) -> dict[int, np.ndarray]:
        return {n: np.array(steps, np.int64).reshape(-1, 4).T for n, steps in self.steps.items()}


def pack(pieces: DataFrame, workspace: Workspace, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (with length, part and rank) plus sequence_id and offset.

    The pieces are written first, so that ranks stay what they are if an executor is lost. Pieces of
    one length may be a third of all: they are ranked by part. An empty table has no sequences.
    """
    pieces = workspace.keep(pieces, "pieces")
    counts = workspace.keep(pieces.groupBy("length", "part").count(), "counts")
    # at most one row for each length up to the capacity
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    steps = Plan(total, capacity).arrays()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        sizes, rank = lengths.to_numpy(), ranks.to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(sizes).tolist():
            own = sizes == n
            begins, bases, each, offsets = steps[n]
            step = np.searchsorted(begins, rank[own], side="right") - 1
            within = rank[own] - begins[step]
            sequence[own] = bases[step] + within // each[step]
            offset[own] = offsets[step] + within % each[step] * n
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    own = [c for c in pieces.columns if c not in ("rank", "part")]
    placed = pieces.join(starts, ["length", "part"]).withColumn(
        "place", place("length", F.col("rank") + F.col("before"))
    )
    return placed.select(*own, "place.sequence_id", "place.offset")


def pack_documents(
    docs: DataFrame,
    path: str,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of all documents with their sequence and place: key, piece, start, length, ids_crc32,
    sequence_id, offset. A null text is an empty one and takes one token; equal rows are packed each."""
    packed = pack(token_pieces(docs, path, capacity, text, key), workspace, capacity)
    return packed.withColumnRenamed("key", key)
