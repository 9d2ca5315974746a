"""SimHash near-duplicates by bit-sliced comparison.

Equal fingerprints are one first. Two that differ in at most ``radius`` bits agree in at least two of
``radius + 2`` blocks of bits, so each pair of blocks is a table of buckets in which all links are
found. Within a bucket the fingerprints stand as vertical bit planes, 64 to a machine word; the
distances of a query to a word's 64 fingerprints grow plane by plane in carry-save counters, and a
word is abandoned once all its distances exceed the radius. Large buckets are cut into tiles.

A null text is an empty one; texts without words have fingerprint zero and are linked like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .common import raw
from .components import components
from .tiles import Forest, deal, runs

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 4096
PLANES_AT_ONCE = 8
WORDS_AT_ONCE = 1 << 16
#: Members of cells that are compared together.
TOGETHER = 1 << 13
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint_of(text: bytes) -> int:
    """The majority of each bit over the hashes of a text's shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[size - 1 :].tolist()
    hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends, strict=False)]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for start in range(0, len(values), 1 << 14):
        part = values[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: str = "text") -> Column:
    """The fingerprint of a text column as a long."""

    @F.arrow_udf("long")
    def found(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint_of(x) for x in raw(texts)], np.uint64)
        return pa.array(values.view(np.int64))

    return found.asNondeterministic()(F.col(text))


def planes_of(prints: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 fingerprints to a word."""
    padded = np.zeros(-(-len(prints) // 64) * 64, "<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """The lanes whose count, held bit by bit, is above the radius."""
    above, equal = over.copy(), np.full_like(over, ONES)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return above


def near(
    queries: np.ndarray,
    prints: np.ndarray,
    radius: int = RADIUS,
    pairs: tuple[np.ndarray, np.ndarray] | None = None,
    real: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (query, fingerprint) of all pairs within the radius, a bounded number at a time.

    ``pairs``: the queries and the words of 64 fingerprints that meet, else all do; ``real``: which
    fingerprints count, the others fill up words.
    """
    planes = planes_of(prints)
    words = planes.shape[1]
    if pairs is None:
        pairs = np.repeat(np.arange(len(queries)), words), np.tile(np.arange(words), len(queries))
    filled = np.zeros(words * 64, np.uint8)
    filled[: len(prints)] = 1 if real is None else real
    valid = np.packbits(filled, bitorder="little").view("<u8")
    for begin in range(0, len(pairs[0]), WORDS_AT_ONCE):
        q, w = (x[begin : begin + WORDS_AT_ONCE] for x in pairs)
        counters = [np.zeros(len(q), np.uint64) for _ in range(max(1, radius.bit_length()))]
        over = np.zeros(len(q), np.uint64)
        for first in range(0, 64, PLANES_AT_ONCE):
            own = queries[q]
            for bit in range(first, first + PLANES_AT_ONCE, 2):
                # carry-save: two planes and the lowest counter give a sum and one carry
                one, two = (planes[b][w] ^ (np.uint64(0) - (own >> np.uint64(b) & np.uint64(1))) for b in (bit, bit + 1))
                half = counters[0] ^ one
                carry = counters[0] & one | half & two
                counters[0] = half ^ two
                for k in range(1, len(counters)):
                    counters[k], carry = counters[k] ^ carry, counters[k] & carry
                over |= carry
            alive = ~exceeds(counters, over, radius) & valid[w]
            kept = alive != 0
            if not kept.all():  # abandoned: all distances of these words exceed the radius
                q, w, over, alive = q[kept], w[kept], over[kept], alive[kept]
                counters = [x[kept] for x in counters]
        if len(q):
            bits = np.unpackbits(alive.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, lane = np.nonzero(bits)
            yield q[at], w[at] * 64 + lane


class Cells:
    """Cells that are compared together: each one's queries meet the words of its own fingerprints."""

    def __init__(self):
        self.values: list[np.ndarray] = []
        self.queries: list[np.ndarray] = []
        self.others: list[np.ndarray] = []
        self.met: list[np.ndarray] = []
        self.members = self.words = 0

    def add(self, values: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        words = -(-len(right) // 64)
        padded = np.full(words * 64, -1)
        padded[: len(right)] = self.members + right
        self.values.append(values)
        self.queries.append(np.repeat(self.members + left, words))
        self.met.append(np.tile(np.arange(self.words, self.words + words), len(left)))
        self.others.append(padded)
        self.members += len(values)
        self.words += words

    def links(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """A forest of the links in all cells."""
        values, others = np.concatenate(self.values), np.concatenate(self.others)
        forest, pairs = Forest(len(values)), (np.concatenate(self.queries), np.concatenate(self.met))
        for query, other in near(values, values[others], radius, pairs, others >= 0):
            forest.link(query, others[other])
        at = np.flatnonzero(forest.label != np.arange(len(values)))
        return values[at], values[forest.label[at]]


def blocks(radius: int) -> list[int]:
    """Masks of the pairs of blocks, two of which are equal in any two fingerprints that link."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [a | b for a, b in combinations(parts, 2)]


def links(prints: DataFrame, workspace: Workspace, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within the radius as the full set would."""
    masks = [m - (1 << 64) if m >> 63 else m for m in blocks(radius)]
    bands = F.array(*(F.struct(F.lit(k).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(masks)))
    rows = prints.select("fp", F.inline(bands))
    sizes = rows.groupBy("band", "bits").agg(F.count("*").alias("n")).where("n > 1")
    sizes = workspace.keep(sizes, "buckets")
    # merged: to the planner a fingerprint's rows are one, so that it would broadcast them all
    members = deal(rows.join(sizes.hint("merge"), ["band", "bits"]), ["band", "bits"], "fp", F.col("n"), TILE)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cells: Cells) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in cells.links(radius)], names=["a", "b"])

        cells = Cells()
        for cell in runs(batches, 4):
            values = cell.column("fp").to_numpy().view(np.uint64)
            first, second = cell.column("first")[0].as_py(), cell.column("second")[0].as_py()
            inside = cell.column("own").to_numpy() == first
            left, right = np.flatnonzero(inside), np.flatnonzero(~inside)
            if first == second:
                cells.add(values, left, left)
            elif len(left) and len(right):
                cells.add(values, left, right)
            if cells.members >= TOGETHER:
                yield found(cells)
                cells = Cells()
        if cells.members:
            yield found(cells)

    return members.select("band", "bits", "first", "second", "own", "fp").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, workspace: Workspace, key: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """Each row's key with its fingerprint (long) and component: the smallest key it reaches by links.

    Null keys are passed over in that minimum, unless a component has no other.
    """
    prints = workspace.keep(docs.select(F.col(key).alias("key"), fingerprint(text).alias("fp")), "fingerprints")
    distinct = workspace.keep(prints.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), workspace, radius), workspace)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = workspace.keep(rooted, "rooted")
    least = workspace.keep(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    # merged: of the written rows the planner expects these two columns to be far smaller than they are
    component = workspace.keep(rooted.join(least.hint("merge"), "root").select("fp", "component"), "components")
    return prints.join(component, "fp").select(F.col("key").alias(key), "fp", "component")
