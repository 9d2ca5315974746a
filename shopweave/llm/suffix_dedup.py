"""Removal of long strings that repeat, by suffix arrays over what can repeat.

A window is a string of ``length`` bytes. Equal windows hold the same anchor, the least hash of a
fixed number of bytes, at the same place; so windows are gathered in blocks by anchor, and anchors
that occur once are done with. Blocks that are equal throughout are repeats throughout. Blocks of one
anchor that differ are cut into cells of ``CELL`` windows by their distance to the anchor; the bytes
that all windows of a cell share, its core, become one symbol, and cells whose core occurs once are
done with. Suffix arrays over the symbols of the rest decide: windows that repeat are neighbours in
suffix order with equal symbols. A group of cells beyond ``MOST`` different texts is grouped by whole
windows instead, by the same rule, spread over all tasks.

A text that occurs more than once is repeated as a whole. Texts shorter than a window lose nothing;
null is an empty text. Matches never cross documents. Texts are worked on in stretches, so a text may
be of any length; equal rows and null keys are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .common import key_of, raw
from .suffix_groups import suffix_array
from .tiles import runs

LENGTH = 400
#: Of the window: half is hashed for the anchor.
SHARE = 0.5
CELL = 25
#: Most different cell texts of a core in one suffix array, and symbols in an array.
MOST = 4096
SYMBOLS = 200_000
STRETCH = 1 << 18

STEP = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Rolling hashes of all strings of a size; tables grow to the longest stretch seen."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, size: int) -> np.ndarray:
        if len(self.up) < len(data):
            self.up, self.down = powers(STEP, len(data)), powers(BACK, len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        count = len(data) - size + 1
        found = (sums[size:] - sums[:count]) * self.down[:count]
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        return found ^ found >> np.uint64(32)


def least_of(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` values in a row, by doubling."""
    span, out = 1, values
    while span * 2 <= size:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    count = len(values) - size + 1
    return np.minimum(out[:count], out[size - span : size - span + count])


def anchors(data: np.ndarray, hashes: Hashes, length: int, share: float = SHARE) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of a text's windows: (hash of the anchor, its place, least and most distance from a
    window's start to it), for each stretch of the text."""
    part = max(1, int(length * share))
    wide = length - part + 1
    for start in range(0, len(data) - length + 1, STRETCH):
        stretch = data[start : start + STRETCH + length - 1]
        values = hashes(stretch, part)
        least = least_of(values, wide)[: len(stretch) - length + 1]
        # the first place at or after a window's start that has the window's least hash
        candidate = anchor_places(values, least, wide)
        index = np.searchsorted(candidate, np.arange(len(least)))
        while (wrong := values[candidate[index]] != least).any():
            index[wrong] += 1
        edges = np.flatnonzero(np.diff(index, prepend=-1))
        last = np.append(edges[1:], len(least)) - 1
        at = candidate[index[edges]]
        yield values[at], start + at, at - last, at - edges


def anchor_places(values: np.ndarray, least: np.ndarray, wide: int) -> np.ndarray:
    """Places whose hash is the least of some window that holds them."""
    padded = np.concatenate([np.zeros(wide - 1, np.uint64), least, np.zeros(wide - 1, np.uint64)])
    most = ~least_of(~padded, wide)
    return np.flatnonzero(most[: len(values)] == values)


def find_blocks(batches: Iterator[pa.RecordBatch], length: int, share: float) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, block, text, place, least, most) of each different text of a task."""
    hashes, seen = Hashes(), set()
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        keys, counts = [], []
        for key, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
            if len(text) < length or key in seen:
                continue
            seen.add(key)
            for anchor, place, least, most in anchors(np.frombuffer(text, np.uint8), hashes, length, share):
                ends = zip((place - most).tolist(), (place - least + length).tolist(), most.tolist(), strict=True)
                block = [xxhash.xxh3_64_intdigest(text[s:e], d) for s, e, d in ends]
                for column, values in zip(out, (anchor, np.array(block, np.uint64), place, least, most), strict=True):
                    column.append(values)
                keys.append(key)
                counts.append(len(place))
        if keys:
            anchor, block, place, least, most = (np.concatenate(x) for x in out)
            texts = pa.array(keys, pa.binary()).take(pa.array(np.repeat(np.arange(len(keys)), counts)))
            columns = [pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64)), texts]
            columns += [pa.array(x.astype(np.int32)) for x in (place, least, most)]
            yield pa.RecordBatch.from_arrays(columns, names=BLOCK)


BLOCK = ["anchor", "block", "text", "place", "least", "most"]
BLOCKS = "anchor long, block long, text binary, place int, least int, most int"
CELLS = "core binary, left binary, right binary, text binary, base int"


def cut_cells(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Cells of the listed blocks of each text. A window of a cell starts ``e`` bytes, from 0 to
    CELL - 1, before the core at ``base``; ``left`` has the bytes for the largest e of the cell that
    the block has, ``right`` those for its smallest."""
    seen = set()
    core_size = length - CELL + 1
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for key, text, listed in zip(batch.column(0).to_pylist(), raw(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            if key in seen:
                continue
            seen.add(key)
            for block in listed:
                place, least, most = block["place"], block["least"], block["most"]
                for k in range(least // CELL, most // CELL + 1):
                    base = place - k * CELL
                    low, high = max(least - k * CELL, 0), min(most - k * CELL, CELL - 1)
                    core = hashlib.md5(text[base : base + core_size], usedforsecurity=False).digest()
                    right = base + core_size
                    row = core, text[base - high : base], text[right : right + CELL - 1 - low], key, base
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
        if out[0]:
            kinds = [pa.binary()] * 4 + [pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], names=["core", "left", "right", "text", "base"]
            )


def repeats_in(cells: list[tuple[int, bytes, bytes, int]]) -> Iterator[tuple[int, int, int]]:
    """(cell, least e, most e) of runs of windows that repeat among cells (core, left, right, copies)."""
    symbols: list[int] = []
    starts = []
    for core, left, right, _ in cells:
        starts.append(len(symbols))
        symbols += [x + 2 for x in left]
        symbols.append(core + 258)
        symbols += [x + 2 for x in right]
        symbols.append(1)
    text = np.array(symbols, np.int64)
    owner = np.repeat(np.arange(len(cells)), np.diff([*starts, len(symbols)]))
    lefts = np.array([len(left) for _, left, _, _ in cells])
    rights = np.array([len(right) for _, _, right, _ in cells])
    distance = np.array(starts)[owner] + lefts[owner] - np.arange(len(symbols))  # to the core
    # a window is CELL symbols with the core among them, all within the cell
    whole = (distance >= 0) & (CELL - 1 - distance <= rights[owner]) & (distance < CELL)
    order = np.array(suffix_array(symbols))
    order = order[whole[order]]
    padded = np.append(text, np.zeros(CELL, np.int64))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in range(CELL):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    twice = np.zeros(len(symbols), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    copies = np.array([c for _, _, _, c in cells])
    twice |= whole & (copies[owner] > 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], twice.astype(np.int8), [0]])))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        yield int(owner[start]), int(distance[end - 1]), int(distance[start])


def sort_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows (core, left, right, low, high) of cells that come sorted by core."""

    def decide(held: list[tuple]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        cells = [(number.setdefault(core, len(number)), left, right, n) for core, left, right, n in held]
        found = list(repeats_in(cells))
        columns = [pa.array([held[k][i] for k, _, _ in found], pa.binary()) for i in range(3)]
        columns += [pa.array([x[i] for x in found], pa.int32()) for i in (1, 2)]
        return pa.RecordBatch.from_arrays(columns, names=["core", "left", "right", "low", "high"])

    held: list[tuple] = []
    size = 0
    for group in runs(batches, 1):
        columns = [group.column(i).to_pylist() for i in range(4)]
        rows = list(zip(*columns, strict=True))
        held += rows
        size += sum(len(left) + len(right) + 2 for _, left, right, _ in rows)
        if size > SYMBOLS:
            yield decide(held)
            held, size = [], 0
    if held:
        yield decide(held)


def repeated(docs: DataFrame, workspace: Workspace, length: int = LENGTH, share: float = SHARE) -> DataFrame:
    """(text, starts): for each text, by key, the ranges [first, last] of starts of windows that
    repeat. Texts that occur more than once are not all listed; see ``whole_texts``."""
    blocks = docs.select("text_key", "text").mapInArrow(lambda b: find_blocks(b, length, share), BLOCKS)
    blocks = workspace.keep(blocks, "blocks")
    twice = blocks.groupBy("anchor").agg(
        F.count("*").alias("n"), (F.min("block") != F.max("block")).alias("mixed")
    )
    twice = workspace.keep(twice.where("n > 1").select("anchor", "mixed"), "anchors")
    held = workspace.keep(blocks.join(twice, "anchor").select(*BLOCK[2:], "mixed"), "repeated")
    clean = held.where("not mixed").select("text", F.expr("place - most AS first"), F.expr("place - least AS last"))
    listed = held.where("mixed").groupBy("text").agg(
        F.collect_set(F.struct("place", "least", "most")).alias("blocks")
    )
    listed = workspace.keep(listed.withColumnRenamed("text", "text_key"), "listed")
    cells = docs.select("text_key", "text").join(listed, "text_key").mapInArrow(lambda b: cut_cells(b, length), CELLS)
    cells = workspace.keep(cells, "cells")
    cell = ["core", "left", "right"]
    texts = workspace.keep(cells.groupBy(*cell).agg(F.count("*").alias("copies")), "cell-texts")
    cores = texts.groupBy("core").agg(F.sum("copies").alias("n"), F.count("*").alias("different"))
    cores = workspace.keep(cores.where("n > 1").select("core", "different"), "cores")
    open_ = texts.join(cores, "core")
    few = open_.where(F.col("different") <= MOST).select(*cell, "copies")
    few = few.repartition("core").sortWithinPartitions("core")
    sorted_ = few.mapInArrow(sort_cells, "core binary, left binary, right binary, low int, high int")
    found = workspace.keep(sorted_.unionByName(by_windows(open_.where(F.col("different") > MOST))), "windows")
    ranges = cells.join(found, cell).select("text", F.expr("base - high AS first"), F.expr("base - low AS last"))
    spans = clean.unionByName(ranges).distinct()
    spans = spans.groupBy("text").agg(F.collect_list(F.struct("first", "last")).alias("starts"))
    return workspace.keep(spans.withColumnRenamed("text", "text_key"), "spans")


def by_windows(cells: DataFrame) -> DataFrame:
    """Repeated windows of cells whose core has very many texts: each window is a group of its own."""
    e = F.explode(F.sequence(F.lit(CELL - 1) - F.length("right"), F.length("left")))
    windows = cells.select("core", "left", "right", "copies", e.alias("e"))
    windows = windows.withColumn("window", F.md5(F.concat(
        F.expr("substring(left, length(left) - e + 1, e)"), F.expr(f"substring(right, 1, {CELL - 1} - e)")
    )))
    twice = windows.groupBy("core", "e", "window").agg(F.sum("copies").alias("n")).where("n > 1")
    found = windows.join(twice.select("core", "e", "window"), ["core", "e", "window"])
    return found.select("core", "left", "right", F.col("e").cast("int").alias("low"), F.col("e").cast("int").alias("high"))


def whole_texts(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """Keys of the texts that occur more than once."""
    counts = docs.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1")
    return workspace.keep(counts.select("text_key", F.lit(True).alias("whole")), "whole")


def cut_of(length: int, whole_characters: bool):
    """UDF: text, ranges of repeated starts, whether the text occurs more than once, to what is left."""

    def rest(parts: list[bytes]) -> bytes:
        kept = b"".join(parts)
        return kept.decode("utf-8", "ignore").encode() if whole_characters else kept

    @F.arrow_udf("struct<n_bytes: long, n_removed: long, n_spans: long, kept: binary>")
    def cut(texts: pa.Array, starts: pa.Array, whole: pa.Array) -> pa.Array:
        rows = []
        for text, ranges, all_ in zip(raw(texts), starts.to_pylist(), whole.to_pylist(), strict=True):
            if len(text) >= length and all_:
                rows.append((len(text), len(text), 1, b""))
                continue
            kept, at, removed, count = [], 0, 0, 0
            for first, last in sorted((r["first"], r["last"] + length) for r in ranges or ()):
                if first > at or not count:
                    kept.append(text[at:first])
                    removed -= first
                    count += 1
                elif last <= at:
                    continue
                else:
                    removed -= at
                removed += last
                at = last
            rows.append((len(text), removed, count, rest([*kept, text[at:]]) if count else text))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.binary()]
        return pa.StructArray.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["n_bytes", "n_removed", "n_spans", "kept"]
        )

    return cut.asNondeterministic()


def deduplicate(
    docs: DataFrame,
    workspace: Workspace,
    text: str = "text",
    length: int = LENGTH,
    whole_characters: bool = False,
    share: float = SHARE,
) -> DataFrame:
    """All rows and columns, and a struct ``cut_``: n_bytes, n_removed, n_spans, and the bytes kept.

    ``whole_characters``: bytes of characters that are cut in half are not kept either. ``share`` of a window
    is hashed for its anchor; the less, the fewer anchors a text has. It changes no result.
    """
    texts = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("text"))
    texts = texts.withColumn("text_key", key_of("text"))
    spans = repeated(texts, workspace, length, share)
    whole = whole_texts(texts.where(F.octet_length("text") >= length), workspace)
    known = workspace.keep(spans.join(whole, "text_key", "full"), "known")
    cut: Column = cut_of(length, whole_characters)("text", "starts", "whole")
    joined = texts.join(known, "text_key", "left")
    return joined.select("row", cut.alias("cut_")).select("row.*", "cut_")
