"""Ranked lexical search by branch and bound over a tree of documents.

The items of a search come in blocks of bounded size. A document's vector is restricted to the terms of a
block: (term, tf) in the order of the terms' frequency, the most frequent first, so that documents share
the paths of a trie. Each task builds such trees of its own documents, some thousands at a time. A node
keeps the maxima of tf by term and the least m of its subtree; as a term's part of the score grows with
tf and falls with m, they bound the score of every document below. Each item walks the tree depth
first, the best child first, and leaves out subtrees whose bound is below the last of its best documents;
a bound that equals it is followed, as ties go by id. Scores are whole numbers and exact.

Every task sends the best documents of each item, and a last ranking chooses among those.

Nulls: a null text has no terms, a null id ranks after all others among equal scores. Repeated rows are
documents of their own, and repeated items are ranked each. Texts of any length are read whole. Without
documents or without terms nothing is found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import raw

TOP = 20
#: Items and distinct terms after which a block of items ends; a longer item is a block of its own.
ITEMS, TERMS = 1024, 1 << 14
#: Documents and postings in a tree, documents in a leaf, and terms by which paths branch.
DOCS, POSTINGS, LEAF, DEPTH = 4096, 1_000_000, 64, 16
#: Cells of the table of maxima; with very many terms leaves are larger.
CELLS = 1 << 22

# Fixed values of the contract: bytes of terms in lower case, blanks for all others.
IN_TERM = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in IN_TERM else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split(b" ")


def restricted(docs: DataFrame, number: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(key, n, terms, tfs) of every document that has terms: its number of terms, and those of ``number``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, terms, tfs, counts = [], [], [], [], []
            for row, own in enumerate(raw(batch.column(1))):
                words = terms_of(own)
                size = len(words) - words.count(b"")
                if not size:
                    continue
                found = Counter(map(number.get, words))
                found.pop(None, None)
                rows.append(row)
                sizes.append(size)
                terms += found.keys()
                tfs += found.values()
                counts.append(len(found))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, tfs)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "terms", "tfs"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(count, f"key {kind}, n long, terms array<int>, tfs array<int>")


class Block:
    """Items with their terms by rank of frequency, and the terms' weights.

    ``items``: the distinct terms of each item with their repeats; ``df``: documents of each term.
    """

    def __init__(self, items: list[Counter], df: dict[int, int], docs: int, length: int):
        order = sorted(df, key=lambda t: (-df[t], t))
        self.rank = np.full(max(order, default=-1) + 1, -1, np.int32)
        self.rank[order] = np.arange(len(order), dtype=np.int32)
        weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) for t in order]
        self.docs, self.length, self.terms = docs, length, len(order)
        self.most = DOCS, POSTINGS
        self.leaf = max(LEAF, DOCS * len(order) // CELLS)
        self.items = []
        for counts in items:
            ranks = sorted((int(self.rank[t]), n) for t, n in counts.items() if t in df)
            own = np.array([r for r, _ in ranks], np.int64)
            self.items.append((own, np.array([weights[r] * n for r, n in ranks], np.int64)))

    def m(self, sizes: list[int]) -> np.ndarray:
        return np.array([75 + 25 * n * self.docs // self.length for n in sizes], np.int64)


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Tree:
    """Documents in the order of their paths, cut into leaves, with the nodes above."""

    def __init__(self, m: np.ndarray, counts: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, terms: int, leaf: int):
        owner = np.repeat(np.arange(len(m)), counts)
        by = np.lexsort((ranks, owner))
        ranks, tfs = ranks[by], tfs[by]
        place = np.arange(len(ranks)) - np.repeat(np.cumsum(counts) - counts, counts)
        paths = np.full((len(m), DEPTH), -1, np.int32)
        paths[owner[place < DEPTH], place[place < DEPTH]] = ranks[place < DEPTH]
        self.order = np.lexsort(paths.T[::-1])
        self.paths = paths[self.order]
        self.m = m[self.order]
        # postings in the order of the documents
        new = np.empty(len(m), np.int64)
        new[self.order] = np.arange(len(m))
        moved = np.argsort(new[owner], kind="stable")
        self.ranks, self.tfs, self.owner = ranks[moved], tfs[moved], new[owner][moved]
        self.starts = np.concatenate([[0], np.cumsum(counts[self.order])])
        self.leaf = leaf
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self.grow(0, len(m), 0)
        self.most = np.zeros((len(self.span), terms), np.int32)
        self.least = np.array([self.m[s:e].min() for s, e in self.span], np.int64)
        for node in range(len(self.span) - 1, -1, -1):  # children have larger numbers
            if self.children[node]:
                self.most[node] = self.most[self.children[node]].max(axis=0)
            else:
                own = slice(*self.starts[list(self.span[node])])
                np.maximum.at(self.most[node], self.ranks[own], self.tfs[own])

    def grow(self, start: int, end: int, depth: int) -> int:
        node = len(self.span)
        self.span.append((start, end))
        self.children.append([])
        if end - start <= self.leaf:
            return node
        edges = [start, end]
        while depth < DEPTH and len(edges) == 2:  # a path that all share is no node
            own = self.paths[start:end, depth]
            edges = [start, *(np.flatnonzero(own[1:] != own[:-1]) + start + 1).tolist(), end]
            depth += 1
        if len(edges) == 2:
            edges = [*range(start, end, self.leaf), end]
        # small neighbours share a node
        cuts = [start]
        for left, right in zip(edges, edges[1:], strict=False):
            if right - cuts[-1] > self.leaf and left > cuts[-1]:
                cuts.append(left)
        cuts.append(end)
        if len(cuts) == 2:
            cuts = edges
        self.children[node] = [self.grow(s, e, depth) for s, e in zip(cuts, cuts[1:], strict=False)]
        return node

    def bounds(self, nodes: list[int], terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        most = self.most[nodes][:, terms].astype(np.int64)
        return parts(most, self.least[nodes][:, None]) @ weights

    def scores(self, node: int, slot: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray]:
        """The first document of a leaf, and the scores of all of them."""
        start, end = self.span[node]
        own = slice(self.starts[start], self.starts[end])
        at = slot[self.ranks[own]]
        hit = at >= 0
        at, doc = at[hit], self.owner[own][hit]
        found = np.zeros(end - start, np.int64)
        np.add.at(found, doc - start, weights[at] * parts(self.tfs[own][hit].astype(np.int64), self.m[doc]))
        return start, found

    def search(self, terms: np.ndarray, weights: np.ndarray, slot: np.ndarray, best: Best) -> None:
        """Depth first, the best child first; what can't reach the last of the best is left out."""
        gains = np.maximum(weights, 0)
        slot[terms] = np.arange(len(terms))
        stack = [(int(self.bounds([0], terms, gains)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if bound < best.least:
                continue
            if below := self.children[node]:
                reach = self.bounds(below, terms, gains)
                for k in np.argsort(reach, kind="stable").tolist():
                    if reach[k] >= best.least:
                        stack.append((int(reach[k]), below[k]))
            else:
                first, found = self.scores(node, slot, weights)
                at = np.flatnonzero(found >= best.least)
                best.add([(int(found[i]), int(self.order[first + i])) for i in at.tolist()])
        slot[terms] = -1


class Best:
    """The best documents of an item so far: (score, id), the highest first, equal scores by id."""

    def __init__(self, top: int):
        self.top, self.rows, self.keys = top, [], []
        self.least = 1

    def add(self, found: list[tuple[int, int]]) -> None:
        if not found:
            return
        rows = self.rows + [(score, self.keys[i]) for score, i in found]
        rows.sort(key=lambda x: (-x[0], x[1] is None, 0 if x[1] is None else x[1]))
        self.rows = rows[: self.top]
        if len(self.rows) == self.top:
            self.least = self.rows[-1][0]


def search_vectors(vectors: DataFrame, block: Block, top: int) -> DataFrame:
    """(item, key, score): each task's best documents for every item of the block."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, (docs, postings) = [Best(top) for _ in block.items], block.most
        slot = np.full(block.terms, -1, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field("key").type
            counts = batch.column("terms").value_lengths().to_numpy()
            ends = np.cumsum(counts, dtype=np.int64)
            terms = block.rank[batch.column("terms").flatten().to_numpy()]
            tfs = batch.column("tfs").flatten().to_numpy()
            keys, sizes = batch.column("key").to_pylist(), batch.column("n").to_pylist()
            start = 0
            while start < len(keys):
                begun = ends[start] - counts[start]
                end = int(min(start + docs, max(start + 1, np.searchsorted(ends, begun + postings))))
                own = slice(begun, ends[end - 1])
                tree = Tree(block.m(sizes[start:end]), counts[start:end], terms[own], tfs[own], block.terms, block.leaf)
                for (ranks, weights), found in zip(block.items, best, strict=True):
                    if len(ranks):
                        found.keys = keys[start:end]
                        tree.search(ranks, weights, slot, found)
                start = end
        if kind is not None:
            rows = [(item, key, score) for item, found in enumerate(best) for score, key in found.rows]
            columns = [pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int32(), kind, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "key", "score"])

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(walk, f"item int, key {kind}, score long")


def blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[list, list[Counter], dict[bytes, int]]]:
    """Items in blocks of bounded size: their keys, their terms with repeats, and the terms' numbers. The
    driver holds one partition of items and one block at a time."""
    keys, counts, number = [], [], {}
    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator():
        keys.append(row["key"])
        words = filter(None, terms_of((row["text"] or "").encode()))
        counts.append(Counter(number.setdefault(w, len(number)) for w in words))
        if len(keys) >= ITEMS or len(number) >= TERMS:
            yield keys, counts, number
            keys, counts, number = [], [], {}
    if keys:
        yield keys, counts, number


def search_block(docs: DataFrame, keys: list, counts: list[Counter], number: dict[bytes, int], names: tuple[str, str], kind: str, top: int, workspace: Workspace) -> DataFrame:
    vectors = workspace.keep(restricted(docs, number, *names), "vectors")
    size, length = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # at most one row for each term of the block
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    block = Block(counts, {r["term"]: r["count"] for r in df}, size, length)
    found = workspace.keep(search_vectors(vectors.where(F.size("terms") > 0), block, top), "found")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ids = docs.sparkSession.createDataFrame(list(enumerate(keys)), f"item int, item_key {kind}")
    return ranked.join(F.broadcast(ids), "item").select("item_key", "rank", "key", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    workspace: Workspace,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The highest-scoring documents of each item: the item's key, rank, the document's key, score.

    The join that puts the items' keys back broadcasts one block of items, ``ITEMS`` rows at most.
    """
    kind, own = items.schema[item].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"item_key {kind}, rank int, key {own}, score long")
    for keys, counts, number in blocks(items, item, item_text):
        if number:
            found = found.unionByName(search_block(docs, keys, counts, number, (key, text), kind, top, workspace))
    return found.select(F.col("item_key").alias(item), "rank", F.col("key").alias(key), "score")
