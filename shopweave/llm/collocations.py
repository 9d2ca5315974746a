"""Phrase collocations by Rabin-Karp fingerprints.

A stretch of text is a buffer of bytes. Prefix polynomials over the bytes give each word's hash, and
prefix polynomials over the words' hashes give that of every n-gram within a piece, all in numpy. The
fingerprint of an n-gram covers its language, too, and a second polynomial with another base checks it.
A task adds up its equal fingerprints, each with a pointer to a document that holds it; a shuffle adds up
the tasks'.

An n-gram can only be frequent if both of its parts one word shorter are. The fingerprints of the
frequent ones go to the next pass as a bitmap of fixed size; a bit that two share lets a few more
through, whose counts then decide. Phrases are read from the text for frequent fingerprints alone: the
documents that pointers name are hashed again, and words with the fingerprint and its check are the
phrase; where there are none the job stops. Fingerprints that meet with different checks stand for
several phrases, which are counted apart by both.

Nulls: a null text is an empty one, a null language is ``und``. Repeated rows count each. Texts are
worked on in stretches, so a text may be of any length; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import raw, strings

LEAST = 10
LONGEST = 3
#: A candidate goes if a longer one around it has at least so many per cent of its occurrences.
COVER_PCT = 50
SCALE = 1_000_000
TOP = 2000
#: Shares of a language's phrases that are ranked by themselves first.
SHARES = 64
UNKNOWN = "und"

#: Bytes of text worked on at once, and rows that a task adds up before it sends them on.
STRETCH, HELD = 1 << 18, 500_000
#: Bits of the bitmap of frequent fingerprints (16 MB), and of one of its rows.
BITS, ROW_BITS = 27, 15
#: Bits of a fingerprint; tests make it small, so that different phrases meet.
PRINT_BITS = 64

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
WORD_BASES = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: What a task sends. The number of a language's words goes as a row of its own, with the complement of the
#: number of a document of the language in place of the document's.
PARTIAL = ["fp", "check", "n", "row"]

# Fixed values of the contract: bytes between pieces, and between words.
PIECE_ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.zeros(256, np.uint8)
KIND[list(SPACES)], KIND[list(PIECE_ENDS)] = 1, 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self, base: np.uint64):
        self.bases = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.tables = [np.ones(1, np.uint64)] * 2

    def __call__(self, count: int) -> list[np.ndarray]:
        if len(self.tables[0]) < count:
            self.tables = [np.full(count, b, np.uint64) for b in self.bases]
            for table in self.tables:
                table[0] = 1
                np.multiply.accumulate(table, out=table)
        return [x[:count] for x in self.tables]


@cache
def powers(base: np.uint64) -> Powers:
    return Powers(base)


def between(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """The polynomial of each range of values, from the prefixes' polynomials."""
    up, down = powers(base)(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


class Words:
    """The words of a stretch: their places, pieces and languages, and the hashes of n-grams."""

    def __init__(self, data: np.ndarray, seeds: np.ndarray, doc_starts: np.ndarray, bits: int, base: int = 0):
        """``seeds``: hash of each document's language; ``base``: the stretch's place in the buffer; ``bits``
        of a fingerprint."""
        self.mask = np.uint64((1 << bits) - 1)
        kind = KIND[data]
        edges = np.diff(np.concatenate([[0], (kind == 0).astype(np.int8), [0]]))
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.starts] if len(self.starts) else np.zeros(0, np.int32)
        self.doc = np.searchsorted(doc_starts, self.starts + base, side="right") - 1
        self.seeds = seeds[self.doc]
        letters = LOWER[data].astype(np.uint64) + np.uint64(1)
        sizes = (self.ends - self.starts).astype(np.uint64)
        self.hashes = [mixed(between(letters, self.starts, self.ends, b) + sizes) if len(sizes) else sizes for b in BASES]

    def whole(self, n: int) -> np.ndarray:
        """Where the first words of n-grams that lie within a piece are."""
        count = max(0, len(self.starts) - n + 1)
        return np.flatnonzero(self.piece[:count] == self.piece[n - 1 : n - 1 + count])

    def prints(self, first: np.ndarray, n: int, which: int) -> np.ndarray:
        """Fingerprints (which 0) or checks (1) of n-grams by their first words."""
        if not len(first):
            return np.zeros(0, np.uint64)
        found = between(self.hashes[which], first, first + n, WORD_BASES[which]) if n > 1 else self.hashes[which][first]
        found = mixed(found ^ self.seeds[first] + np.uint64(n))
        return found & self.mask if which == 0 else found


class Bitmap:
    """A set of fingerprints, one bit for all that agree in their lowest ``BITS`` bits."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.bytes = np.zeros(1 << BITS - 3, np.uint8)
        size = 1 << ROW_BITS - 3
        for number, bits in rows:
            self.bytes[number * size : (number + 1) * size] = np.frombuffer(bits, np.uint8)

    def holds(self, prints: np.ndarray) -> np.ndarray:
        at = prints & np.uint64((1 << BITS) - 1)
        return (self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap_of(found: DataFrame) -> Bitmap:
    """At most 2^(BITS - ROW_BITS) rows of 2^(ROW_BITS - 3) bytes, whatever the number of fingerprints."""
    at = f"(fp & {(1 << BITS) - 1}L)"
    rows = found.groupBy(F.expr(f"shiftright({at}, {ROW_BITS})").alias("number")).agg(
        F.expr(f"bitmap_construct_agg({at} & {(1 << ROW_BITS) - 1}L)").alias("bits")
    )
    return Bitmap([(r["number"], bytes(r["bits"])) for r in rows.collect()])


def last_true(found: np.ndarray) -> int:
    at = np.flatnonzero(found)
    return int(at[-1]) if len(at) else -1


def stretches(data: np.ndarray, n: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, fresh): ranges of bytes that hold every n-gram's words whole. An n-gram counts in the
    range in which its last word starts at ``fresh`` or later. Ranges end with a piece; a longer piece
    is cut between words, and the last n - 1 words come again."""
    start = fresh = 0
    while start < len(data):
        end = start + size
        while end < len(data):
            kind = KIND[data[start:end]]
            cut = last_true(kind == 2) + 1
            if cut > fresh - start:
                end = start + cut
                break
            cut = last_true(kind == 1) + 1
            if cut > fresh - start:
                end = start + cut
                break
            end += size
        end = min(end, len(data))
        yield start, end, fresh
        if end == len(data) or KIND[data[end - 1]] == 2:
            start = fresh = end
        else:  # within a piece
            word = KIND[data[start:end]] == 0
            begins = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
            fresh, start = end, start + int(begins[max(0, len(begins) - n + 1)]) if n > 1 and len(begins) else end


class Sums:
    """A task's counts by fingerprint and check, with a document each; a bounded number is held."""

    def __init__(self, most: int):
        self.most, self.parts, self.held = most, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            self.parts.append(added_up([list(columns)]))
            self.held += len(self.parts[-1][0])
            if self.held > self.most:
                self.parts = [added_up(self.parts)]
                self.held = len(self.parts[0][0])
                if self.held > self.most // 2:
                    yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            columns = added_up(self.parts)
            self.parts, self.held = [], 0
            for start in range(0, len(columns[0]), 1 << 16):
                own = [pa.array(x[start : start + (1 << 16)].view(np.int64)) for x in columns]
                yield pa.RecordBatch.from_arrays(own, names=PARTIAL)


def added_up(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Columns (fp, check, n, row) with equal neighbours in the order of fingerprints added up."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    if not len(columns[0]):
        return columns
    order = np.argsort(columns[0], kind="stable")
    fp, check, count, row = (x[order] for x in columns)
    begins = np.flatnonzero(np.concatenate([[True], (fp[1:] != fp[:-1]) | (check[1:] != check[:-1])]))
    return [fp[begins], check[begins], np.add.reduceat(count, begins), row[begins]]


def partials(docs: DataFrame, n: int, frequent: Bitmap | None = None) -> DataFrame:
    """Each task's counts of the n-grams whose parts may be frequent; of single words, the words of each
    language as well. ``docs``: row, lang, text."""
    stretch, held, bits = STRETCH, HELD, PRINT_BITS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Sums(held)
        totals: dict[str, list[int]] = {}
        for batch in batches:
            texts, langs = raw(batch.column(2)), strings(batch.column(1))
            rows = batch.column(0).to_numpy()
            data = np.frombuffer(b"\n".join(texts), np.uint8)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            doc_starts = np.cumsum(sizes + 1) - sizes - 1
            seeds = np.array([xxhash.xxh64_intdigest(x) for x in langs], np.uint64)
            for start, end, fresh in stretches(data, n, stretch):
                words = Words(data[start:end], seeds, doc_starts, bits, start)
                if n == 1:
                    for doc, count in zip(*np.unique(words.doc, return_counts=True), strict=True):
                        totals.setdefault(langs[doc], [int(rows[doc]), 0])[1] += int(count)
                    first = words.whole(1)
                else:
                    part, known = words.whole(n - 1), np.zeros(len(words.starts), bool)
                    known[part] = frequent.holds(words.prints(part, n - 1, 0))
                    first = words.whole(n)
                    first = first[(words.starts[first + n - 1] >= fresh - start) & known[first] & known[first + 1]]
                prints = [words.prints(first, n, k) for k in (0, 1)]
                yield from counts.add(*prints, np.ones(len(first), np.int64), rows[words.doc[first]])
        yield from counts.rows()
        if totals:
            own = np.array([xxhash.xxh64_intdigest(x) for x in totals], np.uint64).view(np.int64)
            row, count = np.array(list(totals.values()), np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, np.zeros_like(own), count, ~row)], names=PARTIAL)

    return docs.select("row", "lang", "text").mapInArrow(scan, ", ".join(f"{x} long" for x in PARTIAL))


def counted(rows: DataFrame, least: int, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """(fp, check, n, row) of the n-grams with at least ``least`` occurrences, and the same of languages."""
    found = rows.groupBy("fp", (F.col("row") < 0).alias("total")).agg(
        F.sum("n").alias("n"), F.min("check").alias("low"), F.max("check").alias("high"), F.min("row").alias("row")
    )
    found = workspace.keep(found.where((F.col("n") >= least) | F.col("total")), "prints")
    totals, found = found.where("total"), found.where("NOT total")
    shared, names = found.where("low <> high"), ["fp", F.col("low").alias("check"), "n", "row"]
    clean = found.where("low = high").select(*names)
    if shared.isEmpty():
        return clean, totals
    # different phrases met in a fingerprint: count them apart
    again = rows.where("row >= 0").join(shared.select("fp"), "fp", "left_semi")
    apart = again.groupBy("fp", "check").agg(F.sum("n").alias("n"), F.min("row").alias("row"))
    return clean.unionByName(workspace.keep(apart.where(F.col("n") >= least), "apart")), totals


def spelled(data: np.ndarray, seed: int, wanted: dict[tuple[int, int], int], n: int, stretch: int, bits: int) -> dict[tuple[int, int], bytes]:
    """The words of a text whose n-grams have the wanted fingerprints and checks, one space apart."""
    found: dict[tuple[int, int], bytes] = {}
    listed = np.array([fp for fp, _ in wanted], np.int64)
    for start, end, _ in stretches(data, n, stretch):
        words = Words(data[start:end], np.array([seed], np.uint64), np.zeros(1, np.int64), bits, start)
        first = words.whole(n)
        fp, check = (words.prints(first, n, k).view(np.int64) for k in (0, 1))
        for i in np.flatnonzero(np.isin(fp, listed)).tolist():
            key = int(fp[i]), int(check[i])
            if key in wanted and key not in found:
                at = range(int(first[i]), int(first[i]) + n)
                parts = (data[start + words.starts[w] : start + words.ends[w]] for w in at)
                found[key] = b" ".join(LOWER[x].tobytes() for x in parts)
    return found


def materialised(docs: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """(lang, phrase, a): the frequent phrases, as documents that hold them spell them."""
    stretch, bits = STRETCH, PRINT_BITS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases, counts = [], [], []
            for lang, text, listed in zip(strings(batch.column(0)), raw(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                wanted = {(x["fp"], x["check"]): x["n"] for x in listed}
                own = spelled(np.frombuffer(text, np.uint8), xxhash.xxh64_intdigest(lang), wanted, n, stretch, bits)
                if len(own) < len(wanted):
                    raise ValueError("a document doesn't hold an n-gram that points to it")
                langs += [lang] * len(own)
                phrases += [x.decode() for x in own.values()]
                counts += [wanted[key] for key in own]
            columns = [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "a"])

    listed = found.groupBy("row").agg(F.collect_list(F.struct("fp", "check", "n")).alias("listed"))
    held = docs.join(listed, "row").select("lang", "text", "listed")
    return held.mapInArrow(read, "lang string, phrase string, a long")


def phrases(
    docs: DataFrame, workspace: Workspace, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with at least ``least`` occurrences (lang, phrase, words, a), and
    the number of words of each language (lang, n)."""
    row = F.monotonically_increasing_id().alias("row")
    docs = workspace.keep(docs.select(row, F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")), "numbered")
    found, bitmap, sums = [], None, None
    for n in range(1, longest + 1):
        own, totals = counted(partials(docs, n, bitmap), least, workspace)
        if n == 1:
            named = docs.select("row", "lang")
            sums = totals.select((-1 - F.col("row")).alias("row"), "n").join(named, "row").select("lang", "n")
            sums = workspace.keep(sums, "sums")
        if n < longest:
            bitmap = bitmap_of(own)
        found.append(materialised(docs, own, n).withColumn("words", F.lit(n)))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return workspace.keep(every, "phrases"), sums


def cuts(size: int) -> list[tuple[int, str, str]]:
    """(k, first part, rest) of a phrase's words in SQL."""
    return [
        (k, f"array_join(slice(ws, 1, {k}), ' ')", f"array_join(slice(ws, {k + 1}, {size - k}), ' ')") for k in range(1, size)
    ]


def scored(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates with the lowest-scoring cut: lang, phrase, words, a, l, r, score."""
    split = found.where("words > 1").withColumn("ws", F.split("phrase", " "))
    each = None
    for size in range(2, longest + 1):
        parts = [F.struct(F.lit(k).alias("k"), F.expr(a).alias("first"), F.expr(b).alias("rest")) for k, a, b in cuts(size)]
        own = split.where(F.col("words") == size).select("lang", "phrase", "words", "a", F.inline(F.array(*parts)))
        each = own if each is None else each.unionByName(own)
    counts = found.select("lang", "phrase", "a")
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    both = each.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    wide = "CAST({} AS DECIMAL(38, 0))"
    a, l, r = (wide.format(x) for x in "alr")
    score = F.expr(f"({SCALE} * {a} * {a}) div ({l} * {r})").cast("long")
    least = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def within(found: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, around): the most occurrences of a longer candidate that holds the phrase."""
    parts = None
    for size in range(3, longest + 1):
        own = found.where(F.col("words") == size).withColumn("ws", F.split("phrase", " "))
        inner = [f"array_join(slice(ws, {i}, {n}), ' ')" for n in range(2, size) for i in range(1, size - n + 2)]
        own = own.select("lang", F.explode(F.expr(f"array({', '.join(inner)})")).alias("phrase"), "a")
        parts = own if parts is None else parts.unionByName(own)
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("around"))


def collocations(
    docs: DataFrame, workspace: Workspace, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score."""
    found, sums = phrases(docs, workspace, lang, text, least)
    kept = scored(found).join(within(found), ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (100 * F.col("around") < COVER_PCT * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: each share of it sends its first ones, and those are ranked
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    first = F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))
    kept = kept.withColumn("rank", first).where(F.col("rank") <= top).drop("rank")
    whole = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = kept.withColumn("rank", whole).where(F.col("rank") <= top)
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
