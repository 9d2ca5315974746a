"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every labelled training text is counted whole: a task adds up a table of languages by hash buckets
and sends its non-zero cells; Spark sums them. The log-probability matrix has a row per language and
``BUCKETS`` columns, which are halved as often as it takes to keep it within ``MATRIX`` bytes however many
languages there are; it goes to the tasks with the scoring function. Scoring gathers the matrix's columns
of a batch's n-grams and adds them up by text in numpy.

Letters are folded to lower case and all other ASCII characters to blanks. A text that is null or
has no letter is ``und`` with score 0; so is every text if nothing was learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .common import slices, strings

BUCKETS = 1 << 14
SIZES = (1, 2, 3)
SMOOTHING = 0.1
#: Bytes of the matrix that goes to the tasks, and languages whose counts a task holds at once.
MATRIX, HELD = 32 << 20, 200
STEP = 1_000_000
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
FOLD = np.array([c if chr(c).isalpha() else 32 for c in range(128)], np.uint64)


def buckets(text: str) -> np.ndarray:
    """The hash bucket of each n-gram of a text, blanks at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ascii_ = codes < 128
    codes[ascii_] = FOLD[codes[ascii_]]
    codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))]  # one blank between words
    found, rolled = [], np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        if len(codes) < n:
            break
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
        if n in SIZES:
            mixed = rolled * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS)
    return np.concatenate(found)


def sent(cells: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The non-zero cells of each language."""
    for name, own in cells.items():
        at = np.flatnonzero(own)
        names = pa.array([name] * len(at), pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array(at), pa.array(own[at])], ["lang", "at", "n"])


def columns(languages: int) -> int:
    """Buckets of a matrix of so many languages."""
    size = BUCKETS
    while size > 1 and 8 * size * languages > MATRIX:
        size //= 2
    return size


def learn(labelled: DataFrame, workspace: Workspace, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Counts of n-grams by bucket, and in a last cell the number of texts, of each language.

    Rows without a language or with a null text are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[str, np.ndarray] = {}
        for batch in batches:
            for words, name in zip(strings(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                if name not in cells and len(cells) >= HELD:
                    yield from sent(cells)
                    cells = {}
                own = cells.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                own[:BUCKETS] += np.bincount(buckets(words), minlength=BUCKETS)
                own[BUCKETS] += 1
        yield from sent(cells)

    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    sums = rows.mapInArrow(count, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    sums = workspace.keep(sums, "counts")
    size = columns(sums.select("lang").distinct().count())
    at = F.when(F.col("at") == BUCKETS, size).otherwise(F.col("at") % size).cast("long")
    # at most a row for each language and bucket, ``MATRIX`` bytes of counts
    folded = sums.groupBy("lang", at.alias("at")).agg(F.sum("n").alias("n"))
    cells = folded.toArrow().to_pydict()
    learned = {name: np.zeros(size + 1, np.int64) for name in sorted(set(cells["lang"]))}
    for name, at, n in zip(cells["lang"], cells["at"], cells["n"], strict=True):
        learned[name][at] = n
    return learned


def predict(learned: dict[str, np.ndarray], text: str = "text") -> Column:
    """Struct of the most probable language of a text column, and its probability."""
    names = list(learned)
    size = len(learned[names[0]]) - 1 if names else BUCKETS
    counts = np.array([learned[x] for x in names], np.float64).reshape(-1, size + 1)
    smooth = counts[:, :size] + SMOOTHING
    matrix = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.copy()
    priors = np.log(counts[:, size] / max(1.0, counts[:, size].sum()))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def scored(texts: pa.Array) -> pa.Array:
        rows = strings(texts)
        best, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
        known = [i for i, x in enumerate(rows) if names and LETTER.search(x)]
        for start, end in slices([len(rows[i]) for i in known], STEP):
            grams = [buckets(rows[i]) % size for i in known[start:end]]
            begins = np.cumsum([0, *map(len, grams[:-1])])
            sums = np.add.reduceat(matrix[np.concatenate(grams)], begins, axis=0) + priors
            top = sums.argmax(axis=1)
            score[known[start:end]] = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            for i, k in zip(known[start:end], top.tolist(), strict=True):
                best[i] = names[k]
        return pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return scored.asNondeterministic()(F.col(text))
