"""Quality rules: repetition coverage of a text.

A text's words become numbers in order of first use. Rolling hashes of word n-grams of several
lengths, each made from the one before by one more step, are sorted in numpy; the characters inside
n-grams that occur twice or more are counted, and those of lines that repeat an earlier line. A text
is kept if it passes the base rules and no coverage is above its limit.

Null and empty texts have no words and fail. Whole texts are read, each row by itself: no shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import raw

#: Words in an n-gram: most per cent of the word characters that repeated n-grams may cover.
COVERED_PCT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Most per cent of the word characters in lines that repeat an earlier line.
LINES_PCT = 20
MIN_WORDS = 50
MAX_REPEAT_PCT = 50

# Fixed values of the contract: bytes of white space between words, and symbols.
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"[#*$%&|<>]"
WORD = re.compile(rb"[^\x20\x09-\x0D]")
BASE = np.uint64(0x9E3779B97F4A7C15)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
COVERED = tuple(f"covered_{n}" for n in COVERED_PCT)
SCHEMA = f"struct<{', '.join(f'{c}: long' for c in COUNTS + COVERED)}>"


def chars(text: bytes) -> int:
    """Code points of words: neither white space nor the later bytes of a character."""
    return len(text.decode("utf-8", "replace")) - sum(map(text.count, (SPACE[i : i + 1] for i in range(6))))


def inside_repeats(grams: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words are in an n-gram that occurs twice or more; ``grams``: each one's number."""
    inside = np.zeros(words + 1, np.int64)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return inside[:words] > 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    np.add.at(inside, at, 1)
    np.add.at(inside, at + n, -1)
    return np.cumsum(inside)[:words] > 0


def measure(text: bytes) -> tuple[int, ...]:
    """The counts of ``COUNTS`` and ``COVERED`` for a text."""
    words = text.split()
    lines, seen, dup_lines, dup_chars = text.split(b"\n"), set(), 0, 0
    for line in lines:
        if WORD.search(line):
            if line in seen:
                dup_lines += 1
                dup_chars += chars(line)
            seen.add(line)
    if not words:
        return (0,) * (len(COUNTS) + len(COVERED))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # exact numbers of 3-grams: pairs are renumbered before the third word joins
    repeat = 0
    if len(words) >= 4:
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        repeat = int(inside_repeats(pairs[:-1] * len(number) + ids[2:], 3, len(words)).sum())
    covered = [0] * len(COVERED_PCT)
    if repeat:  # a longer n-gram that repeats holds 3-grams that do
        sizes = np.fromiter((len(w.decode("utf-8", "replace")) for w in words), np.int64, len(words))
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * BASE
        mixed ^= mixed >> np.uint64(29)
        rolled, n = mixed, 1
        for k, size in enumerate(COVERED_PCT):
            while n < size and len(rolled) > 1:
                rolled, n = rolled[:-1] * BASE + mixed[n:], n + 1
                rolled ^= rolled >> np.uint64(31)
            if n < size:
                break
            covered[k] = int(sizes[inside_repeats(rolled, n, len(words))].sum())
    symbols = sum(text.count(SYMBOLS[i : i + 1]) for i in range(1, len(SYMBOLS) - 1))
    return len(words), chars(text), symbols, dup_lines, repeat, dup_chars, *covered


def repetition(text: str = "text") -> Column:
    """Struct of ``COUNTS`` and ``COVERED`` of a text column."""

    @F.arrow_udf(SCHEMA)
    def measured(texts: pa.Array) -> pa.Array:
        rows = np.array([measure(x) for x in raw(texts)], np.int64).reshape(-1, len(COUNTS + COVERED))
        return pa.StructArray.from_arrays([pa.array(x) for x in rows.T], names=COUNTS + COVERED)

    return measured.asNondeterministic()(F.col(text))


def base_failed(stats: str) -> Column:
    words, repeat = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * words)


def kept(stats: str) -> Column:
    """Passes the base rules, and nothing repeats too much; ``stats``: column of ``repetition``."""
    limits = {f"covered_{n}": pct for n, pct in COVERED_PCT.items()} | {"dup_line_chars": LINES_PCT}
    passed = ~base_failed(stats)
    for name, pct in limits.items():
        passed &= 100 * F.col(f"{stats}.{name}") <= pct * F.col(f"{stats}.word_chars")
    return passed
