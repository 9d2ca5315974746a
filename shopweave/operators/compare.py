"""Holding two tables against each other by content, whatever their counts say.

Both sides are read once as narrow digests: rows and an order-free digest for each of a fixed number of
equal ranges of the key. Only ranges whose digests differ are looked at row by row, and their bounds
reach both scans as filters. What differs is then named: keys that one side lacks, and keys whose rows
are others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .digest import row_digest

#: Ranges of the key; a row each is collected.
RANGES = 1024
#: Stretches of the key that are filtered one by one; beyond, neighbours are read with what is between.
STRETCHES = 64
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def _common(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None) -> list[str]:
    """The columns to compare, the key included, in one order."""
    wanted = set(columns) if columns is not None else set(left.columns) & set(right.columns)
    return sorted(wanted | {key})


def _range(key: str, low: int, high: int, ranges: int) -> Column:
    """1-based number of the range that a key is in; null for a null key."""
    return F.width_bucket(F.col(key).cast("double"), F.lit(float(low)), F.lit(float(high) + 1), F.lit(ranges))


def range_digests(frame: DataFrame, key: str, columns: list[str], low: int, high: int, ranges: int) -> DataFrame:
    """(part, n, digest) of each range of the key that has rows."""
    part = _range(key, low, high, ranges).alias("part")
    rows = frame.select(part, row_digest(frame, columns).alias("digest"))
    return rows.groupBy("part").agg(F.count("*").alias("n"), F.sum("digest").alias("digest"))


def _bounds(left: DataFrame, right: DataFrame, key: str) -> tuple[int, int] | None:
    """Least and largest key of both sides: one narrow pass each, which footers answer where they can."""
    both = left.select(key).unionByName(right.select(key))
    low, high = both.agg(F.min(key), F.max(key)).first()
    return None if low is None else (low, high)


def differing_ranges(
    left: DataFrame, right: DataFrame, key: str, columns: list[str], low: int, high: int, ranges: int
) -> list[int | None]:
    """Numbers of the ranges whose digests differ, at most ``ranges`` and one for null keys."""
    sides = [range_digests(f, key, columns, low, high, ranges) for f in (left, right)]
    marked = sides[0].withColumn("side", F.lit(1)).unionByName(sides[1].withColumn("side", F.lit(-1)))
    # a range that both have alike adds up to nothing
    found = marked.groupBy("part").agg(F.sum(F.col("side") * F.col("n")).alias("n"), F.sum(F.col("side") * F.col("digest")).alias("digest"))
    rows = found.where("n <> 0 OR digest <> 0").select("part").collect()
    return sorted((r["part"] for r in rows), key=lambda x: (x is not None, x or 0))


def _stretches(parts: list[int], low: int, high: int, ranges: int) -> list[tuple[int, int]]:
    """(first, last) keys of runs of neighbouring ranges, a little too wide rather than too narrow."""
    width = (high + 1 - low) / ranges
    runs: list[list[int]] = []
    for part in parts:
        if runs and part == runs[-1][1] + 1:
            runs[-1][1] = part
        else:
            runs.append([part, part])
    while len(runs) > STRETCHES:  # join the two that are nearest
        at = min(range(len(runs) - 1), key=lambda i: runs[i + 1][0] - runs[i][1])
        runs[at : at + 2] = [[runs[at][0], runs[at + 1][1]]]
    return [(int(low + (a - 1) * width) - 1, int(low + b * width) + 1) for a, b in runs]


def _within(key: str, parts: list[int | None], low: int, high: int, ranges: int) -> Column:
    """Whether a key is in one of the ranges: bounds that reach the scan, then the ranges themselves."""
    numbers = [p for p in parts if p is not None]
    wanted = F.lit(False)
    for first, last in _stretches(numbers, low, high, ranges):
        wanted |= F.col(key).between(first, last)
    exact = wanted & _range(key, low, high, ranges).isin(numbers) if numbers else F.lit(False)
    return exact | F.col(key).isNull() if None in parts else exact


def differences(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    ranges: int = RANGES,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(key, difference) of the keys whose rows differ: ``missing`` on the right, ``extra`` there, or ``changed``.

    ``columns`` to compare, else all that both sides have. Whole numbers are keys; of a key with several
    rows all count. With a workspace the rows that are looked at are written first. Equal tables need the
    digests alone.
    """
    names = _common(left, right, key, columns)
    nothing = left.select(key, F.lit("").alias("difference")).limit(0)
    bounds = _bounds(left, right, key) or (0, 0)
    parts = differing_ranges(left, right, key, names, *bounds, ranges)
    if not parts:
        return nothing
    wanted = _within(key, parts, *bounds, ranges)

    def per_key(frame: DataFrame, side: int) -> DataFrame:
        rows = frame.where(wanted).select(key, row_digest(frame, names).alias("digest"))
        return rows.select(key, F.lit(side).alias("side"), "digest")

    rows = per_key(left, 1).unionByName(per_key(right, -1))
    if workspace is not None:
        rows = workspace.keep(rows, "compared")
    found = rows.groupBy(key).agg(
        F.count_if(F.col("side") == 1).alias("here"),
        F.count_if(F.col("side") == -1).alias("there"),
        F.sum(F.col("side") * F.col("digest")).alias("digest"),
    )
    kind = F.when(F.col("there") == 0, MISSING).when(F.col("here") == 0, EXTRA).otherwise(CHANGED)
    differs = (F.col("here") != F.col("there")) | (F.col("digest") != 0)
    return found.where(differs).select(key, kind.alias("difference"))
