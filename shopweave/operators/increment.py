"""Merging few incoming rows into a large destination.

The incoming rows are written once; how many they are, and the range of their keys, is observed in that
write. The destination is then read for the keys that both sides have and for nothing else: the range
reaches its scan as a filter on row groups, and where the scan is large and the incoming keys don't fit
a broadcast, Spark builds a Bloom filter of them (at most 8 MB) and applies it in the scan. What is
shuffled of the destination are the few keys that pass, not all of them. With as many incoming rows as
the destination has the filters let everything through and the merge is the ordinary one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import Workspace
from .keysets import only_keys, without_keys
from .merge import one_per_key


@dataclass(frozen=True)
class Increment:
    """Written rows with their number, and the least and largest key (None if there is none)."""

    rows: DataFrame
    key: str
    count: int
    low: object
    high: object

    def keys(self) -> DataFrame:
        """The keys, with the range as a filter: a selective side is what Spark makes Bloom filters of."""
        return self.rows.select(self.key).where(self.in_range())

    def in_range(self) -> Column:
        key = F.col(self.key)
        return (key >= F.lit(self.low)) & (key <= F.lit(self.high))


def increment(rows: DataFrame, key: str, workspace: Workspace, unique: bool = False, name: str = "increment") -> Increment:
    """Write incoming rows, one per key unless ``unique`` says that they are so already."""
    taken = Observation(f"{name}-{uuid.uuid4().hex}")
    once = rows if unique else one_per_key(rows, key)
    watched = once.observe(
        taken, F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    kept = workspace.keep(watched, name)
    return Increment(kept, key, taken.get["n"], taken.get["low"], taken.get["high"])


def present_keys(dst: DataFrame, new: Increment) -> DataFrame:
    """The incoming keys that the destination has."""
    keys = dst.select(new.key)
    if new.low is None:
        return keys.limit(0)
    return only_keys(keys.where(new.in_range()), new.keys(), new.key)


def absent_rows(dst: DataFrame, new: Increment) -> DataFrame:
    """The incoming rows whose key the destination lacks; a null key is in no destination."""
    return without_keys(new.rows, present_keys(dst, new), new.key)


def insert_increment(dst: DataFrame, new: Increment) -> DataFrame:
    """The destination plus the incoming rows with new keys: ``insert_ignore`` for few rows."""
    if not new.count:
        return dst
    return dst.unionByName(absent_rows(dst, new), allowMissingColumns=True)


def increment_rejects(dst: DataFrame, new: Increment) -> DataFrame:
    """The incoming rows that the destination's own keep out."""
    return only_keys(new.rows, present_keys(dst, new), new.key)
