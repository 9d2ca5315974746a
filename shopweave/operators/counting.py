"""Counts put side by side in one row."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counted(frame: DataFrame) -> DataFrame:
    """One row ``n``: how many rows the frame has."""
    return frame.agg(F.count("*").alias("n"))


def labelled_counts(counts: Mapping[str, DataFrame], label: str = "name") -> DataFrame:
    """Union of one-row counts ``n`` as (label, n)."""
    rows = [frame.select(F.lit(name).alias(label), "n") for name, frame in counts.items()]
    return reduce(DataFrame.unionByName, rows)


def count_row(counts: Mapping[str, DataFrame]) -> DataFrame:
    """One-row counts ``n`` of several frames as the columns of one row."""
    return labelled_counts(counts).agg(
        *(F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in counts)
    )


def with_counts(row: DataFrame, counts: Mapping[str, DataFrame]) -> DataFrame:
    """A one-row frame with further one-row counts ``n`` as scalar subqueries."""
    return row.withColumns({name: frame.scalar() for name, frame in counts.items()})
