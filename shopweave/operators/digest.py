"""Digests of rows, whose sums don't depend on the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hashable(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    return F.to_json(F.struct(column)) if "map<" in kind else column


def row_digest(frame: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A number for a row's values, by column name; a null differs from every value."""
    kinds = sorted((f.name, f.dataType.simpleString()) for f in frame.schema.fields if columns is None or f.name in columns)
    row = F.xxhash64(*(F.lit(n) for n, _ in kinds), *(_hashable(n, k) for n, k in kinds))
    # a null changes no hash, so nulls are told apart by where they are
    nulls = F.xxhash64(*(F.col(f"`{n}`").isNull() for n, _ in kinds))
    return row.cast("decimal(38,0)") + nulls.cast("decimal(38,0)")


def digest_of(frame: DataFrame) -> Column:
    """Aggregate: a sum over the rows of a hash of all columns, as text."""
    return F.coalesce(F.sum(row_digest(frame)), F.lit(0)).cast("string")
