"""Whole tables as one row each: number of rows, and a sum over the rows of a hash of all columns.

The sum doesn't depend on the order of rows or columns, so a job's tables can be held against the other
engine's without listing them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType

NOTHING = "<null>"
#: Money is compared in units of this many to one.
UNITS = 10**8


def _text(column: str, kind: DataType) -> Column:
    value = F.col(f"`{column}`")
    if isinstance(kind, (DecimalType, DoubleType)):
        value = F.round(value.cast("double") * UNITS).cast("bigint")
    return F.coalesce(value.cast("string"), F.lit(NOTHING))


def digests(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, digest) of each table."""

    def one(name: str, frame: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in frame.schema.fields}
        row = F.md5(F.concat_ws("|", *(_text(c, kinds[c]) for c in sorted(kinds))).cast("binary"))
        number = F.conv(F.substring(row, 1, 8), 16, 10).cast("bigint")
        return frame.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.coalesce(F.sum(number), F.lit(0)).alias("digest"),
        )

    return reduce(DataFrame.unionByName, (one(n, f) for n, f in tables.items()))


def digest_sql(tables: dict[str, tuple[str, list[str], list[str]]]) -> str:
    """The same in SQL. ``tables``: by name the table or query, its columns, and which are money."""

    def one(name: str, source: str, columns: list[str], money: list[str]) -> str:
        texts = ", ".join(
            f"coalesce(CAST({f'CAST(round({c} * {UNITS}) AS BIGINT)' if c in money else c} AS VARCHAR), '{NOTHING}')"
            for c in sorted(columns)
        )
        return (
            f"SELECT '{name}' AS table_name, count(*) AS n_rows, coalesce(CAST(sum(CAST('0x' || "
            f"substr(md5(concat_ws('|', {texts})), 1, 8) AS BIGINT)) AS BIGINT), 0) AS digest FROM {source}"
        )

    return " UNION ALL ".join(one(name, *parts) for name, parts in tables.items())
