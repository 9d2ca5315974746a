"""Insert-if-absent and upsert as functions from old state to new state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .keysets import without_keys


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key; of several the smallest, so that a rerun chooses alike.

    Copies collapse before the shuffle, and the merge below reuses the same partitioning.
    """
    columns = rows.columns
    return (
        rows.groupBy(key)
        .agg(F.min(F.struct(*(c for c in columns if c != key))).alias("row"))
        .select(*(F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in columns))
    )


def new_rows(dst: DataFrame, src: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Source rows whose key the destination lacks. ``unique``: the source has no repeated key."""
    candidates = src if unique else one_per_key(src, key)
    return without_keys(candidates, dst, key).select(*src.columns)


def insert_ignore(dst: DataFrame, src: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Destination plus the source rows with new keys; existing rows win.

    The destination rows pass through without a shuffle; its keys are packed, or shuffled where they are too
    scattered. A column that only one side has is kept, and null in the other side's rows.
    """
    return dst.unionByName(new_rows(dst, src, key, unique), allowMissingColumns=True)


def insert_ignore_rejects(dst: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """Source rows that ``insert_ignore`` drops because the destination has their key."""
    return src.join(dst.select(key), key, "left_semi").select(*src.columns)


def upsert_options(options: DataFrame, changes: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Set option values by name; names not there yet are added with the next free ids.

    ``changes`` maps option_name to (option_value, autoload). A name that is there keeps its id
    and autoload. The changes are literals of the plan, so the option rows need no join: they are
    rewritten in place, and only the few wanted names are looked up for the rest.
    """
    name = F.col("option_name")
    updated = options.withColumn(
        "option_value",
        F.coalesce(
            *(F.when(name == key, F.lit(value)) for key, (value, _) in changes.items()),
            "option_value",
        ),
    )
    top = options.agg(F.max("option_id").alias("top")).scalar()
    rows = [(step, key, *change) for step, (key, change) in enumerate(changes.items(), start=1)]
    wanted = literal_rows(
        options.sparkSession, rows, ["option_id", "option_name", "option_value", "autoload"]
    )
    present = options.where(name.isin(list(changes))).select("option_name")
    added = wanted.join(present, "option_name", "left_anti").withColumn(
        "option_id", F.coalesce(top, F.lit(0)) + F.col("option_id")
    )
    return updated.unionByName(added.select(*options.columns))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few rows written into the plan itself; whole numbers become longs."""

    def cell(value, name):
        column = F.lit(value)
        return (column.cast("bigint") if isinstance(value, int) else column).alias(name)

    structs = [F.struct(*map(cell, row, names)) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
