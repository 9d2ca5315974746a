"""Rows whose key is, or is not, among many others, without a shuffle of the rows.

The other keys are packed: one row holds which of 256 neighbouring keys there are, as four words of 64 bits.
Ids that are handed out one after the other pack well (54 million are 210,000 rows), so the set is broadcast
where a plain one would be far too large, and the rows stay where they are. The packed rows are counted
first, then written to the shared folder: a plan that meets them often reads a small table. Keys that are
too scattered are looked at within the range of the rows' own keys; where that is too much as well, both
sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ..session import Workspace

#: Most packed rows that are broadcast: 48 MB.
MOST_BLOCKS = 1 << 20
WORDS = 4
BLOCK = "__block"


def _word(key: Column) -> Column:
    return F.shiftright(key, 6).bitwiseAND(F.lit(WORDS - 1))


def _block(key: Column) -> Column:
    return F.shiftright(key, 8)


def packed(keys: DataFrame, key: str) -> DataFrame:
    """A row for each 256 neighbouring keys of which there is one, with a bit for each; nulls are left out."""
    number = F.col(key).cast("bigint")
    numbers = keys.where(F.col(key).isNotNull()).select(number.alias("__key"))
    at = F.col("__key")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    words = (F.bit_or(F.when(_word(at) == i, bit)).alias(f"__word{i}") for i in range(WORDS))
    return numbers.groupBy(_block(at).alias(BLOCK)).agg(*words)


def _is_in(key: Column) -> Column:
    word = F.coalesce(*(F.when(_word(key) == i, F.col(f"__word{i}")) for i in range(WORDS)))
    shifted = F.call_function("shiftright", word, key.bitwiseAND(F.lit(63)).cast("int"))
    return (_block(key) == F.col(BLOCK)) & (shifted.bitwiseAND(F.lit(1)) == 1)


def _fits(keys: DataFrame, key: str) -> bool:
    blocks = keys.agg(F.approx_count_distinct(_block(F.col(key).cast("bigint")))).first()[0]
    return blocks <= MOST_BLOCKS


def _stored(blocks: DataFrame) -> DataFrame:
    """The packed keys, written; a cluster without a shared folder plans them where they are needed."""
    try:
        workspace = Workspace(blocks.sparkSession)
    except ValueError:
        return blocks
    return workspace.keep(blocks, "keys")


def _can_pack(rows: DataFrame, keys: DataFrame, key: str) -> bool:
    """Whole numbers, and a session that allows broadcasts."""
    kinds = {type(frame.schema[key].dataType) for frame in (rows, keys)}
    threshold = rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return kinds <= {LongType, IntegerType} and not threshold.startswith("-")


def _joined(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    keys = keys.select(key)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    if _can_pack(rows, keys, key):
        if not (fits := _fits(keys, key)):
            low, high = rows.agg(F.min(key), F.max(key)).first()
            keys = keys.limit(0) if low is None else keys.where(F.col(key).between(low, high))
            fits = _fits(keys, key)
        if fits:
            return rows.join(F.broadcast(_stored(packed(keys, key))), _is_in(F.col(key).cast("bigint")), how).select(*columns)
    return rows.join(keys, key, how).select(*columns)


def only_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in ``keys``, a frame with a column of that name."""
    return _joined(rows, keys, key, "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``keys``; a null key is in none."""
    return _joined(rows, keys, key, "left_anti")
