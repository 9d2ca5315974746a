"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure


#: Most text in a batch that Spark hands to Python, whatever the lengths of the texts.
BATCH_BYTES = "8m"


def bounded(spark: SparkSession) -> SparkSession:
    """Bound the batches handed to Python by bytes, for this session, and split skewed joins."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is an empty text."""
    return [text or b"" for text in texts.cast(pa.large_binary()).to_pylist()]


def strings(texts: pa.Array) -> list[str]:
    """Each text; a null is an empty text."""
    return [text or "" for text in texts.to_pylist()]


def slices(sizes: list[int], most: int):
    """Ranges of rows whose sizes add up to about ``most``; bounds what one step holds in memory."""
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def crc32_of(column: str) -> Column:
    """CRC-32 of a column as text; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def key_of(text: str) -> Column:
    """128-bit key of a text's content: copies of a text share it. A null is an empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
