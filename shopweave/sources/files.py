"""Catalogue CSV, status feed and full rebuild of a wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import CATALOG_COLUMNS
from ..operators.catalog import newest_first
from ..operators.statuses import orders_by_id
from .schema import STATUS_FEED

# Every field quoted, quotes doubled, spaces kept.
CSV_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
TSV_FORMAT = {"sep": "\t", "header": False}


def write_catalog_csv(rows: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Catalogue rows (with their date) as CSV, newest first across the files in name order.

    Files are written in parallel, each with the header; ``rows_per_file`` caps their length.
    """
    ordered = rows.orderBy(*newest_first()).select(*CATALOG_COLUMNS)
    ordered.write.mode("overwrite").options(
        **CSV_FORMAT, quoteAll=True, maxRecordsPerFile=rows_per_file
    ).csv(path)


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(
        f"{name} {'BIGINT' if name == 'product_id' else 'STRING'}" for name in CATALOG_COLUMNS
    )
    # A text may hold line ends, so a file is read by one task; the writer makes a file per task.
    raw = spark.read.schema(schema).options(**CSV_FORMAT, multiLine=True).csv(path)
    # The reader returns an empty quoted field as null.
    return raw.select(
        "product_id", *(F.coalesce(c, F.lit("")).alias(c) for c in CATALOG_COLUMNS[1:])
    )


def write_status_tsv(posts: DataFrame, path: str) -> None:
    """(id, status) of every order, tab-separated, by id."""
    write_status_rows(orders_by_id(posts), path)


def write_status_rows(rows: DataFrame, path: str) -> None:
    """Rows (id, status) as a feed, in the order that they have."""
    rows.write.mode("overwrite").options(**TSV_FORMAT).csv(path)


def read_status_tsv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """A status feed; ``header`` for one that starts with the column names."""
    raw = spark.read.schema(STATUS_FEED).options(**{**TSV_FORMAT, "header": header}).csv(path)
    return raw.select("id", F.coalesce("status", F.lit("")).alias("status"))


#: What makes a line of a feed unusable.
NO_NUMBER, NOT_TWO_FIELDS = "no number", "not two fields"
# Fixed value: an id as a whole number.
ID_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def read_status_lines(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Every line of a status feed with its place: file, block, place, line, id, status, reason.

    Lines are ordered by file, the block of the file that a task read, and the place in it. ``reason`` is
    null for a usable line, and says else why it is none; such a line has no id. An empty line is no line.
    With ``header`` the first line of each file is left out.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    fields = F.split("line", TSV_FORMAT["sep"], -1)
    reason = F.when(F.size(fields) != 2, NOT_TWO_FIELDS).when(
        ~fields[0].rlike(ID_PATTERN) | F.trim(fields[0]).try_cast("bigint").isNull(), NO_NUMBER
    )
    lines = lines.where("line <> ''").withColumn("reason", reason)
    if header:
        # the first line of a file is the first of its first block
        first = lines.where("block = 0").groupBy("file").agg(F.min("place").alias("place"))
        lines = lines.join(first.withColumn("block", F.lit(0).cast("bigint")), ["file", "block", "place"], "left_anti")
    usable = F.col("reason").isNull()
    return lines.select(
        "file", "block", "place", "line",
        F.when(usable, F.trim(fields[0]).try_cast("bigint")).alias("id"),
        F.when(usable, fields[1]).alias("status"),
        "reason",
    )


def accepted_lines(lines: DataFrame) -> DataFrame:
    """(id, status, file, block, place) of the usable lines: a feed that knows the order of its lines."""
    return lines.where("reason IS NULL").select("id", "status", "file", "block", "place")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(file, block, place, line, reason) of the others."""
    return lines.where("reason IS NOT NULL").select("file", "block", "place", "line", "reason")


def overwrite_wide(frame: DataFrame, path: str) -> None:
    """Full rebuild of a table, so that a rerun leaves the same rows.

    ``frame`` must not read ``path``: Spark empties the folder before it reads.
    """
    frame.write.mode("overwrite").parquet(path)
