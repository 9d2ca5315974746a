"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schema import SCHEMAS


def scan_table(spark: SparkSession, root: str, side: str, name: str) -> DataFrame:
    """A table of one side, kept as Parquet in ``root/side/name``, with all its stored columns.

    The columns that the library needs must be there, with types it can read as its own; columns it
    doesn't know pass through as they are.
    """
    frame = spark.read.parquet(f"{root.rstrip('/')}/{side}/{name}")
    return with_known_types(frame, name)


def with_known_types(frame: DataFrame, name: str) -> DataFrame:
    """The known columns of a table in their own types, all others unchanged; raises where a known
    column is missing. A column that has its type already is not touched, so filters still reach the
    scan."""
    if name not in SCHEMAS:
        return frame
    known = {f.name: f.dataType for f in StructType.fromDDL(SCHEMAS[name]).fields}
    if missing := [c for c in known if c not in frame.columns]:
        raise ValueError(f"table {name} lacks the columns {', '.join(missing)}")
    return frame.select(
        *(
            F.col(f"`{f.name}`").cast(known[f.name]).alias(f.name)
            if known.get(f.name, f.dataType) != f.dataType
            else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        )
    )


def jdbc_options(
    url: str,
    table: str,
    key: str,
    key_range: tuple[int, int],
    partitions: int,
    connection: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a parallel scan of a live database table, split by ranges of its integer key."""
    lower, upper = key_range
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **(connection or {}),
    }


def scan_database(spark: SparkSession, **scan) -> DataFrame:
    """``jdbc_options`` arguments to a frame; filters are pushed into the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**scan)).load()


#: Most relative error of a split point's place, as one part of so many.
ACCURACY = 100_000


def split_points(keys: DataFrame, key: str, partitions: int) -> list[int]:
    """Keys that cut the rows into ``partitions`` shares of about equal size, however the keys are spread:
    fewer where keys repeat. ``keys`` is any frame with the key, such as the table's last snapshot."""
    shares = F.array(*(F.lit(i / partitions) for i in range(1, partitions)))
    if partitions < 2:
        return []
    found = keys.agg(F.percentile_approx(key, shares, ACCURACY).alias("points")).first().points
    return sorted(set(found or []))


def key_predicates(points: Sequence[int], key: str) -> list[str]:
    """Conditions, one a partition, that hold each row once; rows without a key are in the first."""
    if not points:
        return ["1 = 1"]
    first = f"({key} < {points[0]} OR {key} IS NULL)"
    middle = [f"({key} >= {a} AND {key} < {b})" for a, b in zip(points, points[1:], strict=False)]
    return [first, *middle, f"({key} >= {points[-1]})"]


def scan_database_in_shares(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    points: Sequence[int],
    connection: Mapping[str, str] | None = None,
) -> DataFrame:
    """A live database table in shares of equal size: for keys with gaps, where equal ranges of the key
    leave most tasks without work."""
    properties = {"fetchsize": "10000", **(connection or {})}
    return spark.read.jdbc(url, table, predicates=key_predicates(points, key), properties=properties)


# The column by which each large table is joined.
JOIN_KEYS = {
    "posts": "id",
    "postmeta": "post_id",
    "order_items": "order_id",
    "order_itemmeta": "order_item_id",
    "users": "id",
    "usermeta": "user_id",
    "term_relationships": "object_id",
}


def overwrite_bucketed(
    frame: DataFrame, table: str, key: str, buckets: int, path: str | None = None
) -> None:
    """Full rebuild of a catalogued table, bucketed and sorted by its join key.

    Tables bucketed alike meet without a shuffle: posts by ``id`` and metadata by ``post_id``
    serve every pivot, export and check. Worth it for a source that several jobs read.
    """
    writer = frame.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
