"""Timestamped copies of a store's tables, with a manifest that says what is in them.

Each table's rows are counted, and a digest of them taken, in the write itself. The manifest is written
last: a snapshot without one was not completed and is refused. A restore takes the same measure of what
it writes and raises where that differs from the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.digest import digest_of
from ..plans.store import Store
from ..session import CODEC

MANIFEST = "manifest"
MANIFEST_COLUMNS = "table_name string, n_rows bigint, digest string, columns string"


class Measured:
    """A frame whose rows are counted and digested by whatever writes it."""

    def __init__(self, name: str, frame: DataFrame):
        self.name, self.columns = name, frame.schema.simpleString()
        self._taken = Observation(f"{name}-{uuid.uuid4().hex}")
        self.frame = frame.observe(self._taken, F.count("*").alias("n_rows"), digest_of(frame).alias("digest"))

    def row(self) -> tuple[str, int, str, str]:
        """The table's line in a manifest; waits for the write."""
        return self.name, self._taken.get["n_rows"], self._taken.get["digest"], self.columns


def snapshot_tables(store: Store, folder: str, stamp: str, codec: str = "gzip") -> str:
    """Write every table of the store to ``folder/stamp``, then its manifest; a stamp is never overwritten."""
    target, rows, spark = f"{folder.rstrip('/')}/{stamp}", [], None
    for name, frame in store.tables().items():
        measured, spark = Measured(name, frame), frame.sparkSession
        measured.frame.write.mode("errorifexists").option("compression", codec).parquet(f"{target}/{name}")
        rows.append(measured.row())
    if spark is None:
        raise ValueError("a store without tables has no snapshot")
    lines = spark.createDataFrame(rows, MANIFEST_COLUMNS).coalesce(1)
    lines.write.mode("errorifexists").json(f"{target}/{MANIFEST}")
    return target


def read_manifest(spark: SparkSession, folder: str, stamp: str) -> DataFrame:
    """(table_name, n_rows, digest, columns) of a completed snapshot."""
    path = f"{folder.rstrip('/')}/{stamp}/{MANIFEST}"
    try:
        return spark.read.schema(MANIFEST_COLUMNS).json(path)
    except AnalysisException as error:
        raise ValueError(f"the snapshot {stamp} has no manifest: it was not completed") from error


def _lines(spark: SparkSession, folder: str, stamp: str, names: Iterable[str] | None) -> dict[str, tuple]:
    """The manifest's lines of the wanted tables, all if none are named: one line a table."""
    lines = {r.table_name: tuple(r) for r in read_manifest(spark, folder, stamp).collect()}
    wanted = list(lines if names is None else names)
    if unknown := [n for n in wanted if n not in lines]:
        raise ValueError(f"the snapshot {stamp} has no {', '.join(unknown)}")
    return {n: lines[n] for n in wanted}


def read_snapshot(spark: SparkSession, folder: str, stamp: str, names: Iterable[str] | None = None) -> Store:
    target = f"{folder.rstrip('/')}/{stamp}"
    lines = _lines(spark, folder, stamp, names)
    return Store(**{name: spark.read.parquet(f"{target}/{name}") for name in lines})


def restore_snapshot(
    spark: SparkSession, folder: str, stamp: str, names: Iterable[str] | None, destination: str
) -> Store:
    """Replace the destination's tables by those of a completed snapshot, hold what was written against
    the manifest, and read the tables back. Without names all tables are restored."""
    if destination.rstrip("/") == f"{folder.rstrip('/')}/{stamp}":
        raise ValueError("a snapshot cannot be restored onto itself")
    lines = _lines(spark, folder, stamp, names)
    differs = []
    for name, frame in read_snapshot(spark, folder, stamp, lines).tables().items():
        measured = Measured(name, frame)
        measured.frame.write.mode("overwrite").option("compression", CODEC).parquet(f"{destination}/{name}")
        if measured.row()[1:3] != lines[name][1:3]:
            differs.append(name)
    if differs:
        raise ValueError(f"the snapshot {stamp} differs from its manifest in {', '.join(differs)}")
    return Store(**{name: spark.read.parquet(f"{destination}/{name}") for name in lines})
