"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Results depend on the first; the others keep plans adaptive: AQE picks broadcast joins from
# measured sizes, coalesces small partitions and splits skewed join partitions. The next two let it
# split even where that costs a shuffle, which several joins on one key would otherwise forbid, and
# hash a join side whose every shuffled partition is small in place of sorting both sides. The last two let
# it make Bloom filters of a join's small side where the other scans more than 1 GB; Spark bounds their size.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
}

#: Of the tables that jobs write.
CODEC = "zstd"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on; sizes stay the cluster's choice."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "shopweave") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A local session may go without one and then gets its own temporary folder. On a cluster a
    machine-local folder would lose data with its machine, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    """One temporary folder for all runs of this process; the setting itself can't be changed."""
    return tempfile.mkdtemp(prefix="shopweave-")


class Workspace:
    """Written intermediate tables of one run, under the shared folder.

    ``keep`` stores a frame that several outputs need and reads it back. The written table cuts
    the lineage and survives the loss of executors, unlike a cached or locally checkpointed one.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or shared_root(spark)}/run-{uuid.uuid4().hex}"
        self._names = count(1)
        self._tables: list[str] = []

    def location(self, name: str) -> str:
        """A folder no earlier step of this run has used; frames read their tables lazily."""
        return f"{self.path}/{next(self._names)}-{name}"

    def store(self, frame: DataFrame, name: str) -> str:
        """Write a frame to a fresh folder, and say which."""
        path = self.location(name)
        frame.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        return path

    def read(self, frame: DataFrame, path: str) -> DataFrame:
        """What was stored of a frame."""
        return self.spark.read.schema(frame.schema).parquet(path)

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        return self.read(frame, self.store(frame, name))

    def keep_bucketed(self, frame: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A kept table in buckets of a key that several later joins and aggregates share: one shuffle here
        in place of one for each of them. Rows are dealt by bucket, and adaptive execution splits a large
        bucket among several tasks, so that none sorts more than a share of it. The table is known to the
        session's catalog under a name of this run's; ``forget`` takes the names away and leaves the files."""
        path = self.location(name)
        table = f"run_{uuid.uuid4().hex}_{name}"
        bucket = F.pmod(F.hash(key), F.lit(buckets))
        dealt = frame.withColumn("__bucket", bucket).hint("rebalance", "__bucket").drop("__bucket")
        writer = dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", path).option("compression", CODEC).saveAsTable(table)
        self._tables.append(table)
        return self.spark.table(table)

    def forget(self) -> None:
        """Drop the names of the bucketed tables; frames that were built from them stay readable."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")
