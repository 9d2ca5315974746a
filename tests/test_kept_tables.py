"""How a run's tables are written: shares of a bucket, and their codec."""

from pathlib import Path

from pyspark.sql import functions as F
from rows import table, values

from shopweave.functions import to_decimal
from shopweave.plans.store import Store
from shopweave.sources.snapshots import restore_snapshot, snapshot_tables


def test_a_large_bucket_is_written_by_several_tasks(spark, workspace):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16KB")
    try:
        rows = spark.range(0, 60_000, 1, 6).select("id", F.uuid().alias("t")).localCheckpoint()
        kept = workspace.keep_bucketed(rows, "rows", "id", 2)
        files = list(Path(kept.inputFiles()[0].removeprefix("file:")).parent.glob("*.parquet"))
        assert len(files) > 4 and all(".zstd." in f.name for f in files)
        assert kept.columns == ["id", "t"] and kept.exceptAll(rows).isEmpty() and kept.count() == 60_000
        plan = kept.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.set(setting, before)
        workspace.forget()


def test_written_and_restored_tables_are_zstd(spark, workspace, tmp_path):
    store = Store(options=table(spark, "options", [(1, "a", "b", "no")]))
    written = store.written(workspace)
    snapshot_tables(store, str(tmp_path / "s"), "t1")
    restored = restore_snapshot(spark, str(tmp_path / "s"), "t1", None, str(tmp_path / "live"))
    for frame in (written.options, restored.options, workspace.keep(store.options, "options")):
        assert values(frame) == values(store.options)
        assert all(".zstd." in f for f in frame.inputFiles())


def test_texts_without_a_number_are_not_cast(spark):
    texts = ["", " ", "x1", "é", "+", "-", ".", ",5", "/5", "5", " 5", "  -5.5x", "+.5", "5.", "1e2z", "1e99", ":1", "\t5", "12.5abc", None]
    found = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(to_decimal(F.col("t")).cast("double").alias("n")).collect()]
    assert found == [0, 0, 0, 0, 0, 0, 0, 0, 0, 5, 5, -5.5, 0.5, 5, 100, 0, 0, 0, 12.5, 0]
    plan = spark.range(1).selectExpr("CAST(id AS string) t").select(to_decimal(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("regexp_extract")
