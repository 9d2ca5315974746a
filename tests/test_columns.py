"""Columns that the library doesn't know come through; sessions without a shared folder work."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from rows import posts, post, table, values

from shopweave.functions import from_unixtime, to_decimal
from shopweave.operators.filters import purge_transients, purge_transients_any
from shopweave.operators.merge import insert_ignore
from shopweave.operators.statuses import sync_statuses_exact
from shopweave.plans.store import Store
from shopweave.sources.snapshots import restore_snapshot, snapshot_tables
from shopweave.sources.tables import scan_table

HERE = os.path.dirname(os.path.abspath(__file__))


@pytest.fixture
def users(spark):
    rows = table(spark, "users", [(1, "a", "a@x", "A"), (2, "b", "b@x", "B")])
    return rows.withColumn("user_pass", F.concat(F.lit("p"), "id")).withColumn("user_url", F.lit(None).cast("string"))


def test_scan_keeps_unknown_columns(spark, users, tmp_path):
    users.withColumn("id", F.col("id").cast("int")).write.parquet(f"{tmp_path}/src/users")
    found = scan_table(spark, str(tmp_path), "src", "users")
    assert found.columns == users.columns
    assert found.schema["id"].dataType.simpleString() == "bigint"
    assert values(found) == values(users)


def test_scan_names_missing_columns(spark, users, tmp_path):
    users.drop("user_email").write.parquet(f"{tmp_path}/src/users")
    with pytest.raises(ValueError, match="user_email"):
        scan_table(spark, str(tmp_path), "src", "users")


def test_insert_keeps_columns_of_both_sides(users):
    dst = users.where("id = 1").drop("user_url").withColumn("only_here", F.lit("x"))
    got = {r.id: r.asDict() for r in insert_ignore(dst, users, "id").collect()}
    assert got[1]["only_here"] == "x" and got[2]["only_here"] is None
    assert got[2]["user_pass"] == "p2"


def test_snapshot_and_restore_keep_all(spark, users, tmp_path):
    snapshot_tables(Store(users=users), f"{tmp_path}/s", "1")
    back = restore_snapshot(spark, f"{tmp_path}/s", "1", ["users"], f"{tmp_path}/back")
    assert back.users.columns == users.columns and values(back.users) == values(users)


def test_options_without_a_name_stay(spark):
    options = table(spark, "options", [(1, None, "v", "yes"), (2, "_transient_x", "v", "yes"), (3, "o", "v", "yes")])
    assert [r.option_id for r in purge_transients(options).orderBy("option_id").collect()] == [1, 3]
    assert [r.option_id for r in purge_transients_any(options).orderBy("option_id").collect()] == [1, 3]


def test_number_heads(spark):
    texts = ["1e3", "1.5E-1x", "2e", " 7", "1700000000.5", "1700000000abc", "x", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        to_decimal(F.col("t")).cast("double").alias("n"), from_unixtime(F.col("t")).alias("d")
    ).collect()
    assert [r.n for r in got] == [1000, 0.15, 2, 7, 1700000000.5, 1700000000, 0, 0]
    assert got[4].d == got[5].d != None  # noqa: E711
    assert got[6].d is None and got[7].d is None


def test_sync_sets_both_dates(spark):
    import datetime

    now = datetime.datetime(2025, 1, 1)
    feed = spark.createDataFrame([(1, "wc-on-hold")], "id long, status string")
    got = {r.id: r for r in sync_statuses_exact(posts(spark, post(1), post(2)), feed, now).collect()}
    assert got[1].post_modified == got[1].post_modified_gmt == now
    assert got[2].post_modified != now and got[2].post_modified_gmt != now


def test_plain_session_needs_no_setting(tmp_path):
    """A real session whose Spark defaults don't name a shared folder."""
    code = (
        "from shopweave.session import Workspace, local_session\n"
        "s = local_session(1, '1g')\n"
        "a, b = Workspace(s), Workspace(s)\n"
        "assert a.keep(s.range(3), 'x').count() == 3 and b.keep(s.range(2), 'x').count() == 2\n"
        "assert a.path != b.path\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(HERE)}
    subprocess.run([sys.executable, "-c", code], env=env, check=True, timeout=300)
