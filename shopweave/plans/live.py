"""Putting a job's tables in the place of the old ones.

Readers use one catalog view a table. A job writes its tables to fresh folders, and one catalog step per
table points the view at the new folder: readers see the old rows or the new ones, never a half-written
table. The old folders stay, and the views know them, so a swap can be taken back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.reports import wide_reconciliation
from ..session import Workspace
from .orders import WIDE_TABLES, job_convert_wide
from .store import Store

FOLDER, PREVIOUS = "store.folder", "store.previous_folder"


def _properties(spark: SparkSession, view: str) -> dict[str, str]:
    if not spark.catalog.tableExists(view):
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}


def _point(spark: SparkSession, view: str, folder: str, previous: str | None) -> None:
    known = {FOLDER: folder} | ({PREVIOUS: previous} if previous else {})
    properties = ", ".join(f"'{key}' = '{value}'" for key, value in known.items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({properties}) AS SELECT * FROM parquet.`{folder}`")


def live_folder(spark: SparkSession, view: str) -> str | None:
    """The folder that a view shows; None if there is no such view, or another made it."""
    return _properties(spark, view).get(FOLDER)


def swap_in(spark: SparkSession, folders: dict[str, str], prefix: str) -> Store:
    """Point the view ``prefix`` + name of each table at its new folder, and return the live tables. A
    repeated swap to the same folder changes nothing. A table or a view that no swap has made is refused
    before any view changes."""
    views = {name: f"{prefix}{name}" for name in folders}
    for view in views.values():
        if spark.catalog.tableExists(view) and live_folder(spark, view) is None:
            raise ValueError(f"{view} is there already and no swap has made it")
    for name, folder in folders.items():
        if (now := live_folder(spark, views[name])) != folder:
            _point(spark, views[name], folder, now)
    return live_store(spark, folders, prefix)


def swap_back(spark: SparkSession, names, prefix: str) -> Store:
    """Point the views at the folders they showed before; all must have one."""
    old = {n: _properties(spark, f"{prefix}{n}") for n in names}
    if missing := [n for n, p in old.items() if PREVIOUS not in p]:
        raise ValueError(f"no earlier tables of {', '.join(missing)}")
    for name, properties in old.items():
        _point(spark, f"{prefix}{name}", properties[PREVIOUS], properties[FOLDER])
    return live_store(spark, names, prefix)


def live_store(spark: SparkSession, names, prefix: str) -> Store:
    return Store(**{name: spark.table(f"{prefix}{name}") for name in names})


def job_convert_wide_live(
    spark: SparkSession, dst: Store, workspace: Workspace, prefix: str
) -> tuple[Store, DataFrame]:
    """The wide tables rebuilt, written, checked, and only then put in the old ones' place; the check that
    is returned is of the live tables. Where the orders differ the old tables stay and the job raises."""
    after, check = job_convert_wide(dst, workspace)
    if check.first().result != "complete":
        raise ValueError("the wide tables don't have the posts' orders; the old ones stay")
    names = (*WIDE_TABLES, "options")
    live = swap_in(spark, {n: after.folders[n] for n in names}, prefix)
    return after.having(**live.tables()), wide_reconciliation(dst.posts, live.wc_orders)
