"""Every registered query against its own SQL in the other engine."""

import pytest
from engines import connect, duck_rows, spark_rows

import __spark_entry__ as entry_points
from shopweave.checks.oracles import all_oracles
from shopweave.checks.queries import QUERIES, Inputs, comparable
from shopweave.checks.store_frames import DerivedStore


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    """Shared by all queries here, so that plans of the inputs are built once."""
    return Inputs(spark, DerivedStore(spark, sf_dir))


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_each_query_has_its_sql():
    assert set(all_oracles()) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(name, inputs, duck):
    inputs.__dict__.pop("workspace", None)  # a fresh folder for each query that writes
    frame = comparable(QUERIES[name](inputs))
    names, rows = spark_rows(frame)
    sql_names, sql_rows = duck_rows(duck, all_oracles()[name])
    assert names == sql_names
    assert rows == sql_rows
    assert rows


def test_entry_runs(spark):
    assert len(entry_points.entry(spark).columns) == 17
