"""Export the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import PREVIEW_ROWS
from ..operators.catalog import catalog_rows, product_terms
from ..sources.files import read_catalog_csv, write_catalog_csv
from .store import Store


def job_export_catalog(
    spark: SparkSession,
    store: Store,
    path: str,
    domain: str,
    in_stock: bool = False,
    test: bool = False,
    rows_per_file: int = 0,
) -> DataFrame:
    """Write the catalogue as CSV and return what was written. ``test`` exports ten products."""
    named = product_terms(store.term_relationships, store.term_taxonomy, store.terms)
    limit = PREVIEW_ROWS if test else None
    rows = catalog_rows(store.posts, store.postmeta, named, domain, in_stock, limit)
    write_catalog_csv(rows, path, rows_per_file)
    return read_catalog_csv(spark, path)
