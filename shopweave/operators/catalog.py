"""The denormalised product catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    CATALOG_BATCH,
    CATALOG_COLUMNS,
    CATEGORY_TAXONOMY,
    DEFAULT_CATEGORY,
    EXPORTED_TAGS,
    FILE_KEY,
    NAME_SEPARATOR,
    PREVIEW_ROWS,
    PRICE_KEY,
    REGULAR_PRICE_KEY,
    SKU_KEY,
    TAG_TAXONOMY,
    THUMBNAIL_KEY,
)
from ..functions import clean_text, image_url, price_fallback, product_type, to_unsigned
from ..session import Workspace
from .counting import counted
from .eav import pivot_first
from .filters import published_products, without_blocked
from .ordering import numbered

# --- images ----------------------------------------------------------------------------


def product_images(products: DataFrame, postmeta: DataFrame) -> DataFrame:
    """``products`` with image_path by two hops: product to thumbnail id, thumbnail to file.

    The metadata side is joined first, on image ids that are never null, so products without a
    thumbnail, whose path is null, do not pile up under a null key. An image shared by very many
    products makes one large join partition, which adaptive execution splits.
    """
    key, value = F.col("meta_key"), F.col("meta_value")
    thumbnails = postmeta.where(key == THUMBNAIL_KEY).select(
        F.col("post_id").alias("id"), to_unsigned(value).alias("image_id")
    )
    files = postmeta.where(key == FILE_KEY).select(
        F.col("post_id").alias("image_id"), value.alias("image_path")
    )
    linked = thumbnails.join(files, "image_id", "left")
    return products.join(linked.select("id", "image_path"), "id", "left")


def products_with_image(products: DataFrame, postmeta: DataFrame) -> DataFrame:
    """Only images with a path; the optimizer then runs both hops as inner joins."""
    path = F.col("image_path")
    return product_images(products, postmeta).where(path.isNotNull() & (path != ""))


# --- terms -----------------------------------------------------------------------------


def product_terms(
    term_relationships: DataFrame, term_taxonomy: DataFrame, terms: DataFrame
) -> DataFrame:
    """(object_id, taxonomy, name).

    The two vocabulary tables are joined first. Whether the result is broadcast is left to its
    size: above the session's threshold it is shuffled, and a term that marks a third of all
    products is split by adaptive execution.
    """
    named = term_taxonomy.join(terms, "term_id").select("term_taxonomy_id", "taxonomy", "name")
    return term_relationships.join(named, "term_taxonomy_id").select("object_id", "taxonomy", "name")


def _names(condition: str):
    """Names in order of name, joined; null for a product without any.

    As long as the vocabulary one product uses, which is also the length of the result.
    """
    return F.expr(
        f"listagg(name, '{NAME_SEPARATOR}') WITHIN GROUP (ORDER BY name) FILTER (WHERE {condition})"
    )


_IS_CATEGORY = f"taxonomy = '{CATEGORY_TAXONOMY}'"
_IS_TAG = f"taxonomy = '{TAG_TAXONOMY}'"
_IS_EXPORTED_TAG = f"{_IS_TAG} AND name IN ({', '.join(repr(tag) for tag in EXPORTED_TAGS)})"


def product_categories(named: DataFrame) -> DataFrame:
    """(object_id, category) of the objects that have one."""
    return named.where(_IS_CATEGORY).groupBy("object_id").agg(_names("true").alias("category"))


def product_tags(named: DataFrame) -> DataFrame:
    """(object_id, tags) of the objects with one of the exported tags."""
    return named.where(_IS_EXPORTED_TAG).groupBy("object_id").agg(_names("true").alias("tags"))


def tag_flags(named: DataFrame, tag: str) -> DataFrame:
    """(object_id) of the objects that carry a tag."""
    return named.where(F.expr(_IS_TAG) & (F.col("name") == tag)).select("object_id").distinct()


def has_tag(products: DataFrame, named: DataFrame, tag: str) -> DataFrame:
    """(id, has_tag) of every product."""
    tagged = tag_flags(named, tag).select(F.col("object_id").alias("id"), F.lit(True).alias("found"))
    return (
        products.select("id")
        .join(tagged, "id", "left")
        .select("id", F.coalesce("found", F.lit(False)).alias("has_tag"))
    )


def _term_summary(named: DataFrame) -> DataFrame:
    """Categories, tags and both tag tests per object, from one pass over the relationships."""
    buynow, thirty = EXPORTED_TAGS
    return (
        named.where(f"{_IS_CATEGORY} OR {_IS_EXPORTED_TAG}")
        .groupBy(F.col("object_id").alias("id"))
        .agg(
            _names(_IS_CATEGORY).alias("category"),
            _names(_IS_EXPORTED_TAG).alias("tags"),
            F.bool_or(F.expr(_IS_TAG) & (F.col("name") == buynow)).alias("has_buynow"),
            F.bool_or(F.expr(_IS_TAG) & (F.col("name") == thirty)).alias("has_30days"),
        )
    )


# --- catalogue -------------------------------------------------------------------------


def exportable_products(
    products: DataFrame, postmeta: DataFrame, in_stock: bool = False
) -> DataFrame:
    """A row per published product to export and image of it."""
    if in_stock:
        products = without_blocked(products, postmeta)
    return products_with_image(products, postmeta)


def catalog_count(posts: DataFrame, postmeta: DataFrame, in_stock: bool = False) -> DataFrame:
    products = published_products(posts).select("id")
    return counted(exportable_products(products, postmeta, in_stock))


def _described(products: DataFrame, postmeta: DataFrame, named: DataFrame, domain: str, *more: str) -> DataFrame:
    """The catalogue columns of products with an image path, and further columns of theirs."""
    values = pivot_first(
        postmeta, {"own_price": PRICE_KEY, "regular_price": REGULAR_PRICE_KEY, "own_sku": SKU_KEY}
    ).withColumnRenamed("post_id", "id")
    return (
        products.join(values, "id", "left")
        .join(_term_summary(named), "id", "left")
        .select(
            F.col("id").alias("product_id"),
            clean_text(F.col("post_title")).alias("post_title"),
            F.col("post_name").alias("slug"),
            clean_text(F.col("post_excerpt")).alias("short_description"),
            clean_text(F.col("post_content")).alias("description"),
            image_url(domain, F.col("image_path")).alias("image_url"),
            price_fallback(F.col("own_price"), F.col("regular_price")).alias("price"),
            F.coalesce("own_sku", F.lit("")).alias("sku"),
            F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("category"),
            product_type(F.col("has_buynow"), F.col("has_30days")).alias("product_type"),
            F.coalesce("tags", F.lit("")).alias("tags"),
            *more,
        )
    )


def _with_texts(posts: DataFrame) -> DataFrame:
    return published_products(posts).select(
        "id", "post_title", "post_name", "post_excerpt", "post_content", "post_date"
    )


def catalog_keys(posts: DataFrame, postmeta: DataFrame, in_stock: bool = False) -> DataFrame:
    """(id, post_date, image_path) of every row of the catalogue: what its order depends on, no texts."""
    products = published_products(posts).select("id", "post_date")
    return exportable_products(products, postmeta, in_stock)


def catalog_rows(
    posts: DataFrame,
    postmeta: DataFrame,
    named: DataFrame,
    domain: str,
    in_stock: bool = False,
    limit: int | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The catalogue columns and ``post_date``, the column they are ordered by.

    All joins are on the product id, so the long texts are shuffled once. With a limit the newest
    products are chosen from narrow rows first, and the rest is read for those only; with a workspace
    the choice is written, so that it isn't made again for each use.
    """
    products = _with_texts(posts)
    if limit is None:
        chosen = exportable_products(products, postmeta, in_stock)
    else:
        dated = catalog_keys(posts, postmeta, in_stock)
        newest = dated.orderBy(F.desc("post_date"), "id", "image_path").limit(limit)
        if workspace is not None:
            newest = workspace.keep(newest, "newest")
        chosen = products.join(newest.select("id", "image_path"), "id")
        ids = newest.select("id").distinct()
        postmeta = postmeta.join(ids.withColumnRenamed("id", "post_id"), "post_id", "left_semi")
        named = named.join(ids.withColumnRenamed("id", "object_id"), "object_id", "left_semi")
    return _described(chosen, postmeta, named, domain, "post_date")


def product_catalog(
    posts: DataFrame,
    postmeta: DataFrame,
    named: DataFrame,
    domain: str,
    in_stock: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """The 11-column catalogue."""
    return catalog_rows(posts, postmeta, named, domain, in_stock, limit).select(*CATALOG_COLUMNS)


def newest_first() -> list:
    """Sort order of the export. Ties by product and image make it a total order."""
    return [F.desc("post_date"), F.col("product_id"), F.col("image_url")]


def latest_products(
    posts: DataFrame,
    postmeta: DataFrame,
    named: DataFrame,
    domain: str,
    n: int = PREVIEW_ROWS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The newest products of the catalogue."""
    rows = catalog_rows(posts, postmeta, named, domain, limit=n, workspace=workspace)
    return rows.orderBy(*newest_first()).select(*CATALOG_COLUMNS)


def _batch(size: int) -> Column:
    return F.call_function("div", F.col("position") - 1, F.lit(size)) + 1


def catalog_batches(rows: DataFrame, workspace, size: int = CATALOG_BATCH) -> DataFrame:
    """``rows`` with their 1-based ``batch`` of at most ``size`` products, newest first."""
    placed = numbered(rows, newest_first(), workspace)
    return placed.withColumn("batch", _batch(size)).drop("position")


def catalog_pages(
    posts: DataFrame,
    postmeta: DataFrame,
    named: DataFrame,
    domain: str,
    workspace: Workspace,
    size: int = CATALOG_BATCH,
    in_stock: bool = False,
) -> DataFrame:
    """The whole catalogue with ``post_date`` and the same batches.

    Positions are counted on narrow rows, which are sorted and written; they meet the texts by product id
    afterwards, so the texts are shuffled once and never sorted.
    """
    order = [F.desc("post_date"), F.col("id"), F.col("image_path")]
    placed = numbered(catalog_keys(posts, postmeta, in_stock), order, workspace)
    paged = placed.select("id", "image_path", _batch(size).alias("batch"))
    return _described(_with_texts(posts).join(paged, "id"), postmeta, named, domain, "post_date", "batch")
