from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import DAY, post, postmeta, posts, table, values

from shopweave.operators import catalog, filters
from shopweave.operators.ordering import numbered
from shopweave.plans.catalog import job_export_catalog
from shopweave.plans.store import Store
from shopweave.sources.files import read_catalog_csv, write_catalog_csv


def product(id, **other):
    return post(id, kind="product", status=other.pop("status", "publish"), **other)


@pytest.fixture
def no_terms(spark):
    return catalog.product_terms(
        table(spark, "term_relationships", []),
        table(spark, "term_taxonomy", []),
        table(spark, "terms", []),
    )


def test_stock_filter(spark):
    p = posts(spark, *(product(i) for i in range(1, 6)), post(6))
    m = postmeta(
        spark,
        (1, "_stock_status", "instock"),
        (2, "_stock_status", "outofstock"),
        (3, "_stock_status", "outofstock"),
        (3, "_stock_status", "instock"),
        (4, "_stock_status", "onbackorder"),
    )
    kept = filters.in_stock_products(p, m).select("id")
    assert values(kept) == [(1,), (3,), (4,), (5,)]


def test_a_row_per_image(spark, no_terms):
    p = posts(spark, product(1, title='say "hi"\n'), product(2), product(3), product(4, status="draft"))
    m = postmeta(
        spark,
        (1, "_thumbnail_id", "11"),
        (1, "_thumbnail_id", "12x"),
        (2, "_thumbnail_id", "13"),
        (3, "_thumbnail_id", "none"),
        (4, "_thumbnail_id", "11"),
        (11, "_wp_attached_file", "a.jpg"),
        (12, "_wp_attached_file", "b.jpg"),
        (13, "_wp_attached_file", ""),
        (1, "_regular_price", "9"),
    )
    rows = catalog.product_catalog(p, m, no_terms, "shop.example.com")
    got = [(r.product_id, r.post_title, r.image_url[-5:], r.price, r.category) for r in rows.collect()]
    assert sorted(got) == [
        (1, 'say "hi" ', "a.jpg", "9", "Uncategorized"),
        (1, 'say "hi" ', "b.jpg", "9", "Uncategorized"),
    ]
    images = catalog.product_images(p.select("id"), m)
    assert values(images) == [(1, "a.jpg"), (1, "b.jpg"), (2, ""), (3, None), (4, "a.jpg")]


def test_terms(spark):
    named = catalog.product_terms(
        table(spark, "term_relationships", [(1, 101), (1, 102), (1, 103), (1, 104), (2, 104), (3, 105)]),
        table(
            spark,
            "term_taxonomy",
            [
                (101, 1, "product_cat"),
                (102, 2, "product_cat"),
                (103, 3, "product_tag"),
                (104, 4, "product_tag"),
                (105, 5, "product_tag"),
            ],
        ),
        table(spark, "terms", [(1, "Tea"), (2, "Coffee"), (3, "buynow"), (4, "30days"), (5, "sale")]),
    )
    assert values(catalog.product_categories(named)) == [(1, "Coffee, Tea")]
    assert values(catalog.product_tags(named)) == [(1, "30days, buynow"), (2, "30days")]
    products = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    assert values(catalog.has_tag(products, named, "buynow")) == [(1, True), (2, False), (3, False)]


def test_csv_round_trip(spark, no_terms, tmp_path):
    title = ' quote " comma, back\\slash \\" end '
    p = posts(spark, product(1, title=title, excerpt="a\tb\nc"), product(2, date=DAY + timedelta(days=1)))
    m = postmeta(
        spark,
        (1, "_thumbnail_id", "11"),
        (2, "_thumbnail_id", "11"),
        (11, "_wp_attached_file", "a.jpg"),
    )
    rows = catalog.catalog_rows(p, m, no_terms, "shop.example.com")
    path = str(tmp_path / "catalog")
    write_catalog_csv(rows, path)
    back = {r.product_id: r for r in read_catalog_csv(spark, path).collect()}
    assert back[1].post_title == title and back[1].short_description == "a b c"
    assert back[1].sku == "" and back[2].tags == ""
    lines = spark.read.text(path).collect()
    assert lines[0].value.startswith("product_id,post_title") or lines[0].value.startswith('"product_id"')


def test_export_job_newest_ten(spark, tmp_path):
    p = posts(spark, *(product(i, date=DAY + timedelta(days=i % 7)) for i in range(1, 31)))
    m = postmeta(
        spark,
        *((i, "_thumbnail_id", "99") for i in range(1, 31)),
        (99, "_wp_attached_file", "a.jpg"),
    )
    store = Store(
        posts=p,
        postmeta=m,
        terms=table(spark, "terms", []),
        term_taxonomy=table(spark, "term_taxonomy", []),
        term_relationships=table(spark, "term_relationships", []),
    )
    written = job_export_catalog(spark, store, str(tmp_path / "out"), "shop.example.com", test=True)
    newest = sorted(range(1, 31), key=lambda i: (-(i % 7), i))[:10]
    assert sorted(r.product_id for r in written.collect()) == sorted(newest)


def test_numbered_equals_a_window(spark, workspace):
    """Ties in the first column, far more rows than partitions, and one date with a third of them."""
    rows = spark.range(30000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 911 END AS day", "repeat('x', 20) AS body"
    )
    order = [F.desc("day"), F.col("id")]
    got = numbered(rows, order, workspace).select("id", "position")
    want = rows.select("id", F.row_number().over(Window.orderBy(*order)).cast("long").alias("position"))
    assert got.exceptAll(want).count() == 0 and got.count() == 30000


def test_batches_are_full_but_the_last(spark, workspace):
    rows = spark.range(23).selectExpr(
        "id AS product_id", "'u' AS image_url", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS post_date"
    )
    sizes = catalog.catalog_batches(rows, workspace, 10).groupBy("batch").count()
    assert values(sizes) == [(1, 10), (2, 10), (3, 3)]


def test_shared_image_is_split(spark):
    """One placeholder image of most products: its join partition is split, and no row is lost."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        n = 200_000
        meta = spark.range(0, n, 1, 8).selectExpr(
            "id AS meta_id",
            "id AS post_id",
            "'_thumbnail_id' AS meta_key",
            f"CAST(CASE WHEN id % 3 > 0 THEN {n} ELSE {n} + id END AS STRING) AS meta_value",
        ).unionByName(
            spark.range(n, 2 * n, 1, 8).selectExpr(
                "id AS meta_id", "id AS post_id", "'_wp_attached_file' AS meta_key", "'f' AS meta_value"
            )
        )
        images = catalog.products_with_image(spark.range(n), meta)
        counted = images.groupBy("image_path").count()
        assert values(counted) == [("f", n)]
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_term_is_right(spark):
    relationships = spark.range(30000).selectExpr(
        "id AS object_id", "CASE WHEN id % 3 > 0 THEN 1L ELSE 2L END AS term_taxonomy_id"
    )
    taxonomy = table(spark, "term_taxonomy", [(1, 1, "product_cat"), (2, 2, "product_cat")])
    named = catalog.product_terms(relationships, taxonomy, table(spark, "terms", [(1, "a"), (2, "b")]))
    sizes = catalog.product_categories(named).groupBy("category").count()
    assert values(sizes) == [("a", 20000), ("b", 10000)]


def test_latest_is_a_top_k(spark, no_terms):
    p = posts(spark, product(1), product(2, date=datetime(2025, 1, 1)))
    m = postmeta(spark, (1, "_thumbnail_id", "11"), (2, "_thumbnail_id", "11"), (11, "_wp_attached_file", "a"))
    top = catalog.latest_products(p, m, no_terms, "shop.example.com", 1)
    assert [r.product_id for r in top.collect()] == [2]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
