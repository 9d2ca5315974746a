"""Operators against plain Python on random small tables, duplicates and gaps included."""

import random
import re
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from rows import post, posts, table

from shopweave import functions as fn
from shopweave.operators import catalog, customers, eav, filters, merge, orders


def bag(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture(params=range(3))
def world(request, spark):
    """Posts of three kinds and metadata with repeated keys, unknown posts and odd values."""
    rng = random.Random(request.param)
    kinds = {i: rng.choice(["shop_order", "product", "page"]) for i in range(1, 60)}
    values = ["0", "1", "5", "7x", "", "instock", "outofstock", "onbackorder", None, "10.00", "9.00", "40", "41"]
    keys = ["_customer_user", "_order_total", "_stock_status", "_thumbnail_id", "_wp_attached_file", "other"]
    meta = [(i, rng.randint(1, 70), rng.choice(keys), rng.choice(values)) for i in range(1, 900)]
    return (
        kinds,
        meta,
        posts(spark, *(post(i, kind=k, status="publish") for i, k in kinds.items())),
        table(spark, "postmeta", meta),
    )


def number(text):
    found = re.match("[ ]*([0-9]+)", text or "")
    return int(found.group(1)) if found else 0


def test_customers(world, spark):
    kinds, meta, p, m = world
    users = {1, 5, 6, 40}
    want = {
        number(v)
        for _, owner, key, v in meta
        if key == "_customer_user" and kinds.get(owner) == "shop_order"
    } & users
    frame = table(spark, "users", [(u, "", "", "") for u in users])
    assert bag(customers.customers_with_orders(frame, m, p)) == Counter((u,) for u in want)


def test_first_and_largest(world):
    kinds, meta, p, m = world
    first, largest = {}, {}
    for _, owner, key, v in sorted(meta):
        if key == "_order_total":
            first.setdefault(owner, v)
            if v is not None:
                largest[owner] = max(v, largest.get(owner, ""))
    ids = [i for i, kind in kinds.items() if kind == "shop_order"]
    got = eav.first_meta(filters.orders_only(p), m, "_order_total", "none")
    assert bag(got) == Counter((i, "none" if first.get(i) is None else first[i]) for i in ids)
    wide = {r.id: r.total_amount for r in orders.orders_wide(p, m).collect()}
    heads = {i: re.match("[ ]*([+-]?[0-9]*[.]?[0-9]+)", largest.get(i, "")) for i in ids}
    assert wide == {i: Decimal(h.group(1)) if h else Decimal(0) for i, h in heads.items()}


def test_stock_and_images(world):
    kinds, meta, p, m = world
    products = [i for i, kind in kinds.items() if kind == "product"]
    stock, files = defaultdict(set), defaultdict(list)
    for _, owner, key, v in meta:
        if key == "_stock_status":
            stock[owner].add(v)
        if key == "_wp_attached_file" and v:
            files[owner].append(v)
    passing = [i for i in products if "outofstock" not in stock[i] or "instock" in stock[i]]
    assert bag(filters.in_stock_products(p, m).select("id")) == Counter((i,) for i in passing)
    want = Counter(
        (owner, path)
        for _, owner, key, v in meta
        if key == "_thumbnail_id" and owner in products
        for path in files[number(v)]
    )
    chosen = filters.published_products(p).select("id")
    assert bag(catalog.products_with_image(chosen, m)) == want


def test_orphans_and_unowned_orders(world):
    kinds, meta, p, m = world
    orphans = Counter(row for row in meta if row[1] not in kinds)
    assert bag(orders.orphaned_meta(m, p)) == orphans
    rows = defaultdict(list)
    for _, owner, key, v in meta:
        if key == "_customer_user":
            rows[owner].append(v)
    blanks = sum(
        sum(v is None for v in rows[i]) if rows[i] else 1
        for i, kind in kinds.items()
        if kind == "shop_order"
    )
    assert tuple(orders.integrity_counts(p, m).first()) == (sum(orphans.values()), blanks)


def test_insert_ignore(world, spark):
    _, meta, _, _ = world
    rng = random.Random(len(meta))
    old = [row for row in meta if rng.random() < 0.4]
    new = [(row[0], row[1], row[2], "new") for row in meta if rng.random() < 0.6] * 2
    known = {row[0] for row in old}
    want = Counter(old) + Counter({row for row in new if row[0] not in known})
    got = merge.insert_ignore(table(spark, "postmeta", old), table(spark, "postmeta", new), "meta_id")
    assert bag(got) == want


def test_hot_order_in_an_export(spark):
    """A third of all items belong to one order: the semi join is split and stays exact."""
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
        n = 300_000
        items = spark.range(0, n, 1, 8).selectExpr(
            "id AS order_item_id",
            "CASE WHEN id % 3 = 0 THEN 1L ELSE id END AS order_id",
            "'line_item' AS order_item_type",
            "id AS part",
            "sha1(CAST(id AS STRING)) AS qty",
        )
        order_rows = spark.range(n).selectExpr("id", "'shop_order' AS post_type")
        counts = (
            orders.export_order_items(items, order_rows)
            .groupBy("order_item_type")
            .agg(F.count("*"), F.sum("part"), F.max("qty") > "")
        )
        assert bag(counts) == Counter({("line_item", n, n * (n - 1) // 2, True): 1})
        assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_number_heads(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("019 .+-ex") for _ in range(rng.randint(0, 7))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", fn.to_unsigned(F.col("t")).alias("u"), fn.to_decimal(F.col("t")).alias("d")
    )
    for row in frame.collect():
        head = re.match("[ ]*([+-]?[0-9]*[.]?[0-9]+(?:e[+-]?[0-9]+)?)", row.t)
        value = Decimal(head.group(1)) if head else Decimal(0)
        value = value.quantize(Decimal("1e-8"), ROUND_HALF_UP) if abs(value) < 10**18 else Decimal(0)
        assert row.u == number(row.t)
        assert row.d == value
