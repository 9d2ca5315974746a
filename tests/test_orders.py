from decimal import Decimal

from rows import post, postmeta, posts, table, values

from shopweave.operators import eav, orders
from shopweave.operators.reports import integrity_check, order_validation


def test_order_without_metadata_keeps_defaults(spark):
    p = posts(spark, post(1, excerpt="note"), post(2, kind="product"))
    m = postmeta(spark, (2, "_order_total", "5"))
    row = orders.orders_wide(p, m).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.id, row.status, row.currency, row.customer_id) == (1, "completed", "INR", 0)
    assert row.total_amount == Decimal(0) and row.billing_email == "" and row.customer_note == "note"
    # the operational table has a row only for orders with metadata
    assert orders.order_operational(m, p).count() == 0


def test_operational_row_for_an_order_with_unrelated_metadata(spark):
    p, m = posts(spark, post(7)), postmeta(spark, (7, "colour", "red"))
    row = orders.order_operational(m, p).first()
    assert (row.created_via, row.woocommerce_version, row.order_key) == ("checkout", "9.3.3", "wc_order_7")
    assert values(eav.pivot_order_core(m, p)) == [(7, *[None] * 10)]


def test_largest_text_against_first_value(spark):
    p = posts(spark, post(1))
    m = postmeta(spark, (1, "_order_total", "10.00"), (1, "_order_total", "9.00"))
    assert orders.orders_wide(p, m).first().total_amount == Decimal("9")
    assert orders.orders_wide_light(p, m).first().total_amount == Decimal("10")


def test_first_null_value_counts_as_absent(spark):
    p = posts(spark, post(1))
    m = postmeta(spark, (1, "_billing_email", None), (1, "_billing_email", "a@example.com"))
    assert orders.orders_wide_light(p, m).first().billing_email == ""


def test_address_rows_need_a_matching_key(spark):
    p = posts(spark, post(1), post(2))
    m = postmeta(spark, (1, "_billing_extra", "x"), (2, "_shipping_city", "Pune"))
    rows = [(r.order_id, r.address_type, r.city, r.email) for r in orders.order_addresses(m, p).collect()]
    assert sorted(rows) == [(1, "billing", "", ""), (2, "shipping", "Pune", "")]


def test_integrity_counts_rows(spark):
    p = posts(spark, post(1), post(2), post(3), post(4, kind="product"))
    m = postmeta(
        spark,
        (1, "_customer_user", "5"),
        (1, "_customer_user", None),
        (2, "_customer_user", None),
        (2, "_customer_user", None),
        (9, "a", "b"),
        (9, "a", "c"),
    )
    row = integrity_check(p, m).first()
    # order 1 has one blank row, order 2 two, order 3 has no row at all
    assert (row.orphaned_meta, row.orders_without_customer, row.result) == (2, 4, "issues")
    assert orders.orders_without_customer(p, m).first().n == 4
    assert orders.orphaned_meta_count(m, p).first().n == orders.orphaned_meta(m, p).count() == 2


def test_order_validation_without_source_orders(spark):
    none = posts(spark, post(4, kind="product"))
    items = table(spark, "order_items", [])
    row = order_validation(none, posts(spark, post(1)), postmeta(spark, (1, "a", "b")), items).first()
    assert (row.percent, row.level, row.destination_order_meta) == (None, "no_source", 1)


def test_one_post_with_most_of_the_metadata(spark):
    """The pivot keeps one row per task for a hot post, whatever the number of its rows."""
    p = posts(spark, post(1), post(2))
    m = spark.range(60000).selectExpr(
        "id AS meta_id",
        "CASE WHEN id % 3 = 0 THEN 2L ELSE 1L END AS post_id",
        "'_order_currency' AS meta_key",
        "lpad(CAST(id AS STRING), 6, '0') AS meta_value",
    )
    rows = {r.id: r.currency for r in orders.orders_wide(p, m).collect()}
    assert rows == {1: "059999", 2: "059997"}
    plan = eav.core_values(m)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max" in plan
