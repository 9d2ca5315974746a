from datetime import datetime

from rows import DAY, post, postmeta, posts, table, values

from shopweave.functions import strip_status_substr
from shopweave.operators import customers, filters, merge, statuses

NOW = datetime(2025, 9, 14, 12)


def test_insert_ignore_keeps_what_is_there(spark):
    dst = table(spark, "usermeta", [(1, 10, "k", "old")])
    src = table(spark, "usermeta", [(1, 99, "k", "new"), (2, 20, "k", "b"), (2, 20, "k", "a")])
    merged = merge.insert_ignore(dst, src, "umeta_id")
    assert values(merged) == [(1, 10, "k", "old"), (2, 20, "k", "a")]
    rejected = merge.insert_ignore_rejects(dst, src, "umeta_id")
    assert values(rejected) == [(1, 99, "k", "new")]


def test_insert_ignore_is_idempotent(spark):
    dst = table(spark, "usermeta", [(1, 10, "k", "old")])
    src = table(spark, "usermeta", [(2, 20, "k", "b")])
    once = merge.insert_ignore(dst, src, "umeta_id")
    assert values(merge.insert_ignore(once, src, "umeta_id")) == values(once)


def test_upsert_options(spark):
    options = table(spark, "options", [(4, "a", "no", "no"), (9, "b", "x", "yes")])
    after = merge.upsert_options(options, {"a": ("yes", "yes"), "c": ("cot", "yes")})
    assert values(after) == [(11, "c", "cot", "yes"), (4, "a", "yes", "no"), (9, "b", "x", "yes")]


def test_purge_treats_underscore_as_wildcard(spark):
    names = ["_transient_a", "xtransient_a", "_site_transient_b", "my_transient_c", "plain"]
    options = table(spark, "options", [(i, n, "", "yes") for i, n in enumerate(names)])
    left = [r.option_name for r in filters.purge_transients(options).collect()]
    assert sorted(left) == ["my_transient_c", "plain"]
    left = [r.option_name for r in filters.purge_transients_any(options).collect()]
    assert left == ["plain"]


def test_customers(spark):
    users = table(spark, "users", [(i, "u", "e", "d") for i in (5, 6, 7)])
    p = posts(spark, post(1), post(2), post(3), post(4, kind="product"), post(8))
    m = postmeta(
        spark,
        (1, "_customer_user", "5"),
        (2, "_customer_user", "5"),
        (3, "_customer_user", "0"),
        (4, "_customer_user", "6"),
        (8, "_customer_user", "7x"),
    )
    found = customers.customers_with_orders(users, m, p)
    assert values(found) == [(5,), (7,)]
    dst = table(spark, "users", [(7, "u", "e", "d")])
    assert values(customers.missing_customers(found, dst)) == [(5,)]
    assert values(customers.existing_customers(found, dst)) == [(7,)]


def test_prefix_changes_in_keys_only(spark):
    meta = table(
        spark,
        "usermeta",
        [(1, 1, "a_capabilities", "a_capabilities"), (2, 1, "a_other", ""), (3, 1, "a_user_level", "")],
    )
    after = customers.rename_prefixed_meta_keys(meta, "a_", "b_")
    assert [r[2] for r in values(after)] == ["b_capabilities", "a_other", "b_user_level"]
    assert values(after)[0][3] == "a_capabilities"


def test_conversion_touches_orders_only(spark):
    p = posts(spark, post(1, status="wc-failed"), post(2, kind="product", status="wc-failed"))
    got = values(statuses.convert_statuses(p).select("id", "post_status"))
    assert got == [(1, "wc-cancelled"), (2, "wc-failed")]
    m = postmeta(spark, (1, "_order_status", "failed"), (1, "other", "failed"))
    got = values(statuses.convert_statuses_meta(m).select("meta_id", "meta_value"))
    assert got == [(1, "cancelled"), (2, "failed")]


def test_first_backup_wins(spark):
    first = statuses.backup_statuses(None, posts(spark, post(1, status="a")), DAY)
    both = posts(spark, post(1, status="b"), post(2, status="c"))
    assert values(statuses.backup_statuses(first, both, NOW)) == [(1, "a", DAY), (2, "c", NOW)]


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, status string")


def test_exact_sync(spark):
    dst = posts(spark, post(1, status="x"), post(2, status="y"), post(3, kind="product", status="z"))
    f = feed(spark, (1, "wc-new"), (1, "wc-new"), (3, "wc-new"), (4, "wc-new"))
    got = statuses.sync_statuses_exact(dst, f, NOW).select("id", "post_status", "post_modified_gmt")
    assert values(got) == [(1, "wc-new", NOW), (2, "y", DAY), (3, "z", DAY)]


def test_wide_sync(spark):
    wide = spark.createDataFrame(
        [(i, "old", DAY) for i in (1, 2, 3)], "id bigint, status string, date_updated_gmt timestamp_ntz"
    )
    f = feed(spark, (1, "wc-a"), (2, ""), (3, "trash"))
    got = statuses.sync_statuses_wide(wide, f, NOW)
    assert values(got) == [(1, "a", NOW), (2, "old", DAY), (3, "trash", NOW)]
    cut = statuses.sync_statuses_wide(wide, f, NOW, strip_status_substr, skip_blank=False)
    assert values(cut) == [(1, "a", NOW), (2, "", NOW), (3, "sh", NOW)]


def test_converted_sync(spark):
    dst = posts(spark, post(1, status="x"))
    got = statuses.sync_statuses_converted(dst, feed(spark, (1, "wc-delivered")), NOW)
    assert got.first().post_status == "wc-completed"
    got = statuses.sync_statuses_preserved(dst, feed(spark, (1, "wc-delivered")), NOW)
    assert got.first().post_status == "wc-delivered"


def test_status_counts_are_exact(spark):
    p = posts(spark, post(1, status="wc-completed"), post(2, status="wc-completed-late"))
    assert statuses.per_status_counts(p).first().completed == 1
    assert statuses.conversion_counts(p).first().total == 0
