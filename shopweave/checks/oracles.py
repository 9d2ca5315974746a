"""The SQL every registered query must agree with, written apart from the operators.

Only the derived input tables are shared. Statements follow the plain relational meaning (IN,
EXISTS, scalar subqueries, windows) and not the way the Spark operators are arranged.
"""

from __future__ import annotations

from ..sources.schema import SCHEMAS
from .digests import digest_sql
from .store_sql import with_tables

ORDERS = "(SELECT * FROM src_posts WHERE post_type = 'shop_order') AS o"
DST_ORDERS = "(SELECT * FROM dst_posts WHERE post_type = 'shop_order') AS o"
ORDER_IDS = "(SELECT id FROM src_posts WHERE post_type = 'shop_order')"
DST_ORDER_IDS = "(SELECT id FROM dst_posts WHERE post_type = 'shop_order')"
NOW = "TIMESTAMP '2025-09-14 12:00:00'"
URL = "'https://shop.example.com/wp-content/uploads/'"


def unsigned(x: str) -> str:
    return f"coalesce(try_cast(regexp_extract({x}, '^[ ]*([0-9]+)', 1) AS BIGINT), 0)"


def decimal(x: str) -> str:
    head = f"regexp_extract({x}, '^[ ]*([+-]?[0-9]*[.]?[0-9]+([eE][+-]?[0-9]+)?)', 1)"
    return f"CAST(coalesce(try_cast({head} AS DECIMAL(26,8)), 0) AS DOUBLE)"


def unix(x: str) -> str:
    digits = f"try_cast(regexp_extract({x}, '^[ ]*([0-9]+)', 1) AS BIGINT)"
    return f"CASE WHEN {digits} <= 32536771199 THEN make_timestamp({digits} * 1000000) END"


def largest(key: str, name: str) -> str:
    return f"max(meta_value) FILTER (WHERE meta_key = '{key}') AS {name}"


def clean(x: str) -> str:
    return f"replace(replace(replace({x}, chr(10), ' '), chr(13), ' '), chr(9), ' ')"


def flag(x: str, word: str = "yes") -> str:
    return f"CASE WHEN {x} = '{word}' THEN 1 ELSE 0 END"


def converted(x: str) -> str:
    return (
        f"CASE {x} WHEN 'wc-delivered' THEN 'wc-completed' WHEN 'wc-pre-order-booked' THEN 'wc-on-hold' "
        f"WHEN 'wc-failed' THEN 'wc-cancelled' ELSE {x} END"
    )


def converted_bare(x: str) -> str:
    return (
        f"CASE {x} WHEN 'delivered' THEN 'completed' WHEN 'pre-order-booked' THEN 'on-hold' "
        f"WHEN 'failed' THEN 'cancelled' ELSE {x} END"
    )


def first_value(table: str, post: str, key: str) -> str:
    return (
        f"(SELECT arg_min(meta_value, meta_id) FROM {table} AS f "
        f"WHERE f.post_id = {post} AND f.meta_key = '{key}')"
    )


# --- shared statements -----------------------------------------------------------------

CORE = [
    ("_order_currency", "currency"),
    ("_order_tax", "tax"),
    ("_order_total", "total"),
    ("_customer_user", "customer_id"),
    ("_billing_email", "billing_email"),
    ("_payment_method", "payment_method"),
    ("_payment_method_title", "payment_method_title"),
    ("_transaction_id", "transaction_id"),
    ("_customer_ip_address", "ip_address"),
    ("_customer_user_agent", "user_agent"),
]
OPERATIONAL = [
    ("_created_via", "created_via"),
    ("_order_version", "version"),
    ("_prices_include_tax", "prices_include_tax"),
    ("_recorded_coupon_usage_counts", "coupons_counted"),
    ("_download_permissions_granted", "downloads_granted"),
    ("_cart_hash", "cart_hash"),
    ("_new_order_email_sent", "email_sent"),
    ("_order_key", "order_key"),
    ("_order_stock_reduced", "stock_reduced"),
    ("_date_paid", "date_paid"),
    ("_date_completed", "date_completed"),
    ("_order_shipping_tax", "shipping_tax"),
    ("_order_shipping", "shipping_total"),
    ("_cart_discount_tax", "discount_tax"),
    ("_cart_discount", "discount_total"),
    ("_recorded_sales", "recorded_sales"),
]
PLACE = ["first_name", "last_name", "company", "address_1", "address_2", "city", "state", "postcode", "country"]
BILLING = [(f"_billing_{c}", c) for c in [*PLACE, "email", "phone"]]
SHIPPING = [(f"_shipping_{c}", c) for c in [*PLACE, "phone"]]


def pivot(keys, side: str = "src", like: str | None = None) -> str:
    pattern = f" AND meta_key LIKE '{like}'" if like else ""
    return (
        f"SELECT post_id, {', '.join(largest(k, c) for k, c in keys)} FROM {side}_postmeta "
        f"WHERE post_id IN (SELECT id FROM {side}_posts WHERE post_type = 'shop_order'){pattern} "
        "GROUP BY post_id"
    )


def addresses(side: str) -> str:
    fields = ", ".join(f"coalesce({c}, '') AS {c}" for c in PLACE)
    return (
        f"SELECT post_id AS order_id, 'billing' AS address_type, {fields}, "
        f"coalesce(email, '') AS email, coalesce(phone, '') AS phone "
        f"FROM ({pivot(BILLING, side, '_billing_%')}) AS b UNION ALL "
        f"SELECT post_id, 'shipping', {fields}, '', coalesce(phone, '') "
        f"FROM ({pivot(SHIPPING, side, '_shipping_%')}) AS s"
    )


def wide(side: str) -> str:
    """Each order beside the largest values of its own metadata."""
    texts = "billing_email payment_method payment_method_title transaction_id ip_address user_agent".split()
    columns = {name: f"coalesce(m.{name}, '')" for name in texts} | {
        "id": "p.id",
        "status": "replace(p.post_status, 'wc-', '')",
        "currency": "coalesce(m.currency, 'INR')",
        "type": "p.post_type",
        "tax_amount": decimal("m.tax"),
        "total_amount": decimal("m.total"),
        "customer_id": unsigned("m.customer_id"),
        "date_created_gmt": "p.post_date_gmt",
        "date_updated_gmt": "p.post_modified_gmt",
        "parent_order_id": "p.post_parent",
        "customer_note": "p.post_excerpt",
    }
    own = ", ".join(largest(key, name) for key, name in CORE)
    return (
        f"SELECT {', '.join(f'{sql} AS {name}' for name, sql in columns.items())} "
        f"FROM (SELECT * FROM {side}_posts WHERE post_type = 'shop_order') AS p, "
        f"LATERAL (SELECT {own} FROM {side}_postmeta AS o WHERE o.post_id = p.id) AS m"
    )


def light(posts: str, postmeta: str) -> str:
    total = first_value(postmeta, "p.id", "_order_total")
    email = first_value(postmeta, "p.id", "_billing_email")
    return (
        "SELECT p.id, replace(p.post_status, 'wc-', '') AS status, 'INR' AS currency, "
        "'shop_order' AS type, p.post_author AS customer_id, p.post_date_gmt AS date_created_gmt, "
        f"p.post_modified_gmt AS date_updated_gmt, {decimal(total)} AS total_amount, "
        f"coalesce({email}, '') AS billing_email FROM {posts} AS p WHERE p.post_type = 'shop_order'"
    )


OPERATIONAL_SQL = (
    "SELECT post_id AS order_id, coalesce(created_via, 'checkout') AS created_via, "
    "coalesce(version, '9.3.3') AS woocommerce_version, "
    f"{flag('prices_include_tax')} AS prices_include_tax, "
    f"{flag('coupons_counted')} AS coupon_usages_are_counted, "
    f"{flag('downloads_granted')} AS download_permission_granted, "
    "coalesce(cart_hash, '') AS cart_hash, "
    f"{flag('email_sent', 'true')} AS new_order_email_sent, "
    "coalesce(order_key, concat('wc_order_', post_id)) AS order_key, "
    f"{flag('stock_reduced')} AS order_stock_reduced, "
    f"{unix('date_paid')} AS date_paid_gmt, {unix('date_completed')} AS date_completed_gmt, "
    f"{decimal('shipping_tax')} AS shipping_tax_amount, "
    f"{decimal('shipping_total')} AS shipping_total_amount, "
    f"{decimal('discount_tax')} AS discount_tax_amount, "
    f"{decimal('discount_total')} AS discount_total_amount, "
    f"{flag('recorded_sales')} AS recorded_sales FROM ({pivot(OPERATIONAL)}) AS p"
)

CUSTOMERS = (
    f"SELECT id FROM src_users WHERE id IN (SELECT {unsigned('meta_value')} FROM src_postmeta "
    f"WHERE meta_key = '_customer_user' AND post_id IN {ORDER_IDS})"
)
MISSING = {
    "customers": CUSTOMERS,
    "missing": "SELECT id FROM customers WHERE id NOT IN (SELECT id FROM dst_users)",
}
MISSING_META = {
    **MISSING,
    "incoming": (
        "SELECT umeta_id, user_id, CASE meta_key WHEN 'src_capabilities' THEN 'dst_capabilities' "
        "WHEN 'src_user_level' THEN 'dst_user_level' ELSE meta_key END AS meta_key, meta_value "
        "FROM src_usermeta WHERE user_id IN (SELECT id FROM missing)"
    ),
}
USERS_AFTER = {
    **MISSING,
    "users_after": (
        "SELECT id FROM dst_users UNION ALL SELECT id FROM src_users WHERE id IN (SELECT id FROM missing)"
    ),
}
IMPORT_STATS = (
    "SELECT (SELECT count(*) FROM missing) AS missing_customers, "
    "(SELECT count(*) FROM missing WHERE id IN (SELECT id FROM users_after)) AS imported_customers, "
    "(SELECT count(*) FROM users_after) AS total_users, "
    "(SELECT count(DISTINCT meta_value) FROM dst_postmeta WHERE meta_key = '_customer_user' "
    "AND meta_value <> '0') AS customers_with_orders"
)

NAMED = {
    "named": (
        "SELECT r.object_id, x.taxonomy, t.name FROM term_relationships AS r "
        "JOIN term_taxonomy AS x ON r.term_taxonomy_id = x.term_taxonomy_id "
        "JOIN terms AS t ON x.term_id = t.term_id"
    ),
}
CATEGORIES = (
    "SELECT object_id, string_agg(name, ', ' ORDER BY name) AS category FROM named "
    "WHERE taxonomy = 'product_cat' GROUP BY object_id"
)
TAGS = (
    "SELECT object_id, string_agg(name, ', ' ORDER BY name) AS tags FROM named "
    "WHERE taxonomy = 'product_tag' AND name IN ('buynow', '30days') GROUP BY object_id"
)
# Every published product with each path that one of its thumbnail ids leads to.
IMAGES = (
    "FROM (SELECT * FROM src_posts WHERE post_type = 'product' AND post_status = 'publish') AS p "
    "LEFT JOIN (SELECT t.post_id AS owner, f.meta_value AS path FROM "
    f"(SELECT post_id, {unsigned('meta_value')} AS image FROM src_postmeta WHERE meta_key = '_thumbnail_id') AS t "
    "LEFT JOIN (SELECT post_id, meta_value FROM src_postmeta WHERE meta_key = '_wp_attached_file') AS f "
    "ON f.post_id = t.image) AS im ON im.owner = p.id"
)
WITH_IMAGE = f"{IMAGES} WHERE im.path <> ''"
STOCK = (
    "p.id NOT IN (SELECT post_id FROM src_postmeta WHERE meta_key = '_stock_status' GROUP BY post_id "
    "HAVING bool_or(meta_value = 'outofstock') AND NOT bool_or(meta_value = 'instock'))"
)


def tagged(tag: str) -> str:
    return f"p.id IN (SELECT object_id FROM named WHERE taxonomy = 'product_tag' AND name = '{tag}')"


KIND = f"CASE WHEN {tagged('buynow')} AND NOT {tagged('30days')} THEN 'buynow' ELSE '30days' END"
PRICE = (
    f"coalesce({first_value('src_postmeta', 'p.id', '_price')}, "
    f"{first_value('src_postmeta', 'p.id', '_regular_price')}, '0')"
)


def catalog(extra: str = "", more: str = "") -> str:
    return (
        f"SELECT p.id AS product_id, {clean('p.post_title')} AS post_title, p.post_name AS slug, "
        f"{clean('p.post_excerpt')} AS short_description, {clean('p.post_content')} AS description, "
        f"{URL} || im.path AS image_url, {PRICE} AS price, "
        f"coalesce({first_value('src_postmeta', 'p.id', '_sku')}, '') AS sku, "
        f"coalesce((SELECT c.category FROM ({CATEGORIES}) AS c WHERE c.object_id = p.id), "
        f"'Uncategorized') AS category, {KIND} AS product_type, "
        f"coalesce((SELECT g.tags FROM ({TAGS}) AS g WHERE g.object_id = p.id), '') AS tags{more} "
        f"{WITH_IMAGE}{extra}"
    )


def transient(names: list[str]) -> str:
    return " OR ".join(f"option_name LIKE '{n}'" for n in names)


PURGED = (
    "SELECT * FROM dst_options WHERE NOT coalesce("
    + transient(["_transient_%", "_transient_timeout_%", "_site_transient_%", "_site_transient_timeout_%"])
    + ", false)"
)

DISTRIBUTION = f"SELECT post_status, count(*) AS n FROM {ORDERS} GROUP BY post_status"
PCT = (
    "SELECT post_status, count(*) AS n, CAST(round(CAST(count(*) * 100 AS DOUBLE) / "
    "(SELECT count(*) FROM {orders}), 2) AS DOUBLE) AS percentage FROM {orders} GROUP BY post_status"
)


def synced(status: str) -> str:
    return (
        "SELECT d.* REPLACE (CASE WHEN s.id IS NOT NULL AND d.post_type = 'shop_order' "
        f"THEN {status} ELSE d.post_status END AS post_status, "
        + ", ".join(
            "CASE WHEN s.id IS NOT NULL AND d.post_type = 'shop_order' "
            f"THEN {NOW} ELSE d.{c} END AS {c}"
            for c in ("post_modified", "post_modified_gmt")
        )
        + ") "
        "FROM dst_posts AS d LEFT JOIN src_posts AS s ON s.id = d.id AND s.post_type = 'shop_order'"
    )


# Destination after orders were replaced and the source's orders copied in.
MIGRATED = {
    "posts_left": "SELECT * FROM dst_posts WHERE post_type <> 'shop_order'",
    "meta_left": f"SELECT * FROM dst_postmeta WHERE post_id NOT IN {DST_ORDER_IDS}",
    "posts_after": (
        "SELECT * FROM posts_left UNION ALL SELECT * FROM src_posts "
        "WHERE post_type = 'shop_order' AND id NOT IN (SELECT id FROM posts_left)"
    ),
    "meta_after": (
        f"SELECT * FROM meta_left UNION ALL SELECT * FROM src_postmeta WHERE post_id IN {ORDER_IDS} "
        "AND meta_id NOT IN (SELECT meta_id FROM meta_left)"
    ),
    "converted_posts": (
        f"SELECT * REPLACE (CASE WHEN post_type = 'shop_order' THEN {converted('post_status')} "
        "ELSE post_status END AS post_status) FROM posts_after"
    ),
}
ITEMS = f"SELECT * FROM src_order_items WHERE order_id IN {ORDER_IDS}"
ITEMMETA = (
    "SELECT * FROM src_order_itemmeta WHERE order_item_id IN "
    f"(SELECT order_item_id FROM src_order_items WHERE order_id IN {ORDER_IDS})"
)


def counts(parts: dict[str, str], label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) AS n FROM {table}" for name, table in parts.items()
    )


USER_CHECK = (
    "SELECT *, CASE WHEN destination_users >= 2 THEN 'success' ELSE 'low' END AS result FROM (SELECT "
    "(SELECT count(*) FROM src_users) AS source_users, (SELECT count(*) FROM dst_users) AS destination_users, "
    "(SELECT count(*) FROM dst_usermeta) AS destination_usermeta) AS c"
)
ORDER_CHECK = (
    "SELECT *, CASE WHEN percent IS NULL THEN 'no_source' WHEN percent >= 95 THEN 'success' "
    "WHEN percent >= 80 THEN 'partial' ELSE 'low' END AS level FROM (SELECT *, CASE WHEN source_orders > 0 "
    "THEN destination_orders * 100 // source_orders END AS percent FROM (SELECT "
    f"(SELECT count(*) FROM {ORDERS}) AS source_orders, "
    f"(SELECT count(*) FROM {DST_ORDERS}) AS destination_orders, "
    "(SELECT count(*) FROM dst_postmeta AS m JOIN dst_posts AS p ON m.post_id = p.id "
    "WHERE p.post_type = 'shop_order') AS destination_order_meta, "
    "(SELECT count(*) FROM dst_order_items) AS destination_order_items) AS c) AS d"
)
META_CHECK = (
    "SELECT *, CASE WHEN totals > 0 AND emails > 0 THEN 'functional' ELSE 'needs_attention' END AS result "
    "FROM (SELECT (SELECT count(*) FROM {meta} WHERE meta_key = '_order_total') AS totals, "
    "(SELECT count(*) FROM {meta} WHERE meta_key = '_billing_email') AS emails, "
    "(SELECT count(*) FROM {meta} WHERE meta_key = '_order_status') AS statuses) AS c"
)


def without_customer(side: str) -> str:
    """An order without a customer row counts once, and every such row without a value counts."""
    customer = f"SELECT post_id FROM {side}_postmeta WHERE meta_key = '_customer_user'"
    orders = f"SELECT id FROM {side}_posts WHERE post_type = 'shop_order'"
    return (
        f"SELECT (SELECT count(*) FROM ({orders}) AS a WHERE NOT EXISTS (FROM ({customer}) AS b WHERE b.post_id = a.id))"
        f" + (SELECT count(*) FROM ({customer} AND meta_value IS NULL) AS d WHERE d.post_id IN ({orders}))"
    )


def integrity(side: str) -> str:
    return (
        "SELECT *, CASE WHEN orphaned_meta = 0 AND orders_without_customer < 100 THEN 'good' "
        "ELSE 'issues' END AS result FROM (SELECT "
        f"(SELECT count(*) FROM {side}_postmeta WHERE post_id NOT IN (SELECT id FROM {side}_posts)) "
        "AS orphaned_meta, "
        f"({without_customer(side)}) AS orders_without_customer) AS c"
    )


def long(check: str, name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS report, '{c}' AS metric, CAST({c} AS STRING) AS value FROM ({check}) AS r"
        for c in columns
    )


VALIDATION = " UNION ALL ".join(
    [
        long(USER_CHECK, "users", ["source_users", "destination_users", "destination_usermeta", "result"]),
        long(
            ORDER_CHECK,
            "orders",
            [
                "source_orders",
                "destination_orders",
                "destination_order_meta",
                "destination_order_items",
                "percent",
                "level",
            ],
        ),
        f"SELECT 'statuses', post_status || ' orders', CAST(n AS STRING) FROM ({PCT.format(orders=DST_ORDERS)}) AS a",
        "SELECT 'statuses', post_status || ' percent', CAST(CAST(percentage AS DECIMAL(10,2)) AS STRING) "
        f"FROM ({PCT.format(orders=DST_ORDERS)}) AS b",
        long(
            META_CHECK.format(meta="dst_postmeta"), "metadata", ["totals", "emails", "statuses", "result"]
        ),
        long(integrity("dst"), "integrity", ["orphaned_meta", "orders_without_customer", "result"]),
    ]
)

NEW_SETTINGS = [
    ("woocommerce_custom_orders_table_enabled", "yes"),
    ("woocommerce_custom_orders_table_data_sync_enabled", "yes"),
    ("woocommerce_feature_custom_order_tables_enabled", "yes"),
    ("woocommerce_cot_authoritative_source", "cot"),
]
CHANGES = {
    "changes": " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS place, '{name}' AS option_name, '{value}' AS option_value"
        for i, (name, value) in enumerate(NEW_SETTINGS, start=1)
    )
}

# --- statements per query: SQL, or (SQL, steps) ----------------------------------------

STATEMENTS: dict[str, str | tuple[str, dict[str, str]]] = {
    # sources and sinks
    "scan_table": "SELECT * FROM dst_users",
    "export_orders": "SELECT * FROM src_posts WHERE post_type = 'shop_order'",
    "export_users": ("SELECT * FROM src_users WHERE id IN (SELECT id FROM missing)", MISSING),
    "export_usermeta": ("SELECT * FROM src_usermeta WHERE user_id IN (SELECT id FROM missing)", MISSING),
    "write_catalog_csv": (catalog(), NAMED),
    "write_status_tsv": f"SELECT CAST(id AS STRING) AS id, post_status AS status FROM {ORDERS}",
    "read_status_tsv": f"SELECT id, post_status AS status FROM {DST_ORDERS}",
    "snapshot_tables": counts(
        {
            "users": "dst_users",
            "usermeta": "dst_usermeta",
            "posts": "dst_posts",
            "postmeta": "dst_postmeta",
            "order_items": "dst_order_items",
            "order_itemmeta": "dst_order_itemmeta",
            "options": "dst_options",
            "terms": "terms",
            "term_taxonomy": "term_taxonomy",
            "term_relationships": "term_relationships",
        },
        "table_name",
    ),
    "restore_snapshot": "SELECT * FROM dst_usermeta",
    "overwrite_wide": light("src_posts", "src_postmeta"),
    # filters
    "orders_only": "SELECT * FROM src_posts WHERE post_type = 'shop_order'",
    "published_products": "SELECT * FROM src_posts WHERE post_type = 'product' AND post_status = 'publish'",
    "custom_status_orders": (
        f"SELECT * FROM {ORDERS} WHERE post_status IN ('wc-delivered', 'wc-pre-order-booked', 'wc-failed')"
    ),
    "nonstandard_status_orders": (
        f"SELECT * FROM {ORDERS} WHERE post_status NOT IN ('wc-completed', 'wc-processing', 'wc-on-hold', "
        "'wc-cancelled', 'wc-refunded', 'wc-failed', 'wc-pending', 'wc-pending-payment')"
    ),
    "standard_status_orders": (
        f"SELECT * FROM {ORDERS} WHERE post_status IN ('wc-pending', 'wc-processing', 'wc-on-hold', "
        "'wc-completed', 'wc-cancelled', 'wc-refunded', 'wc-failed')"
    ),
    "meta_by_prefix": (
        "SELECT * FROM src_postmeta WHERE meta_key LIKE '_billing_%' "
        "UNION ALL SELECT * FROM src_postmeta WHERE meta_key LIKE '_shipping_%'"
    ),
    "non_guest_meta": "SELECT * FROM src_postmeta WHERE meta_key = '_customer_user' AND meta_value <> '0'",
    "in_stock_products": f"SELECT * FROM src_posts AS p WHERE post_type = 'product' AND {STOCK}",
    "products_with_image": f"SELECT p.id, im.path AS image_path {WITH_IMAGE}",
    "purge_transients": PURGED,
    "purge_transients_any": "SELECT * FROM dst_options WHERE option_name IS NULL OR option_name NOT LIKE '%_transient_%'",
    "distinct_statuses": f"SELECT DISTINCT post_status FROM {ORDERS}",
    # joins
    "customers_with_orders": CUSTOMERS,
    "missing_customers": ("SELECT id FROM missing", MISSING),
    "existing_customers": (
        "SELECT id FROM customers WHERE id IN (SELECT id FROM dst_users)",
        {"customers": CUSTOMERS},
    ),
    "export_order_meta": f"SELECT * FROM src_postmeta WHERE post_id IN {ORDER_IDS}",
    "export_order_items": ITEMS,
    "export_order_itemmeta": ITEMMETA,
    "orders_left_pivot": (
        f"SELECT o.id, o.post_status, {', '.join(c for _, c in CORE)} FROM {ORDERS} "
        f"LEFT JOIN ({pivot(CORE)}) AS m ON o.id = m.post_id"
    ),
    "product_images": f"SELECT p.id, im.path AS image_path {IMAGES}",
    "product_terms": ("SELECT * FROM named", NAMED),
    "orphaned_meta": (
        "SELECT * FROM src_postmeta WHERE post_id NOT IN (SELECT id FROM src_posts)"
    ),
    "orders_without_customer": f"SELECT ({without_customer('src')}) AS n",
    "first_meta": (
        f"SELECT o.id, coalesce({first_value('src_postmeta', 'o.id', '_order_total')}, '0') AS value "
        f"FROM {ORDERS}"
    ),
    "has_tag": (
        f"SELECT p.id, CASE WHEN {tagged('buynow')} THEN 1 ELSE 0 END AS has_tag FROM src_posts AS p "
        "WHERE p.post_type = 'product' AND p.post_status = 'publish'",
        NAMED,
    ),
    "order_meta_joined_count": (
        "SELECT count(*) AS n FROM src_postmeta AS m JOIN src_posts AS p ON m.post_id = p.id "
        "WHERE p.post_type = 'shop_order'"
    ),
    # aggregates
    "table_counts": counts(
        {
            "orders": ORDERS,
            "order_meta": f"(SELECT 1 AS x FROM src_postmeta WHERE post_id IN {ORDER_IDS}) AS m",
            "order_items": "src_order_items",
            "order_itemmeta": "src_order_itemmeta",
        },
        "table_name",
    ),
    "distinct_customer_count": (
        "SELECT count(DISTINCT meta_value) AS n FROM src_postmeta "
        "WHERE meta_key = '_customer_user' AND meta_value <> '0'"
    ),
    "status_distribution": DISTRIBUTION,
    "status_distribution_pct": PCT.format(orders=ORDERS),
    "per_status_counts": "SELECT "
    + ", ".join(
        f"(SELECT count(*) FROM {ORDERS} WHERE post_status = '{status}') AS {name}"
        for status, name in [
            ("wc-delivered", "delivered"),
            ("wc-failed", "failed"),
            ("wc-pre-order-booked", "pre_order_booked"),
            ("wc-completed", "completed"),
            ("wc-cancelled", "cancelled"),
            ("wc-refunded", "refunded"),
        ]
    ),
    "pivot_order_core": pivot(CORE),
    "pivot_billing": pivot(BILLING, like="_billing_%"),
    "pivot_shipping": pivot(SHIPPING, like="_shipping_%"),
    "pivot_operational": pivot(OPERATIONAL),
    "product_categories": (CATEGORIES, NAMED),
    "product_tags": (TAGS, NAMED),
    "critical_meta_counts": (
        f"SELECT totals, emails, statuses FROM ({META_CHECK.format(meta='src_postmeta')}) AS c"
    ),
    "catalog_count": (
        f"SELECT (SELECT count(*) {WITH_IMAGE}) AS every_product, "
        f"(SELECT count(*) {WITH_IMAGE} AND {STOCK}) AS in_stock"
    ),
    # sorts, limits, pages
    "status_distribution_sorted": f"{DISTRIBUTION} ORDER BY n DESC, post_status",
    "latest_products": (catalog(" ORDER BY p.post_date DESC, p.id, im.path LIMIT 10"), NAMED),
    "catalog_batches": (
        f"SELECT *, (row_number() OVER (ORDER BY post_date DESC, product_id, image_url) - 1) // 100 + 1 AS batch "
        f"FROM ({catalog(more=', p.post_date')}) AS c",
        NAMED,
    ),
    "orders_by_id": f"SELECT id, post_status AS status FROM {ORDERS} ORDER BY id",
    "missing_preview": ("SELECT id FROM missing ORDER BY id LIMIT 10", MISSING),
    # set operations and mutations
    "insert_ignore": (
        "SELECT * FROM dst_usermeta UNION ALL SELECT * FROM incoming "
        "WHERE umeta_id NOT IN (SELECT umeta_id FROM dst_usermeta)",
        MISSING_META,
    ),
    "insert_ignore_rejects": (
        "SELECT * FROM incoming WHERE umeta_id IN (SELECT umeta_id FROM dst_usermeta)",
        MISSING_META,
    ),
    "rename_prefixed_meta_keys": (
        "SELECT umeta_id, user_id, CASE meta_key WHEN 'src_capabilities' THEN 'dst_capabilities' "
        "WHEN 'src_user_level' THEN 'dst_user_level' ELSE meta_key END AS meta_key, meta_value "
        "FROM src_usermeta"
    ),
    "delete_orders_cascade": (
        "SELECT 'posts' AS table_name, id AS row_id FROM dst_posts WHERE post_type <> 'shop_order' "
        f"UNION ALL SELECT 'postmeta', meta_id FROM dst_postmeta WHERE post_id NOT IN {DST_ORDER_IDS}"
    ),
    "convert_statuses": (
        f"SELECT * REPLACE (CASE WHEN post_type = 'shop_order' THEN {converted('post_status')} "
        "ELSE post_status END AS post_status) FROM src_posts"
    ),
    "convert_statuses_wide": (
        f"SELECT * REPLACE ({converted_bare('status')} AS status) FROM wc_orders",
        {"wc_orders": wide("dst")},
    ),
    "convert_statuses_meta": (
        "SELECT meta_id, post_id, meta_key, CASE WHEN meta_key = '_order_status' "
        f"THEN {converted_bare('meta_value')} ELSE meta_value END AS meta_value FROM dst_postmeta"
    ),
    "conversion_counts": "SELECT "
    + ", ".join(
        f"(SELECT count(*) FROM {ORDERS} WHERE post_status IN ({statuses})) AS {name}"
        for statuses, name in [
            ("'wc-delivered'", "delivered"),
            ("'wc-failed'", "failed"),
            ("'wc-pre-order-booked'", "pre_order_booked"),
            ("'wc-delivered', 'wc-failed', 'wc-pre-order-booked'", "total"),
        ]
    ),
    "backup_statuses": (
        "SELECT s.id AS order_id, coalesce(d.post_status, s.post_status) AS original_status, "
        f"CASE WHEN d.id IS NULL THEN {NOW} ELSE TIMESTAMP '2025-09-01 00:00:00' END AS backup_date "
        f"FROM {ORDERS.replace('AS o', 'AS s')} LEFT JOIN {DST_ORDERS.replace('AS o', 'AS d')} ON d.id = s.id"
    ),
    "sync_statuses_exact": synced("s.post_status"),
    "sync_statuses_wide": (
        "SELECT w.* REPLACE (CASE WHEN s.id IS NULL THEN w.status ELSE regexp_replace(s.post_status, "
        f"'^wc-', '') END AS status, CASE WHEN s.id IS NULL THEN w.date_updated_gmt ELSE {NOW} END "
        f"AS date_updated_gmt) FROM wc_orders AS w LEFT JOIN {ORDERS.replace('AS o', 'AS s')} ON s.id = w.id",
        {"wc_orders": wide("dst")},
    ),
    "sync_statuses_converted": synced(converted("s.post_status")),
    "sync_statuses_preserved": synced("s.post_status"),
    "upsert_options": (
        "SELECT o.option_id, o.option_name, coalesce(c.option_value, o.option_value) AS option_value, "
        "o.autoload FROM dst_options AS o LEFT JOIN changes AS c ON c.option_name = o.option_name "
        "UNION ALL SELECT (SELECT max(option_id) FROM dst_options) + place, option_name, option_value, 'yes' "
        "FROM changes AS c WHERE NOT EXISTS (FROM dst_options AS o WHERE o.option_name = c.option_name)",
        CHANGES,
    ),
    "append_addresses": addresses("dst"),
    "copy_order_meta": (
        f"SELECT post_id AS order_id, meta_key, meta_value FROM src_postmeta WHERE post_id IN {ORDER_IDS}"
    ),
    "entity_counts_report": (
        counts(
            {"Traditional Orders": DST_ORDERS, "HPOS Orders": "wc_orders", "Customers": "dst_users"},
            "entity",
        ),
        {"wc_orders": wide("dst")},
    ),
    # wide tables and reports
    "orders_wide": wide("src"),
    "orders_wide_light": light("src_posts", "src_postmeta"),
    "order_addresses": addresses("src"),
    "order_operational": OPERATIONAL_SQL,
    "product_catalog": (catalog(), NAMED),
    "product_catalog_in_stock": (catalog(f" AND {STOCK}"), NAMED),
    "user_validation": USER_CHECK,
    "order_validation": ORDER_CHECK,
    "meta_validation": META_CHECK.format(meta="dst_postmeta"),
    "integrity_check": integrity("src"),
    "wide_reconciliation": (
        "SELECT *, CASE WHEN wide_orders = traditional_orders AND wide_orders > 0 THEN 'complete' "
        f"ELSE 'differs' END AS result FROM (SELECT (SELECT count(*) FROM {ORDERS}) AS traditional_orders, "
        "(SELECT count(*) FROM wc_orders) AS wide_orders) AS c",
        {"wc_orders": wide("dst")},
    ),
    "import_reconciliation": (
        "SELECT *, CASE WHEN imported = expected THEN 'complete' ELSE 'mismatch' END AS result FROM (SELECT "
        f"(SELECT count(*) FROM {DST_ORDERS}) AS imported, (SELECT count(*) FROM {ORDERS}) AS expected) AS c"
    ),
    "customer_import_stats": (IMPORT_STATS, USERS_AFTER),
    # jobs
    "job_migrate_customers": (IMPORT_STATS, USERS_AFTER),
    "job_migrate_orders": (
        counts(
            {
                "orders": "(SELECT 1 AS x FROM converted_posts WHERE post_type = 'shop_order') AS a",
                "order_meta": (
                    "(SELECT 1 AS x FROM meta_after WHERE post_id IN "
                    "(SELECT id FROM converted_posts WHERE post_type = 'shop_order')) AS b"
                ),
                "order_items": f"({ITEMS}) AS c",
                "order_itemmeta": f"({ITEMMETA}) AS d",
            },
            "table_name",
        ),
        MIGRATED,
    ),
    "job_convert_wide": (
        "SELECT *, CASE WHEN wide_orders = traditional_orders AND wide_orders > 0 THEN 'complete' "
        f"ELSE 'differs' END AS result FROM (SELECT (SELECT count(*) FROM {DST_ORDERS}) AS traditional_orders, "
        "(SELECT count(*) FROM wc_orders) AS wide_orders) AS c",
        {"wc_orders": wide("dst")},
    ),
    "job_orders_complete": (light("converted_posts", "meta_after"), MIGRATED),
    "job_full": (
        counts(
            {
                "Traditional Orders": "(SELECT 1 AS x FROM posts_after WHERE post_type = 'shop_order') AS a",
                "HPOS Orders": "(SELECT 1 AS x FROM posts_after WHERE post_type = 'shop_order') AS b",
                "Customers": "users_after",
            },
            "entity",
        ),
        {**USERS_AFTER, **MIGRATED},
    ),
    "job_fix_statuses": (
        f"SELECT {converted('post_status')} AS post_status, count(*) AS n FROM {DST_ORDERS} GROUP BY 1"
    ),
    "job_sync_exact": (
        f"SELECT post_status, count(*) AS n FROM ({synced('s.post_status')}) AS a "
        "WHERE post_type = 'shop_order' GROUP BY post_status"
    ),
    "job_validate": VALIDATION,
    # column functions
    "clean_text": (
        f"SELECT id, {clean('post_title')} AS post_title, {clean('post_excerpt')} AS post_excerpt, "
        f"{clean('post_content')} AS post_content FROM src_posts"
    ),
    "strip_status_all": "SELECT id, replace(post_status, 'wc-', '') AS status FROM src_posts",
    "strip_status_prefix": (
        "SELECT id, CASE WHEN starts_with(post_status, 'wc-') THEN substr(post_status, 4) "
        "ELSE post_status END AS status FROM src_posts"
    ),
    "strip_status_substr": "SELECT id, substr(post_status, 4) AS status FROM src_posts",
    "image_url": (
        f"SELECT post_id, {URL} || meta_value AS url FROM src_postmeta WHERE meta_key = '_wp_attached_file'"
    ),
    "price_fallback": f"SELECT p.id, {PRICE} AS price FROM src_posts AS p WHERE p.post_type = 'product'",
    "product_type": (
        f"SELECT p.id, {KIND} AS product_type FROM src_posts AS p "
        "WHERE p.post_type = 'product' AND p.post_status = 'publish'",
        NAMED,
    ),
    "to_unsigned": f"SELECT meta_id, {unsigned('meta_value')} AS number FROM src_postmeta",
    "to_decimal": f"SELECT meta_id, {decimal('meta_value')} AS number FROM src_postmeta",
    "from_unixtime": (
        f"SELECT meta_id, {unix('meta_value')} AS moment FROM src_postmeta "
        "WHERE meta_key IN ('_date_paid', '_date_completed', '_billing_email')"
    ),
    "yes_flag": f"SELECT meta_id, {flag('meta_value')} AS flag FROM src_postmeta",
    "true_flag": f"SELECT meta_id, {flag('meta_value', 'true')} AS flag FROM src_postmeta",
    "default_order_key": (
        f"SELECT o.id, coalesce({first_value('src_postmeta', 'o.id', '_order_key')}, "
        f"concat('wc_order_', o.id)) AS order_key FROM {ORDERS}"
    ),
    "round_pct": (
        "SELECT post_excerpt, CAST(round(CAST(count(*) FILTER (WHERE post_status = 'wc-completed') * 100 "
        f"AS DOUBLE) / count(*), 2) AS DOUBLE) AS pct FROM {ORDERS} GROUP BY post_excerpt"
    ),
    "int_pct": (
        "SELECT post_excerpt, count(*) FILTER (WHERE post_status = 'wc-completed') * 100 // "
        "nullif(count(*) FILTER (WHERE post_status = 'wc-cancelled'), 0) AS pct, "
        "coalesce(count(*) FILTER (WHERE post_status = 'wc-completed') * 100 // "
        "nullif(count(*) FILTER (WHERE post_status = 'wc-trash'), 0), -1) AS no_pct "
        f"FROM {ORDERS} GROUP BY post_excerpt"
    ),
    "now_stamp": f"SELECT id, {NOW} AS stamp FROM {ORDERS}",
}


# an increment gives what the ordinary merge gives
STATEMENTS |= {
    "insert_increment": STATEMENTS["insert_ignore"],
    "increment_rejects": STATEMENTS["insert_ignore_rejects"],
    "missing_customers_increment": STATEMENTS["missing_customers"],
}


def differences(key: str, columns: list[str], left: str, right: str) -> str:
    """Keys of rows that one side lacks, or that are not alike in every column."""
    unlike = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in columns)
    return (
        f"SELECT coalesce(a.{key}, b.{key}) AS {key}, CASE WHEN b.{key} IS NULL THEN 'missing' WHEN a.{key} IS NULL "
        f"THEN 'extra' ELSE 'changed' END AS difference FROM (SELECT * FROM {left}) AS a FULL JOIN (SELECT * FROM {right}) AS b "
        f"ON a.{key} = b.{key} WHERE a.{key} IS NULL OR b.{key} IS NULL OR {unlike}"
    )


POST_COLUMNS = [c.split()[0] for c in SCHEMAS["posts"].split(", ")]
STATEMENTS |= {
    "order_differences": differences("id", POST_COLUMNS, ORDERS, DST_ORDERS),
    "usermeta_differences": differences(
        "umeta_id", ["user_id", "meta_key", "meta_value"], "src_usermeta", "dst_usermeta"
    ),
    "import_differences": (
        f"SELECT id, 'changed' AS difference FROM {ORDERS} WHERE post_status <> {converted('post_status')}"
    ),
}


# --- what jobs leave behind ------------------------------------------------------------

COLUMNS = {name: [c.split()[0] for c in columns.split(", ")] for name, columns in SCHEMAS.items()}
COLUMNS["users"] = [*COLUMNS["users"], "user_registered"]
COLUMNS["order_items"] = [*COLUMNS["order_items"], "part", "qty"]
LIGHT_COLUMNS = (
    "id status currency type customer_id date_created_gmt date_updated_gmt total_amount billing_email"
).split()
WIDE_COLUMNS = [
    *LIGHT_COLUMNS,
    *"tax_amount parent_order_id payment_method payment_method_title transaction_id".split(),
    *"customer_note ip_address user_agent".split(),
]
OPERATIONAL_MONEY = [f"{a}_{b}_amount" for a in ("shipping", "discount") for b in ("tax", "total")]
OPERATIONAL_COLUMNS = [
    *"order_id created_via woocommerce_version prices_include_tax coupon_usages_are_counted".split(),
    *"download_permission_granted cart_hash new_order_email_sent order_key order_stock_reduced".split(),
    *"date_paid_gmt date_completed_gmt recorded_sales".split(),
    *OPERATIONAL_MONEY,
]


def left_behind(**queries: str) -> str:
    """Digests of tables, each given by its query."""
    wide = {
        "wc_orders": (WIDE_COLUMNS, ["tax_amount", "total_amount"]),
        "wc_orders_light": (LIGHT_COLUMNS, ["total_amount"]),
        "wc_orders_meta": (["order_id", "meta_key", "meta_value"], []),
        "wc_order_addresses": (["order_id", "address_type", *PLACE, "email", "phone"], []),
        "wc_order_operational_data": (OPERATIONAL_COLUMNS, OPERATIONAL_MONEY),
    }
    tables = {}
    for name, sql in queries.items():
        columns, money = wide.get(name) or (COLUMNS[name], [])
        tables[name.removesuffix("_light")] = (f"({sql}) AS t", columns, money)
    return digest_sql(tables)


CUSTOMERS_LEFT = {
    "users": "SELECT * FROM dst_users UNION ALL SELECT * FROM src_users WHERE id IN (SELECT id FROM missing)",
    "usermeta": (
        "SELECT * FROM dst_usermeta UNION ALL SELECT * FROM incoming "
        "WHERE umeta_id NOT IN (SELECT umeta_id FROM dst_usermeta)"
    ),
    "options": PURGED,
}
ORDERS_LEFT = {
    "posts": "SELECT * FROM converted_posts",
    "postmeta": "SELECT * FROM meta_after",
    "order_items": ITEMS,
    "order_itemmeta": ITEMMETA,
}
PURGED_ANY = STATEMENTS["purge_transients_any"]
DST_CONVERTED = STATEMENTS["convert_statuses"].replace("src_posts", "dst_posts")
DST_WIDE = {"wc_orders": wide("dst")}
WIDE_SYNCED = STATEMENTS["sync_statuses_wide"][0]
STATEMENTS |= {
    "delete_orders_cascade_tables": left_behind(
        posts="SELECT * FROM dst_posts WHERE post_type <> 'shop_order'",
        postmeta=f"SELECT * FROM dst_postmeta WHERE post_id NOT IN {DST_ORDER_IDS}",
        order_items="SELECT * FROM dst_order_items WHERE false",
        order_itemmeta="SELECT * FROM dst_order_itemmeta WHERE false",
    ),
    "restore_snapshot_tables": left_behind(
        **{
            t: f"SELECT * FROM dst_{t}"
            for t in "users usermeta posts postmeta order_items order_itemmeta options".split()
        },
        **{t: f"SELECT * FROM {t}" for t in "terms term_taxonomy term_relationships".split()},
    ),
    "job_migrate_customers_tables": (left_behind(**CUSTOMERS_LEFT), MISSING_META),
    "job_migrate_orders_tables": (left_behind(**ORDERS_LEFT), MIGRATED),
    "job_convert_wide_tables": (
        left_behind(
            wc_orders=wide("dst"),
            wc_orders_meta=STATEMENTS["copy_order_meta"].replace("src_", "dst_"),
            wc_order_addresses=addresses("dst"),
            wc_order_operational_data=OPERATIONAL_SQL.replace("src_", "dst_"),
            options=STATEMENTS["upsert_options"][0],
        ),
        CHANGES,
    ),
    "job_full_tables": (
        left_behind(**CUSTOMERS_LEFT, **ORDERS_LEFT, wc_orders_light=light("converted_posts", "meta_after")),
        {**MISSING_META, **MIGRATED},
    ),
    "job_fix_statuses_tables": (
        left_behind(
            status_backup=(
                f"SELECT id AS order_id, post_status AS original_status, {NOW} AS backup_date FROM {DST_ORDERS}"
            ),
            posts=DST_CONVERTED,
            postmeta=STATEMENTS["convert_statuses_meta"],
            options=PURGED_ANY,
            wc_orders=STATEMENTS["convert_statuses_wide"][0],
        ),
        DST_WIDE,
    ),
    "job_convert_statuses_tables": left_behind(posts=DST_CONVERTED, options=PURGED),
    "job_sync_exact_tables": (
        left_behind(posts=synced("s.post_status"), options=PURGED, wc_orders=WIDE_SYNCED),
        DST_WIDE,
    ),
    "job_sync_converted_tables": (
        left_behind(
            posts=synced(converted("s.post_status")),
            options=PURGED_ANY,
            wc_orders=WIDE_SYNCED.replace(
                "regexp_replace(s.post_status, '^wc-', '')", f"substr({converted('s.post_status')}, 4)"
            ),
        ),
        DST_WIDE,
    ),
    "job_sync_preserved_tables": (
        left_behind(posts=synced("s.post_status"), options=PURGED_ANY, wc_orders=WIDE_SYNCED),
        DST_WIDE,
    ),
    "job_export_catalog": (catalog(), NAMED),
}


# --- what jobs saw on their way --------------------------------------------------------

KNOWN = (
    "wc-completed wc-processing wc-on-hold wc-cancelled wc-refunded wc-failed wc-pending wc-pending-payment "
    "wc-delivered wc-pre-order-booked"
).split()
ACCEPTED = ", ".join(f"'{x}'" for x in KNOWN[:8])


def step(name: str, **values: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS step, '{m}' AS metric, ({v}) AS value" for m, v in values.items())


def profile(name: str, orders: str) -> str:
    """Orders by status; those that have no name here together."""
    listed = ", ".join(f"'{x}'" for x in KNOWN)
    parts = {x: f"SELECT count(*) FROM {orders} WHERE post_status = '{x}'" for x in KNOWN}
    parts["other"] = f"SELECT count(*) FROM {orders} WHERE coalesce(post_status, '') NOT IN ({listed})"
    return step(name, **parts, total=f"SELECT count(*) FROM {orders}")


#: The status that the last line of an order gives.
LAST_LINE = "CASE s.post_status WHEN 'wc-on-hold' THEN 'wc-completed' ELSE s.post_status END"

STATEMENTS |= {
    "job_migrate_orders_steps": (
        step(
            "orders",
            expected=f"SELECT count(*) FROM {ORDERS}",
            imported="SELECT count(*) FROM converted_posts WHERE post_type = 'shop_order'",
        ),
        MIGRATED,
    ),
    "job_fix_statuses_steps": " UNION ALL ".join(
        [
            step(
                "conversion",
                **{
                    metric: f"SELECT count(*) FROM {DST_ORDERS} WHERE post_status = '{status}'"
                    for metric, status in [
                        ("delivered", "wc-delivered"),
                        ("failed", "wc-failed"),
                        ("pre_order_booked", "wc-pre-order-booked"),
                    ]
                },
                total=(
                    f"SELECT count(*) FROM {DST_ORDERS} "
                    "WHERE post_status IN ('wc-delivered', 'wc-failed', 'wc-pre-order-booked')"
                ),
                left=f"SELECT count(*) FROM {DST_ORDERS} WHERE {converted('post_status')} NOT IN ({ACCEPTED})",
            ),
            profile("before", DST_ORDERS),
            profile("after", f"(SELECT {converted('post_status')} AS post_status FROM {DST_ORDERS}) AS c"),
        ]
    ),
    "job_sync_exact_steps": " UNION ALL ".join(
        [
            profile("source", ORDERS),
            profile("destination before", DST_ORDERS),
            profile("destination after", f"(FROM ({synced('s.post_status')}) WHERE post_type = 'shop_order') AS a"),
            step(
                "orders",
                found=f"SELECT count(*) FROM {DST_ORDERS} WHERE id IN {ORDER_IDS}",
                not_found=f"SELECT count(*) FROM {DST_ORDERS} WHERE id NOT IN {ORDER_IDS}",
            ),
        ]
    ),
    "job_full_validated": (
        VALIDATION.replace("dst_usermeta", "usermeta_after")
        .replace("dst_users", "users_after")
        .replace("dst_postmeta", "meta_after")
        .replace("dst_posts", "converted_posts")
        .replace("dst_order_items", "items_after"),
        {
            **MISSING_META,
            "users_after": CUSTOMERS_LEFT["users"],
            "usermeta_after": CUSTOMERS_LEFT["usermeta"],
            "items_after": ITEMS,
            **MIGRATED,
        },
    ),
    "rejected_status_lines": (
        f"SELECT '#' || id AS line, 'not two fields' AS reason FROM {ORDERS} WHERE post_status = 'wc-failed' UNION ALL "
        f"SELECT concat_ws(chr(9), id, post_status, 'more'), 'not two fields' FROM {ORDERS} WHERE post_status = 'wc-cancelled'"
    ),
    "sync_statuses_last_line": synced(LAST_LINE),
    "job_sync_file": " UNION ALL ".join(
        [
            step(
                "feed",
                accepted=f"SELECT count(*) + count(*) FILTER (WHERE post_status = 'wc-on-hold') FROM {ORDERS}",
                rejected=f"SELECT count(*) FROM {ORDERS} WHERE post_status IN ('wc-failed', 'wc-cancelled')",
            ),
            profile("destination before", DST_ORDERS),
            profile("destination after", f"(FROM ({synced(LAST_LINE)}) WHERE post_type = 'shop_order') AS a"),
            step(
                "orders",
                found=f"SELECT count(*) FROM {DST_ORDERS} WHERE id IN {ORDER_IDS}",
                not_found=f"SELECT count(*) FROM {DST_ORDERS} WHERE id NOT IN {ORDER_IDS}",
            ),
        ]
    ),
    "job_orders_complete_bucketed": (light("converted_posts", "meta_after"), MIGRATED),
    "split_shares": "SELECT count(*) AS n_rows, 8 AS shares, true AS even FROM src_postmeta",
    "job_convert_wide_live_tables": STATEMENTS["job_convert_wide_tables"],
}


def all_oracles() -> dict[str, str]:
    complete = {}
    for name, statement in STATEMENTS.items():
        sql, steps = statement if isinstance(statement, tuple) else (statement, {})
        complete[name] = with_tables(sql, steps)
    return complete
