"""How the store tables follow from the driver's tables (FIXTURES.md).

The expressions here are plain SQL that Spark and DuckDB read alike. ``store_frames`` turns them
into DataFrames and ``store_sql`` into common table expressions, so both engines start from the
same rows while the operators on top are written twice.

Every table is derived from whole driver tables and grows with them. The modulo conditions only
give rows different shapes and the destination its gaps; no query selects by them.
"""

from __future__ import annotations

# Id ranges of the derived entities. They stay apart up to 10^11 rows per driver table.
VENDOR = 500_000_000_001
STAFF = 900_000_000_000
PRODUCT = 1_000_000_000_001
ATTACHMENT = 2_000_000_000_001
ORPHAN = 3_000_000_000_001


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS STRING)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# --- users: one column map per driver table --------------------------------------------

# The library doesn't know user_registered: such columns must come through every copy.
USERS_FROM = {
    "customer": {
        "id": big("c_custkey + 1"),
        "user_login": f"'user_' || {text('c_custkey + 1')}",
        "user_email": f"'user' || {text('c_custkey + 1')} || '@example.com'",
        "display_name": "c_name",
        "user_registered": f"'2020-' || {text('c_custkey')}",
    },
    "supplier": {
        "id": f"{big('s_suppkey')} + {VENDOR}",
        "user_login": f"'vendor_' || {text('s_suppkey + 1')}",
        "user_email": f"'vendor' || {text('s_suppkey + 1')} || '@example.com'",
        "display_name": "s_name",
        "user_registered": f"'2020-' || {text('s_suppkey')}",
    },
    "nation": {
        "id": f"{big('n_nationkey')} + {STAFF}",
        "user_login": f"'staff_' || {text('n_nationkey')}",
        "user_email": f"'staff' || {text('n_nationkey')} || '@example.com'",
        "display_name": "n_name",
        "user_registered": f"'2020-' || {text('n_nationkey')}",
    },
}

# The destination lacks every third user, so ids have gaps.
DST_USER_PRESENT = "id % 3 <> 0"
DST_LOGIN = f"CASE WHEN id % 5 = 0 THEN 'local_' || {text('id')} ELSE 'user_' || {text('id')} END"

# (k, key, value) per user
USER_META = [
    (0, "src_capabilities", "'customer'"),
    (1, "src_user_level", "'0'"),
    (2, "nickname", "user_login"),
]
DST_META_KEY = (
    "CASE WHEN meta_key = 'src_capabilities' THEN 'dst_capabilities' "
    "WHEN meta_key = 'src_user_level' THEN 'dst_user_level' ELSE meta_key END"
)
DST_USERMETA_PRESENT = "user_id % 3 <> 0"
STAFF_META = {
    "umeta_id": big("30 * (n_nationkey + 1)"),
    "user_id": f"{big('n_nationkey')} + {STAFF}",
    "meta_key": "'dst_capabilities'",
    "meta_value": "'administrator'",
}

# --- posts -----------------------------------------------------------------------------

ORDER_STATUS = (
    "CASE o_orderkey % 20 WHEN 0 THEN 'wc-delivered' WHEN 1 THEN 'wc-failed' "
    "WHEN 2 THEN 'wc-pre-order-booked' WHEN 3 THEN 'wc-refunded' WHEN 4 THEN 'wc-on-hold' "
    "WHEN 5 THEN 'wc-processing' WHEN 6 THEN 'wc-pending' WHEN 7 THEN 'wc-shipped' "
    "ELSE CASE o_orderstatus WHEN 'F' THEN 'wc-completed' WHEN 'O' THEN 'wc-cancelled' "
    "ELSE 'wc-delivered' END END"
)

# A local date that sorts otherwise than the UTC date.
LOCAL_DATE = "o_orderdate + ({key} % 30) * INTERVAL '1' DAY"

POSTS_FROM_ORDERS = {
    "id": big("o_orderkey + 1"),
    "post_author": big("1"),
    "post_type": "'shop_order'",
    "post_status": ORDER_STATUS,
    "post_title": f"'Order ' || {text('o_orderkey + 1')}",
    "post_name": "''",
    "post_excerpt": "'note ' || o_orderpriority",
    "post_content": "''",
    "post_date": LOCAL_DATE.format(key="o_orderkey"),
    "post_date_gmt": "o_orderdate",
    "post_modified": LOCAL_DATE.format(key="o_orderkey"),
    "post_modified_gmt": "o_orderdate",
    "post_parent": big("0"),
}

# from part LEFT JOIN orders ON o_orderkey = p_partkey LEFT JOIN documents ON doc_id = p_partkey
POSTS_FROM_PART = {
    "id": f"{big('p_partkey')} + {PRODUCT}",
    "post_author": big("1"),
    "post_type": "'product'",
    "post_status": "CASE WHEN p_partkey % 11 = 0 THEN 'draft' ELSE 'publish' END",
    "post_title": (
        "CASE p_partkey % 4 WHEN 0 THEN p_name || ' \"deluxe\"' "
        "WHEN 1 THEN p_name || chr(10) || 'line2' WHEN 2 THEN p_name || chr(9) || 'tab' "
        "ELSE p_name END"
    ),
    "post_name": f"replace(p_name, ' ', '-') || '-' || {text('p_partkey')}",
    "post_excerpt": "p_type || chr(13) || p_brand",
    "post_content": "coalesce(text, '')",
    "post_date": LOCAL_DATE.format(key="p_partkey"),
    "post_date_gmt": "o_orderdate",
    "post_modified": LOCAL_DATE.format(key="p_partkey"),
    "post_modified_gmt": "o_orderdate",
    "post_parent": big("0"),
}

# from part LEFT JOIN orders ON o_orderkey = p_partkey
POSTS_FROM_IMAGE = {
    "id": f"{big('p_partkey')} + {ATTACHMENT}",
    "post_author": big("1"),
    "post_type": "'attachment'",
    "post_status": "'inherit'",
    "post_title": "p_name",
    "post_name": "''",
    "post_excerpt": "''",
    "post_content": "''",
    "post_date": LOCAL_DATE.format(key="p_partkey"),
    "post_date_gmt": "o_orderdate",
    "post_modified": LOCAL_DATE.format(key="p_partkey"),
    "post_modified_gmt": "o_orderdate",
    "post_parent": f"{big('p_partkey')} + {PRODUCT}",
}

# The destination lacks every fourth order and disagrees on some statuses.
DST_POST_PRESENT = "(post_type <> 'shop_order' OR id % 4 <> 0)"
DST_POST_STATUS = "CASE WHEN id % 10 = 1 THEN 'wc-processing' ELSE post_status END"

# --- postmeta: (k, key, value, condition under which the row exists) -------------------

ORDER_META = [
    (1, "_order_currency", "'USD'", "o_orderkey % 4 <> 0"),
    (
        2,
        "_order_tax",
        "CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN '12.5abc' "
        f"ELSE {text('o_orderkey % 1000')} || '.25' END",
        "o_orderkey % 5 <> 0",
    ),
    (3, "_order_total", money("o_totalprice"), "true"),
    (
        4,
        "_customer_user",
        f"CASE WHEN o_orderkey % 13 = 0 THEN '0' ELSE {text('o_custkey + 1')} END",
        "o_orderkey % 17 <> 0",
    ),
    (5, "_billing_email", f"'user' || {text('o_custkey + 1')} || '@example.com'", "true"),
    (
        6,
        "_payment_method",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'card' ELSE 'cod' END",
        "true",
    ),
    (7, "_transaction_id", f"'txn_' || {text('o_orderkey')}", "o_orderstatus = 'F'"),
    (8, "_billing_first_name", f"'First' || {text('o_custkey')}", "true"),
    (9, "_billing_city", f"'City' || {text('o_custkey % 50')}", "true"),
    (10, "_shipping_first_name", f"'First' || {text('o_custkey')}", "o_orderkey % 3 <> 0"),
    (11, "_shipping_city", f"'City' || {text('o_custkey % 40')}", "o_orderkey % 3 <> 0"),
    (12, "_created_via", "'admin'", "o_orderkey % 2 <> 1"),
    (
        13,
        "_prices_include_tax",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END",
        "true",
    ),
    (14, "_order_key", f"'wc_order_key' || {text('o_orderkey')}", "o_orderkey % 7 <> 0"),
    (15, "_date_paid", text("1700000000 + o_orderkey"), "o_orderstatus = 'F'"),
    (16, "_order_shipping", "'4.50'", "true"),
    (
        17,
        "_order_status",
        "CASE WHEN o_orderstatus = 'P' THEN 'delivered' ELSE 'completed' END",
        "true",
    ),
    (18, "_order_total", "'9.00'", "o_orderkey % 19 = 0"),
    (
        19,
        "_payment_method_title",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Card' ELSE 'Cash on delivery' END",
        "o_orderkey % 6 <> 0",
    ),
    (20, "_customer_ip_address", f"'10.0.0.' || {text('o_custkey % 250')}", "o_orderkey % 4 = 1"),
    (21, "_customer_user_agent", f"'agent/' || {text('o_custkey % 7')}", "o_orderkey % 4 = 2"),
    (22, "_billing_last_name", f"'Last' || {text('o_custkey')}", "o_orderkey % 2 = 0"),
    (23, "_billing_company", f"'Company ' || {text('o_custkey % 9')}", "o_orderkey % 8 = 0"),
    (24, "_billing_address_1", f"{text('o_custkey')} || ' Main St'", "o_orderkey % 2 = 0"),
    (25, "_billing_address_2", f"'Flat ' || {text('o_custkey % 30')}", "o_orderkey % 9 = 0"),
    (26, "_billing_state", f"'S' || {text('o_custkey % 12')}", "o_orderkey % 3 = 0"),
    (27, "_billing_postcode", text("10000 + o_custkey % 900"), "o_orderkey % 3 = 1"),
    (28, "_billing_country", "'IN'", "o_orderkey % 4 = 3"),
    (29, "_billing_phone", f"'+91' || {text('o_custkey')}", "o_orderkey % 5 = 1"),
    (30, "_shipping_last_name", f"'Last' || {text('o_custkey')}", "o_orderkey % 6 = 1"),
    (31, "_shipping_company", f"'Company ' || {text('o_custkey % 9')}", "o_orderkey % 12 = 1"),
    (32, "_shipping_address_1", f"{text('o_custkey')} || ' Dock Rd'", "o_orderkey % 6 = 2"),
    (33, "_shipping_address_2", f"'Gate ' || {text('o_custkey % 30')}", "o_orderkey % 12 = 2"),
    (34, "_shipping_state", f"'S' || {text('o_custkey % 12')}", "o_orderkey % 6 = 4"),
    (35, "_shipping_postcode", text("20000 + o_custkey % 900"), "o_orderkey % 6 = 5"),
    (36, "_shipping_country", "'IN'", "o_orderkey % 9 = 1"),
    (37, "_shipping_phone", f"'+92' || {text('o_custkey')}", "o_orderkey % 9 = 2"),
    (38, "_order_version", f"'8.' || {text('o_orderkey % 10')}", "o_orderkey % 3 = 0"),
    (
        39,
        "_recorded_coupon_usage_counts",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'yes' ELSE 'no' END",
        "o_orderkey % 2 = 0",
    ),
    (
        40,
        "_download_permissions_granted",
        "CASE WHEN o_orderkey % 9 = 0 THEN 'yes' ELSE 'no' END",
        "o_orderkey % 3 = 0",
    ),
    (41, "_cart_hash", f"'cart' || {text('o_orderkey')}", "o_orderkey % 5 = 2"),
    (
        42,
        "_new_order_email_sent",
        "CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'yes' ELSE 'false' END",
        "o_orderkey % 2 = 1",
    ),
    (
        43,
        "_order_stock_reduced",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'yes' ELSE 'no' END",
        "o_orderkey % 2 = 0",
    ),
    (
        44,
        "_date_completed",
        f"CASE WHEN o_orderkey % 31 = 0 THEN 'soon' ELSE {text('1700086400 + o_orderkey')} END",
        "o_orderstatus = 'F' AND o_orderkey % 2 = 0",
    ),
    (45, "_order_shipping_tax", f"'0.' || {text('o_orderkey % 10')}", "o_orderkey % 5 = 3"),
    (46, "_cart_discount_tax", f"{text('o_orderkey % 3')} || '.5'", "o_orderkey % 7 = 0"),
    (47, "_cart_discount", f"{text('o_orderkey % 40')} || '.10'", "o_orderkey % 7 < 2"),
    (48, "_recorded_sales", "CASE WHEN o_orderkey % 5 = 0 THEN 'no' ELSE 'yes' END", "o_orderkey % 2 = 1"),
]

PRODUCT_META = [
    (1, "_price", money("p_retailprice"), "p_partkey % 5 <> 0"),
    (
        2,
        "_regular_price",
        "CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 2 AS STRING)",
        "p_partkey % 10 <> 0",
    ),
    (3, "_sku", f"'SKU-' || {text('p_partkey')}", "p_partkey % 6 <> 0"),
    (
        4,
        "_stock_status",
        "CASE p_partkey % 3 WHEN 0 THEN 'outofstock' WHEN 1 THEN 'instock' ELSE 'onbackorder' END",
        "p_partkey % 9 <> 0",
    ),
    (5, "_thumbnail_id", text(f"{big('p_partkey')} + {ATTACHMENT}"), "p_partkey % 8 <> 0"),
]

IMAGE_META = [
    (
        1,
        "_wp_attached_file",
        f"CASE WHEN p_partkey % 12 = 1 THEN '' ELSE '2024/' || {text('p_partkey')} || '.jpg' END",
        "true",
    ),
]

ORPHAN_META = [(1, "_order_total", "'1.00'", "true")]

# (driver table, id of the owning post, keys)
POSTMETA_FROM = [
    ("orders", big("o_orderkey + 1"), ORDER_META),
    ("part", f"{big('p_partkey')} + {PRODUCT}", PRODUCT_META),
    ("part", f"{big('p_partkey')} + {ATTACHMENT}", IMAGE_META),
    ("nation", f"{big('n_nationkey')} + {ORPHAN}", ORPHAN_META),
]

# --- order items: lineitem grouped by (l_orderkey, l_linenumber) ------------------------

ITEM_KEYS = ["l_orderkey", "l_linenumber"]
ITEM_AGGREGATES = {
    "part": "min(l_partkey)",
    "qty": "CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS STRING)",
}
ITEMS = {
    "order_item_id": big("l_orderkey * 10 + l_linenumber"),
    "order_id": big("l_orderkey + 1"),
    "order_item_type": "'line_item'",
    "part": "part",
    "qty": "qty",
}
ITEM_META = [
    (1, "_product_id", text(f"part + {PRODUCT}")),
    (2, "_qty", "qty"),
]

# --- taxonomy --------------------------------------------------------------------------

FIXED_TERMS = [(1, "buynow"), (2, "30days"), (3, "sale")]
# try_cast: a plain cast can fail on another row's text once the optimizer folds constants.
BRAND = "TRY_CAST(substr(p_brand, 7) AS BIGINT)"
TERM_TAXONOMY = {
    "term_taxonomy_id": "term_id + 1000",
    "term_id": "term_id",
    "taxonomy": "CASE WHEN term_id < 100 THEN 'product_tag' ELSE 'product_cat' END",
}
# (term_taxonomy_id, condition) per part
RELATIONSHIPS = [
    (f"1100 + {BRAND}", "p_partkey % 10 <> 3"),
    (f"1101 + {BRAND} % 25", "p_partkey % 4 = 1"),
    (big("1001"), "p_partkey % 2 = 0"),
    (big("1002"), "p_partkey % 3 = 0"),
    (big("1003"), "p_partkey % 5 = 0"),
]
RELATIONSHIP_OBJECT = f"{big('p_partkey')} + {PRODUCT}"

# --- options: settings per nation, and cached entries per customer ----------------------

OPTIONS_FROM = {
    "nation": {
        "option_id": big("n_nationkey + 1"),
        "option_name": (
            "CASE WHEN n_nationkey <> 24 THEN CASE n_nationkey % 5 WHEN 0 THEN '_transient_' WHEN 1 THEN '_transient_timeout_' "
            "WHEN 2 THEN '_site_transient_' WHEN 3 THEN 'xtransient_' ELSE 'opt_' END || lower(n_name) END"
        ),
        "option_value": f"'v' || {text('n_nationkey')}",
        "autoload": "'yes'",
    },
    "customer": {
        "option_id": big("c_custkey + 1000"),
        "option_name": (
            "CASE c_custkey % 4 WHEN 0 THEN '_transient_visit_' "
            "WHEN 1 THEN '_site_transient_timeout_visit_' WHEN 2 THEN 'own_transient_visit_' "
            f"ELSE 'session_' END || {text('c_custkey')}"
        ),
        "option_value": "c_mktsegment",
        "autoload": "'no'",
    },
}
FIXED_OPTION = (100, "woocommerce_custom_orders_table_enabled", "no", "yes")
