"""Fixed values of the store data model.

These are facts of the data being processed (type names, status names, metadata keys,
default values, thresholds). Results depend on them being exactly as written.
"""

# --- Fixed values: entity types and statuses -------------------------------------------

ORDER_TYPE = "shop_order"
PRODUCT_TYPE = "product"
PUBLISHED = "publish"

# Custom status -> standard status.
STATUS_MAP = {
    "wc-delivered": "wc-completed",
    "wc-pre-order-booked": "wc-on-hold",
    "wc-failed": "wc-cancelled",
}

# The same mapping for places that store the status without its prefix.
BARE_STATUS_MAP = {
    "delivered": "completed",
    "pre-order-booked": "on-hold",
    "failed": "cancelled",
}

CUSTOM_STATUSES = ["wc-delivered", "wc-pre-order-booked", "wc-failed"]

# Seven statuses counted as standard after a conversion.
STANDARD_STATUSES = [
    "wc-pending",
    "wc-processing",
    "wc-on-hold",
    "wc-completed",
    "wc-cancelled",
    "wc-refunded",
    "wc-failed",
]

# Eight statuses that the leftover check accepts.
ACCEPTED_STATUSES = [
    "wc-completed",
    "wc-processing",
    "wc-on-hold",
    "wc-cancelled",
    "wc-refunded",
    "wc-failed",
    "wc-pending",
    "wc-pending-payment",
]

# Output column -> status, for the one-row status profile.
PROFILED_STATUSES = {
    "delivered": "wc-delivered",
    "failed": "wc-failed",
    "pre_order_booked": "wc-pre-order-booked",
    "completed": "wc-completed",
    "cancelled": "wc-cancelled",
    "refunded": "wc-refunded",
}

# --- Fixed values: metadata keys (output column -> key) --------------------------------

CUSTOMER_KEY = "_customer_user"
GUEST = "0"
STATUS_KEY = "_order_status"
TOTAL_KEY = "_order_total"
EMAIL_KEY = "_billing_email"

CORE_KEYS = {
    "currency": "_order_currency",
    "tax": "_order_tax",
    "total": "_order_total",
    "customer_id": "_customer_user",
    "billing_email": "_billing_email",
    "payment_method": "_payment_method",
    "payment_method_title": "_payment_method_title",
    "transaction_id": "_transaction_id",
    "ip_address": "_customer_ip_address",
    "user_agent": "_customer_user_agent",
}

BILLING_FIELDS = [
    "first_name",
    "last_name",
    "company",
    "address_1",
    "address_2",
    "city",
    "state",
    "postcode",
    "country",
    "email",
    "phone",
]

SHIPPING_FIELDS = [
    "first_name",
    "last_name",
    "company",
    "address_1",
    "address_2",
    "city",
    "state",
    "postcode",
    "country",
    "phone",
]

BILLING_PATTERN = "_billing_%"
SHIPPING_PATTERN = "_shipping_%"

OPERATIONAL_KEYS = {
    "created_via": "_created_via",
    "version": "_order_version",
    "prices_include_tax": "_prices_include_tax",
    "coupons_counted": "_recorded_coupon_usage_counts",
    "downloads_granted": "_download_permissions_granted",
    "cart_hash": "_cart_hash",
    "email_sent": "_new_order_email_sent",
    "order_key": "_order_key",
    "stock_reduced": "_order_stock_reduced",
    "date_paid": "_date_paid",
    "date_completed": "_date_completed",
    "shipping_tax": "_order_shipping_tax",
    "shipping_total": "_order_shipping",
    "discount_tax": "_cart_discount_tax",
    "discount_total": "_cart_discount",
    "recorded_sales": "_recorded_sales",
}

# --- Fixed values: defaults of the wide tables -----------------------------------------

DEFAULT_CURRENCY = "INR"
DEFAULT_CREATED_VIA = "checkout"
DEFAULT_VERSION = "9.3.3"
ORDER_KEY_PREFIX = "wc_order_"
MONEY_TYPE = "decimal(26,8)"

# --- Fixed values: product catalogue ---------------------------------------------------

PRICE_KEY = "_price"
REGULAR_PRICE_KEY = "_regular_price"
SKU_KEY = "_sku"
STOCK_KEY = "_stock_status"
OUT_OF_STOCK = "outofstock"
IN_STOCK = "instock"
THUMBNAIL_KEY = "_thumbnail_id"
FILE_KEY = "_wp_attached_file"
UPLOADS_PATH = "/wp-content/uploads/"

CATEGORY_TAXONOMY = "product_cat"
TAG_TAXONOMY = "product_tag"
EXPORTED_TAGS = ["buynow", "30days"]
DEFAULT_CATEGORY = "Uncategorized"
NO_PRICE = "0"
NAME_SEPARATOR = ", "

CATALOG_COLUMNS = [
    "product_id",
    "post_title",
    "slug",
    "short_description",
    "description",
    "image_url",
    "price",
    "sku",
    "category",
    "product_type",
    "tags",
]

CATALOG_BATCH = 5000
PREVIEW_ROWS = 10

# --- Fixed values: settings ------------------------------------------------------------

# Metadata keys that carry the table prefix of their side.
PREFIXED_USER_KEYS = ["capabilities", "user_level"]

TRANSIENT_PATTERNS = [
    "_transient_%",
    "_transient_timeout_%",
    "_site_transient_%",
    "_site_transient_timeout_%",
]
ANY_TRANSIENT_PATTERN = "%_transient_%"

# option_name -> (option_value, autoload), set when the wide tables become authoritative.
WIDE_TABLE_OPTIONS = {
    "woocommerce_custom_orders_table_enabled": ("yes", "yes"),
    "woocommerce_custom_orders_table_data_sync_enabled": ("yes", "yes"),
    "woocommerce_feature_custom_order_tables_enabled": ("yes", "yes"),
    "woocommerce_cot_authoritative_source": ("cot", "yes"),
}

# --- Fixed values: validation thresholds -----------------------------------------------

MIN_USERS = 2
FULL_PERCENT = 95
PARTIAL_PERCENT = 80
MAX_ORDERS_WITHOUT_CUSTOMER = 100

# --- Fixed values: labels of the entity report -------------------------------------------

ENTITY_LABELS = ["Traditional Orders", "HPOS Orders", "Customers"]
