"""Columns that the library needs of the store tables, and primary keys. Tables may hold more."""

from __future__ import annotations

SCHEMAS = {
    "users": "id BIGINT, user_login STRING, user_email STRING, display_name STRING",
    "usermeta": "umeta_id BIGINT, user_id BIGINT, meta_key STRING, meta_value STRING",
    "posts": (
        "id BIGINT, post_author BIGINT, post_type STRING, post_status STRING, post_title STRING, "
        "post_name STRING, post_excerpt STRING, post_content STRING, "
        "post_date TIMESTAMP_NTZ, post_date_gmt TIMESTAMP_NTZ, post_modified TIMESTAMP_NTZ, "
        "post_modified_gmt TIMESTAMP_NTZ, post_parent BIGINT"
    ),
    "postmeta": "meta_id BIGINT, post_id BIGINT, meta_key STRING, meta_value STRING",
    "order_items": "order_item_id BIGINT, order_id BIGINT, order_item_type STRING",
    "order_itemmeta": "meta_id BIGINT, order_item_id BIGINT, meta_key STRING, meta_value STRING",
    "terms": "term_id BIGINT, name STRING",
    "term_taxonomy": "term_taxonomy_id BIGINT, term_id BIGINT, taxonomy STRING",
    "term_relationships": "object_id BIGINT, term_taxonomy_id BIGINT",
    "options": "option_id BIGINT, option_name STRING, option_value STRING, autoload STRING",
    "status_backup": "order_id BIGINT, original_status STRING, backup_date TIMESTAMP_NTZ",
}

PRIMARY_KEYS = {
    "users": "id",
    "usermeta": "umeta_id",
    "posts": "id",
    "postmeta": "meta_id",
    "order_items": "order_item_id",
    "order_itemmeta": "meta_id",
}

STATUS_FEED = "id BIGINT, status STRING"
