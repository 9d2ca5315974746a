"""The derived store tables as SQL common table expressions."""

from __future__ import annotations

import re

from . import store_rules as rules


def _project(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {name}' for name, e in columns.items())} FROM {source}"


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _postmeta() -> str:
    return _union(
        f"SELECT ({owner}) * 100 + {k} AS meta_id, {owner} AS post_id, '{key}' AS meta_key, "
        f"{value} AS meta_value FROM {table} WHERE {present}"
        for table, owner, keys in rules.POSTMETA_FROM
        for k, key, value, present in keys
    )


DATED_PART = "part LEFT JOIN orders ON o_orderkey = p_partkey"

TABLES = {
    "src_users": _union(_project(rules.USERS_FROM[t], t) for t in ("customer", "supplier")),
    "dst_users": (
        f"SELECT * REPLACE ({rules.DST_LOGIN} AS user_login) FROM src_users "
        f"WHERE {rules.DST_USER_PRESENT} UNION ALL " + _project(rules.USERS_FROM["nation"], "nation")
    ),
    "src_usermeta": _union(
        f"SELECT CAST(id * 10 + {k} AS BIGINT) AS umeta_id, id AS user_id, '{key}' AS meta_key, "
        f"{value} AS meta_value FROM src_users"
        for k, key, value in rules.USER_META
    ),
    "dst_usermeta": (
        f"SELECT umeta_id, user_id, {rules.DST_META_KEY} AS meta_key, meta_value FROM src_usermeta "
        f"WHERE {rules.DST_USERMETA_PRESENT} UNION ALL " + _project(rules.STAFF_META, "nation")
    ),
    "src_posts": _union(
        [
            _project(rules.POSTS_FROM_ORDERS, "orders"),
            _project(
                rules.POSTS_FROM_PART, f"{DATED_PART} LEFT JOIN documents ON doc_id = p_partkey"
            ),
            _project(rules.POSTS_FROM_IMAGE, DATED_PART),
        ]
    ),
    "dst_posts": (
        f"SELECT * REPLACE ({rules.DST_POST_STATUS} AS post_status) FROM src_posts "
        f"WHERE {rules.DST_POST_PRESENT}"
    ),
    "src_postmeta": _postmeta(),
    "dst_postmeta": "SELECT * FROM src_postmeta WHERE post_id IN (SELECT id FROM dst_posts)",
    "src_order_items": _project(
        rules.ITEMS,
        f"(SELECT {', '.join(rules.ITEM_KEYS)}, "
        + ", ".join(f"{e} AS {name}" for name, e in rules.ITEM_AGGREGATES.items())
        + f" FROM lineitem GROUP BY {', '.join(rules.ITEM_KEYS)}) AS grouped_lines",
    ),
    "dst_order_items": "SELECT * FROM src_order_items WHERE order_id IN (SELECT id FROM dst_posts)",
    "src_order_itemmeta": _union(
        f"SELECT CAST(order_item_id * 10 + {k} AS BIGINT) AS meta_id, order_item_id, "
        f"'{key}' AS meta_key, {value} AS meta_value FROM src_order_items"
        for k, key, value in rules.ITEM_META
    ),
    "dst_order_itemmeta": (
        "SELECT * FROM src_order_itemmeta "
        "WHERE order_item_id IN (SELECT order_item_id FROM dst_order_items)"
    ),
    "terms": _union(
        [f"SELECT CAST({i} AS BIGINT) AS term_id, '{name}' AS name" for i, name in rules.FIXED_TERMS]
        + [f"SELECT DISTINCT 100 + {rules.BRAND} AS term_id, p_brand AS name FROM part"]
    ),
    "term_taxonomy": _project(rules.TERM_TAXONOMY, "terms"),
    "term_relationships": _union(
        f"SELECT {rules.RELATIONSHIP_OBJECT} AS object_id, {term} AS term_taxonomy_id "
        f"FROM part WHERE {present}"
        for term, present in rules.RELATIONSHIPS
    ),
    "dst_options": _union(
        [_project(columns, table) for table, columns in rules.OPTIONS_FROM.items()]
        + [
            "SELECT CAST({} AS BIGINT) AS option_id, '{}' AS option_name, '{}' AS option_value, "
            "'{}' AS autoload".format(*rules.FIXED_OPTION)
        ]
    ),
}

_NAMES = re.compile(r"\b(" + "|".join(TABLES) + r")\b")


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the tables that ``sql`` names, and those they need, in front of it.

    ``extra`` adds named steps of the query itself, in order.
    """
    extra = extra or {}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name not in needed:
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    for step in [*extra.values(), sql]:
        visit(step)
    steps = [f"{name} AS ({TABLES[name]})" for name in needed]
    steps += [f"{name} AS ({step})" for name, step in extra.items()]
    return f"WITH {', '.join(steps)} {sql}" if steps else sql
