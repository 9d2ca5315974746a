"""The derived store tables as Spark DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keysets import only_keys
from ..plans.store import Store
from ..sources.snapshots import snapshot_tables
from ..sources.tables import scan_table
from . import store_rules as rules

KEYS_PER_SCAN = 12


class Side:
    """The tables of one side. Each frame is built when first asked for: plans cost time too."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._builders:
            raise AttributeError(name)
        frame = self._builders[name]()
        setattr(self, name, frame)
        return frame

    def names(self) -> list[str]:
        return list(self._builders)

    def store(self) -> Store:
        return Store(**{name: getattr(self, name) for name in self._builders})


class DerivedStore:
    """Both sides of the store, derived lazily from the driver tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._scans: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        """A driver table; its files are looked at once."""
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]

    def src(self) -> Side:
        return Side(
            {
                "users": self.src_users,
                "usermeta": self.src_usermeta,
                "posts": self.src_posts,
                "postmeta": self.src_postmeta,
                "order_items": self.src_items,
                "order_itemmeta": lambda: self.itemmeta(self.src_items()),
                **self._shared(),
            }
        )

    def dst(self) -> Side:
        return Side(
            {
                "users": self.dst_users,
                "usermeta": self.dst_usermeta,
                "posts": self.dst_posts,
                "postmeta": self.dst_postmeta,
                "order_items": self.dst_items,
                "order_itemmeta": lambda: self.itemmeta(self.dst_items()),
                **self._shared(),
            }
        )

    def _shared(self) -> dict:
        return {
            "options": self.dst_options,
            "terms": self.terms,
            "term_taxonomy": self.term_taxonomy,
            "term_relationships": self.term_relationships,
        }

    # --- source side -------------------------------------------------------------------

    def src_users(self) -> DataFrame:
        return self._users("customer").unionByName(self._users("supplier"))

    def src_usermeta(self) -> DataFrame:
        entries = _array(
            f"named_struct('k', {k}, 'meta_key', '{key}', 'meta_value', {value})"
            for k, key, value in rules.USER_META
        )
        return (
            self.src_users()
            .selectExpr("id AS user_id", f"inline({entries})")
            .selectExpr(
                "CAST(user_id * 10 + k AS BIGINT) AS umeta_id", "user_id", "meta_key", "meta_value"
            )
        )

    def src_posts(self) -> DataFrame:
        orders = self.driver("orders")
        dated_part = self.driver("part").join(
            orders.select("o_orderkey", "o_orderdate"),
            F.col("p_partkey") == F.col("o_orderkey"),
            "left",
        )
        described = dated_part.join(
            self.driver("documents").select("doc_id", "text"),
            F.col("p_partkey") == F.col("doc_id"),
            "left",
        )
        return _union(
            _project(orders, rules.POSTS_FROM_ORDERS),
            _project(described, rules.POSTS_FROM_PART),
            _project(dated_part, rules.POSTS_FROM_IMAGE),
        )

    def src_postmeta(self) -> DataFrame:
        # A few keys per scan: one projection over all keys is too large a method to be compiled.
        return _union(
            *(
                self._postmeta(table, owner, keys[first : first + KEYS_PER_SCAN])
                for table, owner, keys in rules.POSTMETA_FROM
                for first in range(0, len(keys), KEYS_PER_SCAN)
            )
        )

    def src_items(self) -> DataFrame:
        grouped = (
            self.driver("lineitem")
            .groupBy(*rules.ITEM_KEYS)
            .agg(*(F.expr(e).alias(name) for name, e in rules.ITEM_AGGREGATES.items()))
        )
        return _project(grouped, rules.ITEMS)

    def itemmeta(self, items: DataFrame) -> DataFrame:
        entries = _array(
            f"named_struct('k', {k}, 'meta_key', '{key}', 'meta_value', {value})"
            for k, key, value in rules.ITEM_META
        )
        return items.selectExpr("order_item_id", f"inline({entries})").selectExpr(
            "CAST(order_item_id * 10 + k AS BIGINT) AS meta_id",
            "order_item_id",
            "meta_key",
            "meta_value",
        )

    # --- destination side --------------------------------------------------------------

    def dst_users(self) -> DataFrame:
        shared = self.src_users().where(rules.DST_USER_PRESENT)
        return shared.withColumn("user_login", F.expr(rules.DST_LOGIN)).unionByName(
            self._users("nation")
        )

    def dst_usermeta(self) -> DataFrame:
        shared = self.src_usermeta().where(rules.DST_USERMETA_PRESENT)
        return shared.withColumn("meta_key", F.expr(rules.DST_META_KEY)).unionByName(
            _project(self.driver("nation"), rules.STAFF_META)
        )

    def dst_posts(self) -> DataFrame:
        return (
            self.src_posts()
            .where(rules.DST_POST_PRESENT)
            .withColumn("post_status", F.expr(rules.DST_POST_STATUS))
        )

    def dst_postmeta(self) -> DataFrame:
        return self._with_dst_post(self.src_postmeta(), "post_id")

    def dst_items(self) -> DataFrame:
        return self._with_dst_post(self.src_items(), "order_id")

    def _with_dst_post(self, frame: DataFrame, column: str) -> DataFrame:
        known = self.dst_posts().select(F.col("id").alias(column))
        return only_keys(frame, known, column)

    def dst_options(self) -> DataFrame:
        names = ["option_id", "option_name", "option_value", "autoload"]
        fixed = self._literal_rows([rules.FIXED_OPTION], names)
        derived = [
            _project(self.driver(table), columns) for table, columns in rules.OPTIONS_FROM.items()
        ]
        return _union(*derived, fixed).select(*names)

    # --- taxonomy ----------------------------------------------------------------------

    def terms(self) -> DataFrame:
        fixed = self._literal_rows(rules.FIXED_TERMS, ["term_id", "name"])
        brands = (
            self.driver("part")
            .select("p_brand")
            .distinct()
            .selectExpr(f"100 + {rules.BRAND} AS term_id", "p_brand AS name")
        )
        return fixed.unionByName(brands)

    def term_taxonomy(self) -> DataFrame:
        return _project(self.terms(), rules.TERM_TAXONOMY)

    def term_relationships(self) -> DataFrame:
        entries = _array(
            f"CASE WHEN {present} THEN {term} END" for term, present in rules.RELATIONSHIPS
        )
        return (
            self.driver("part")
            .selectExpr(
                f"{rules.RELATIONSHIP_OBJECT} AS object_id", f"explode({entries}) AS term_taxonomy_id"
            )
            .where("term_taxonomy_id IS NOT NULL")
        )

    # --- helpers -----------------------------------------------------------------------

    def _literal_rows(self, rows: list[tuple], names: list[str]) -> DataFrame:
        values = ", ".join(
            "(" + ", ".join(f"{v}L" if isinstance(v, int) else f"'{v}'" for v in row) + ")"
            for row in rows
        )
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS fixed({', '.join(names)})")

    def _users(self, table: str) -> DataFrame:
        return _project(self.driver(table), rules.USERS_FROM[table])

    def _postmeta(self, table: str, owner: str, keys: list) -> DataFrame:
        entries = _array(
            f"CASE WHEN {present} THEN named_struct('k', {k}, 'meta_key', '{key}', "
            f"'meta_value', {value}) END"
            for k, key, value, present in keys
        )
        return (
            self.driver(table)
            .selectExpr(f"{owner} AS post_id", f"explode({entries}) AS entry")
            .where("entry IS NOT NULL")
            .selectExpr(
                "CAST(post_id * 100 + entry.k AS BIGINT) AS meta_id",
                "post_id",
                "entry.meta_key AS meta_key",
                "entry.meta_value AS meta_value",
            )
        )


class StoredStore:
    """The same two sides, written once as Parquet tables and scanned from there."""

    def __init__(self, spark: SparkSession, derived: DerivedStore, root: str):
        self.spark = spark
        self.root = root
        self._names = derived.src().names()
        for name, side in (("src", derived.src()), ("dst", derived.dst())):
            snapshot_tables(side.store(), root, name, codec="zstd")

    def src(self) -> Side:
        return self._side("src")

    def dst(self) -> Side:
        return self._side("dst")

    def _side(self, side: str) -> Side:
        return Side(
            {name: partial(scan_table, self.spark, self.root, side, name) for name in self._names}
        )


def _array(parts) -> str:
    return f"array({', '.join(parts)})"


def _project(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    return frame.selectExpr(*(f"{e} AS {name}" for name, e in columns.items()))


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
