"""The corpus pipeline: documents through quality rules, deduplication, secret scans and packing.

Each stage is a function of (spark, docs, sf_dir) to a frame. All but the last return the columns of
their input: rejected documents and near-duplicates are gone, repeated strings are cut out, secrets are
masked, and ``n_chars`` follows the text. A document whose text is cut away stays as an empty text. Null
texts are empty to every stage; they fail the quality rules. Empty tables pass through as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopweave.llm import packing, quality, secrets, simhash, suffix_dedup
from shopweave.llm.common import bounded, key_of, table
from shopweave.llm.queries import TOKENIZER
from shopweave.session import Workspace

#: Least bytes of a string that repeats: what passages of some fifty words have at the least. Hashing a
#: quarter of it for anchors keeps their number near that of longer strings.
PASSAGE, ANCHOR_SHARE = 200, 0.25


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, so that no added column can clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def with_text(docs: DataFrame, row: DataFrame, text: Column) -> DataFrame:
    """The documents of a column ``row`` with a new text and its number of characters."""
    new = row.select("row", text.alias("text_"))
    changed = {"text": F.col("text_"), "n_chars": F.length("text_").cast("long")}
    return new.select(*(changed[c].alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    bounded(spark)
    measured = docs.select(whole_row(docs), quality.repetition().alias("stats"))
    return measured.where(quality.kept("stats")).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; of repeated rows one."""
    bounded(spark)
    workspace = Workspace(spark)
    key = F.struct(F.col("doc_id").alias("id"), key_of("text").alias("content"))
    keyed = docs.select(whole_row(docs), key.alias("key"), F.col("text"))
    found = simhash.near_duplicates(keyed, workspace, key="key")
    kept = found.where(F.col("key").eqNullSafe(F.col("component"))).groupBy("key").agg(F.count("*").alias("rows"))
    kept = workspace.keep(kept.select("key.id", "key.content", "rows"), "kept")
    rows = keyed.select("row", "key.id", "key.content").join(
        kept.select(F.col("id").alias("kept_id"), F.col("content").alias("kept_content"), "rows"),
        F.expr("content = kept_content AND id <=> kept_id"),
    )
    # only the few keys with more than one row need them together
    several = rows.where("rows > 1").dropDuplicates(["id", "content"])
    return rows.where("rows = 1").select("row").unionByName(several.select("row")).select("row.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of ``PASSAGE`` bytes and more that repeat."""
    bounded(spark)
    texts = docs.select(whole_row(docs), F.col("text"))
    cut = suffix_dedup.deduplicate(texts, Workspace(spark), "text", PASSAGE, True, ANCHOR_SHARE)
    text = F.when(F.col("text").isNotNull(), F.col("cut_.kept").cast("string"))
    return with_text(docs, cut, text)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    found = docs.select(whole_row(docs), F.col("text"), secrets.scan(F.col("text")).alias("found"))
    spans = found.select("row", "text", secrets.with_added("found").alias("spans"))
    return with_text(docs, spans, secrets.redacted(F.col("text"), F.col("spans")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences."""
    bounded(spark)
    return packing.pack_documents(docs, TOKENIZER, Workspace(spark))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
#: Fingerprints and token ids can't be had from SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written to the shared folder and read again."""
    workspace, docs = Workspace(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = workspace.keep(stage(spark, docs, sf_dir), name)
    return docs
