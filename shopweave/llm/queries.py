"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Workspace
from . import bpe, chat, collocations, embeddings, html_text, language, language_model, lexical_search, packing, quality, secrets, simhash, suffix_dedup
from .common import crc32_of, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def hexed(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), Workspace(spark))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(TOKENIZER).alias("both"))
    return docs.select(
        "doc_id",
        F.size("both.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("both.ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        hexed("both.decoded").alias("decoded_sha256"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out_", crc32_of("doc_id") % 3 == 1)
    learned = language.learn(docs.where(~F.col("held_out_")), Workspace(spark))
    scored = docs.select("doc_id", F.col("held_out_").alias("held_out"), language.predict(learned).alias("best"))
    return scored.select("doc_id", "held_out", "best.lang_pred", "best.score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", quality.repetition().alias("s"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return docs.select(
        "doc_id",
        *(f"s.{c}" for c in base),
        quality.base_failed("s").alias("base_failed"),
        quality.kept("s").alias("kept"),
        "s.dup_line_chars",
        *(f"s.{c}" for c in quality.COVERED),
    )


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, F.col("component").alias("component_id"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), Workspace(spark))
    counts = [f"cut_.{c}" for c in ("n_bytes", "n_removed", "n_spans")]
    left = F.make_valid_utf8(F.col("cut_.kept").cast("string")).alias("text")
    return docs.select("doc_id", *counts, hexed("cut_.kept").alias("kept_sha256"), left)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, Workspace(spark))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc32_of("doc_id") % 10 != 0).alias("training"))
    scored = language_model.score_documents(docs, "training", Workspace(spark))
    return scored.withColumn("training", ~F.col("training")).withColumnRenamed("training", "held_out")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages"), Workspace(spark))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", secrets.scan(F.col("text")).alias("found"))
    docs = docs.select("doc_id", F.col("found.base").alias("base"), secrets.with_added("found").alias("every"))
    base = F.col("base")
    return docs.select(
        "doc_id",
        *(secrets.count_of(base, k).alias(f"n_{k}") for k in secrets.KINDS[:3]),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("every")).alias("spans"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), Workspace(spark))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests are of whole conversations, so here a conversation's windows meet in one row."""
    said = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.expr("if(id = 0, 'user', 'assistant')").alias("role"), F.lit(said).alias("text")
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    windows = chat.windows(turns, Workspace(spark)).withColumn("turns", chat.read_back(F.col("formatted")))
    new = F.expr("slice(turns, repeated + 1, size(turns))")
    said = F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.size(new).alias("n"),
            F.array_join(said, "").alias("said"),
            F.array_join(chat.learned(F.col("formatted"), F.col("targets")), "").alias("learned"),
            F.length("formatted").alias("chars"),
        ).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))

    def total(name: str) -> Column:
        return F.aggregate(f"parts.{name}", F.lit(0).cast("long"), lambda x, y: x + y)

    learned = F.array_join("parts.learned", "")
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(F.array_join("parts.said", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
        F.size("parts").cast("long").alias("n_windows"),
    )


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, Workspace(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_bpe_encoding,
        op3_language_id,
        op4_quality_rules,
        op5_simhash_near_dedup,
        op6_suffix_array_dedup,
        op7_best_fit_packing,
        op8_lm_scoring,
        op9_html_extraction,
        op10_secret_scans,
        op11_phrase_collocations,
        op12_chat_formatting,
        op13_ranked_lexical_search,
    )
}
