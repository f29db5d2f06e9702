"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import decontamination, extraction, manifest, mixing, ngram_join, pii, quality, secrets, spelling, token_counts, tool_calls, topk, urls
from paylake.llm.common import table
from paylake.llm.oracle import SQL
from paylake.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = decontamination.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.drop("spans", "item_ids")


def op2_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    calls, results = tool_calls.from_turns(table(spark, d, "conversations"))
    return tool_calls.format_calls(calls, results, tool_calls.TURN_TOOLS)


def op3_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secrets.secrets(table(spark, d, "documents"))


def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


def op5_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.personal_data(table(spark, d, "documents"))


def op6_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), "vec_id % 50 = 0")


def op7_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, d, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_urls(spark: SparkSession, d: str) -> DataFrame:
    return urls.filtered(table(spark, d, "pages"))


def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).drop("source")


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.document_tokens(table(spark, d, "documents"))


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.spelling_variants(spelling.words(table(spark, d, "documents")))


def op12_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest.manifest(table(spark, d, "documents"))


def op13_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    found = extraction.main_text(pages, extraction.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def registered() -> dict[str, Query]:
    found = [
        op1_decontamination, op2_tool_calls, op3_secrets, op4_quality, op5_pii, op6_topk, op7_ngram_join, op8_urls, op9_mixing,
        op10_token_counts, op11_spelling_variants, op12_merkle_manifest,
        op13_html_extraction,
    ]

    def configured(query: Query) -> Query:
        return lambda spark, d: query(configure(spark), d)

    return {query.__name__: configured(query) for query in found}


def sql() -> dict[str, str]:
    return dict(SQL)
