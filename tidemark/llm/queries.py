"""The registered queries of the operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, cotrain, langid, packing, toxicity
from tidemark.llm.conv_repair import repaired
from tidemark.llm.conv_trie import prefix_trie
from tidemark.llm.embedding_dedup import near_duplicates
from tidemark.llm.html_density import extract
from tidemark.llm.jaccard_join import JaccardParams, jaccard_components
from tidemark.llm.line_runs import drop_lines
from tidemark.llm.quality_rules import quality
from tidemark.llm.shared import read_table
from tidemark.llm.url_lists import filter_urls, page_captures, page_list


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = packing.JsonCodec(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(read_table(spark, sf_dir, "documents"), codec)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    out = filter_urls(page_captures(pages), page_list(pages)).withColumnRenamed("id", "page_id")
    return out.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "valid_from")})


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(read_table(spark, sf_dir, "documents"), codec)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), JaccardParams(words=4, num=85, den=100))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return cotrain.score(docs, cotrain.fit(docs, labels))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "_lines.n_lines", "_lines.n_dropped",
                      F.sha2("_lines.kept_text", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_filters": op5_url_filters,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_html_extraction": op11_html_extraction,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_conversation_repair": op13_conversation_repair,
}
