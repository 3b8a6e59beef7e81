"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.decontaminate import find_leaks
from kiln.llm.extract import extract_text
from kiln.llm.language import fit_text_model, identify
from kiln.llm.lines import repeated_units
from kiln.llm.mixing import mix_sources, word_count
from kiln.llm.near_dups import near_duplicate_components
from kiln.llm.packing import pack_documents
from kiln.llm.phrases import mine_phrases
from kiln.llm.ring import assign_shards
from kiln.llm.simhash import COPY_RADIUS, document_fingerprints
from kiln.llm.simhash_dups import simhash_components
from kiln.llm.url_rules import host_of, judge_urls
from kiln.llm.vector_codes import vector_codes


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    docs = docs.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    return mix_sources(docs, F.col("words")).docs.select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: declared language ``lang``, the source in the place of the host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = fit_text_model(docs, F.col("text"), F.col("lang"))
    judged = identify(docs, F.col("text"), F.col("lang"), F.col("source"), model, carry=["doc_id", "lang", "source"])
    return judged.select("doc_id", F.col("lang").alias("declared"), "source", "text_language", "detected",
                         "posterior", "accepted")


def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: language declared in the markup, host and suffix from the address, text without markup."""
    pages = table(spark, sf_dir, "pages")
    declared = F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-zA-Z-]+)", 1), F.lit(""))
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")
    pages = pages.select("page_id", "url", declared.alias("declared"), plain.alias("plain"), host_of(F.col("url")).alias("host"))
    model = fit_text_model(pages, F.col("plain"), F.col("declared"))
    judged = identify(pages, F.col("plain"), F.col("declared"), F.col("host"), model,
                      carry=["page_id", "url", "host", "declared"])
    return judged.select("page_id", "url", "host", "declared", "text_language", "detected", "posterior", "accepted")


def op4_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_units(table(spark, sf_dir, "documents"))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = assign_shards(docs, "doc_id", "text", shards=16, keep_text=False)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"), radius=COPY_RADIUS)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the 2,000 best collocations of every language."""
    return mine_phrases(table(spark, sf_dir, "documents"))


def op12_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: fingerprint of the whole text and component of fingerprints within two bits."""
    return simhash_components(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings: eight-part codes of a ball k-means codebook, with exact integer errors."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_duplicates, op2_mix_sources, op3_language, op4_repeated_lines, op5_benchmark_leaks,
        op6_packed_tokens, op7_ring_shards, op8_url_rules, op9_main_text, op10_simhash,
        op11_phrases, op12_simhash_near_duplicates, op13_vector_codes, page_language)}
