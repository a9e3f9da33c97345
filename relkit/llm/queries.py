"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Tables
from . import (byte_pairs, centroids, decontaminate, fingerprints, html, language, lexical, licenses, near_dedup, packing,
               secrets, token_counts, urls)

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Host names that put a page's URL on the query's list.
LISTED_HOSTS = r"(?i)(^|[.-])(adult|ads|bets|casino|cheap|pills|spam)([.-]|$)"


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan_secrets(Tables(spark, sf_dir).documents))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(Tables(spark, sf_dir).documents, byte_bpe(), limit=1024)


def document_path() -> Column:
    """Documents as files: one directory per source, one below it per language."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("_"))
    return F.concat_ws("/", part("source"), part("lang"), part("doc_id"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(Tables(spark, sf_dir).documents.select("doc_id", document_path().alias("path"), "text"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(Tables(spark, sf_dir).documents, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages
    return html.extract(pages, html.learn(pages))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return decontaminate.flag_documents(t.documents, t.benchmark)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    return language.identify(docs, language.learn(docs))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).pages.select("page_id", "url")
    listed = pages.where(urls.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return urls.judge_urls(pages, listed, RULES)


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(Tables(spark, sf_dir).documents, byte_bpe(), capacity=2048, closing=0)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.next_edits(Tables(spark, sf_dir).documents)


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_pairs.digests(Tables(spark, sf_dir).documents, ranks, public_tokenizers.PATTERN)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digests(*centroids.cluster(Tables(spark, sf_dir).embeddings))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return lexical.ranked_search(t.documents, t.benchmark)


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_token_counts, op3_license_scan, op4_near_duplicates, op5_main_text, op6_decontaminate,
    op7_language, op8_url_filter, op9_pack, op10_fingerprints, op11_byte_pairs, op12_centroids, op13_ranked_search)}

ORACLES: dict[str, str] = {"op12_centroids": centroids.oracle(), "op13_ranked_search": lexical.ORACLE}
