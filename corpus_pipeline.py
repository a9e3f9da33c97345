"""A corpus pipeline over ``documents``: five stages, each one of the operators in ``relkit.llm``.

language ID (rows without an identified language go; ``lang`` becomes the
identified one) -> near-duplicates (one document of each group stays) ->
benchmark decontamination (documents that hold a test item go) -> secret scan
(secrets in texts are replaced) -> packing into sequences of 2048 tokens, each
of documents of one identified language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relkit.llm import decontaminate, language, near_dedup, packing, secrets
from relkit.llm.queries import byte_bpe
from relkit.llm.util import prepare, stored
from relkit.sources.tables import Tables


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, Tables(spark, sf_dir).benchmark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact_secrets(docs)
    if "n_chars" not in clean.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, byte_bpe(), capacity=2048, closing=0, by="lang")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    prepare(spark)
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language model and the packing plan have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None
