"""Corpus pipeline: from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import language_id, secrets
from plumbline.llm.exact_dedup import exact_dedup
from plumbline.llm.near_dedup import near_dedup
from plumbline.llm.packing import pack
from plumbline.llm.shared import prepare, read, shared_folder

#: a text whose best language scores less is in none of the learned languages
MIN_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; ``und`` and unsure ones go.  All stay where nothing is labelled."""
    prepare(spark)
    net = language_id.fit(docs)
    if net is None:
        return docs
    judged = language_id.predict_languages(docs, net)
    return judged.filter((F.col("lang_pred") != language_id.UNDECIDED) & (F.col("score") >= MIN_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    prepare(spark)
    return exact_dedup(docs, keep="largest").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return near_dedup(docs).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    prepare(spark)
    return secrets.redact(docs, secrets.fit(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    prepare(spark)
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express the trained stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
