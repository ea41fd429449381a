"""From raw documents to training sequences: five stages, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the session's shared folder and reads it again as the next
stage's documents, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm.decontamination import decontaminate
from shelfwise.llm.language import held_out, keep_identified
from shelfwise.llm.near_dedup import drop_near_duplicates
from shelfwise.llm.packing import pack
from shelfwise.llm.pii import pseudonymized
from shelfwise.llm.tables import removed
from shelfwise.session import ensure_checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, if they have it, of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language can be told, ``lang`` set to it; rows without a letter go."""
    return keep_identified(docs, docs.where(~held_out()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without passages of the benchmark; rows that are mostly benchmark go."""
    return _counted(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows with pseudonyms for personal data."""
    return _counted(pseudonymized(docs).drop("pii"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: Language identification and tokenisation are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    return run_stages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)


def run_stages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All stages over ``docs``; the rows of the last.

    A stage's folder goes when the next one is written, so that there are two
    at most; the last one stays, for whoever reads the result, until the
    shared folder is cleared.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    before = None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
