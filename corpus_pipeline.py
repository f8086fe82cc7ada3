"""From raw documents to token ids in five stages, each written and read again before the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from almanac.llm import bpe, langid, mixing, pii, quality, simhash
from almanac.llm.common import cleared, dropped, fold, shared, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: The JVM of an executor still holds memory of the stages before, so the last one remembers less than it would alone.
REMEMBER = 30_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents that no language's model accepts go."""
    return langid.accepted_only(docs, langid.train(docs, usable=fold("doc_id", 3) != 1))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document of least id stays of each group; repeated rows of it go."""
    return simhash.deduplicated(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: found spans are replaced by their kind."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights; documents weigh by their quality, as the labels of sf_dir mark it."""
    return mixing.mixed_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: (id, ids, decoded) per document."""
    return bpe.encode_documents(docs, public_tokenizers.path(VOCABULARY), remember=REMEMBER)


STAGES = [("language_id", known_language), ("simhash_dedup", one_of_each), ("pii", without_personal_data), ("mixing", mixed), ("bpe", encoded)]

#: Models, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a Parquet table in the session's shared folder,
    which goes when the next stage has written its own, as do the work tables within a stage when it has written its rows;
    the last stage's table stays, as the result reads it.

    Null and empty texts, which have no language, go in the first stage, rows without an id stay as they are in the second,
    and no documents give no rows. All columns of documents pass through the first four stages, whatever their names.
    """
    docs, where, before = table(spark, sf_dir, "documents"), f"{shared(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        cleared(spark)
        if before:
            dropped(spark, before)
        before = f"{where}/{name}"
    return docs
