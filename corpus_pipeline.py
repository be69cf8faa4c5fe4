"""A corpus pipeline over the documents table: toxicity, line dedup, near-dedup, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, with the columns of ``docs`` in all but the
last. Where a stage changes texts it recomputes ``n_chars``. Rows with a null ``doc_id`` are kept by the filtering
stages; of repeated rows that share a ``doc_id`` near-dedup keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolcat.llm.common import materialize, table
from toolcat.llm.line_dedup import remove_repeated
from toolcat.llm.packing import pack
from toolcat.llm.pii import redact
from toolcat.llm.simhash import simhash_keep
from toolcat.llm.toxicity import toxic_texts


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go. Null texts count as empty; equal texts share their
    fate, however long."""
    toxic = toxic_texts(docs, table(spark, sf_dir, "labels"))
    return docs.join(toxic, F.md5(F.coalesce("text", F.lit("")).cast("binary")) == toxic["digest"], "left_anti")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document holds are deleted; every document stays."""
    return _counted(remove_repeated(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity of 0.8) the document with the smallest id stays."""
    return simhash_keep(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind."""
    return _counted(redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 4096 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Learned scores, alignment and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
