"""From raw documents to token ids: five stages, each stored and read again.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir)
and returns a DataFrame; all but the last return the columns of documents. Each
stage works on all rows that the one before it kept.

Columns other than doc_id, text, lang and n_chars are kept as they are, whatever their
names; n_chars follows the text, if there is such a column. Rows with null doc_id pass the stages that drop documents by their id, as they
cannot be named; the first stage drops any row without letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, langid, neardup, passages
from eventloom.llm.common import fresh, stored
from eventloom.llm.queries import encoded, table
from eventloom.session import configure

#: Ids of dropped documents that may be sent to all tasks; more are joined by shuffle.
SENT_IDS = 1_000_000


def _drop(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the documents named in ``ids`` (dropped_id)."""
    name = fresh("dropped_id", docs)
    ids = stored(ids.where("dropped_id is not null").distinct(), "dropped")
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    ids = ids.withColumnRenamed("dropped_id", name)
    return docs.join(ids, F.col("doc_id") == F.col(name), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those whose language is not recognised."""
    return langid.recognised(docs)


def minhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near copies."""
    return _drop(docs, neardup.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("dropped_id")))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated paragraphs from all documents but the first that has them, and documents of nothing else."""
    cleaned = passages.remove_repeats(docs, passages.members(docs)).where(F.trim("text") != "")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of a benchmark item."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _drop(docs, found.select(F.col("doc_id").alias("dropped_id")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document under merge-dropout, and whether they decode to its text."""
    return encoded(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("minhash_neardup", minhash_neardup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
