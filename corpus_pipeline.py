"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it kept and returns the columns of
``documents``; the last returns packed pieces. Between stages the documents are written to the
shared folder, so that a lost executor costs one stage at most. A stage begins by deleting what
earlier ones left there, but for what its documents are read from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpulse.llm import language_id
from eventpulse.llm._common import (
    broadcast_if_small, col, discard_scratch, free_name, leave_scratch, numbered, saved,
)
from eventpulse.llm.line_dedup import delete_repeated_runs
from eventpulse.llm.packing import pack_documents
from eventpulse.llm.secret_scan import redact_secrets
from eventpulse.llm.simhash import near_duplicates


# Numbers of the rows that stay are broadcast up to this many (8 bytes each), and shuffled beyond.
BROADCAST_ROWS = 1_000_000


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model fitted on the labelled ones does not reject.

    A document without a letter, or whose text is null, is rejected.
    """
    leave_scratch()  # what was written before the pipeline is not its own
    return language_id.keep_recognised(language_id.fit(docs), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines are deleted; a document left without any text goes."""
    discard_scratch(docs)
    runs = free_name(docs, "deleted_runs")
    cleaned = delete_repeated_runs(docs, runs_column=runs)
    emptied = (F.size(col(runs)) > 0) & ~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    return _measured(cleaned.where(~emptied).drop(runs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, the document of the smallest id stays; one row exactly if ids repeat."""
    discard_scratch(docs)
    number = free_name(docs, "row_no")
    rows = saved(numbered(docs, number), "rows")
    # Ordered as the ids, with null last, and distinct for every row.
    place = F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
        col(number).alias("row_no"),
    )
    groups = near_duplicates(
        rows.select(place.alias("place"), "text"), shingle=4, radius=4, id_column="place"
    )
    first = groups.where("doc_id = component_id").select(F.col("doc_id.row_no").alias("_first"))
    first = broadcast_if_small(saved(first, "first"), BROADCAST_ROWS)
    return rows.join(first, col(number) == F.col("_first"), "left_semi").drop(number)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; no document goes."""
    return _measured(redact_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences; a row per piece of a document."""
    discard_scratch(docs)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("secret_scan", hide_secrets),
    ("best_fit_packing", pack),
]

# No stage but line dedup can be expressed in SQL; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
