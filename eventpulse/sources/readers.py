"""Reading posts, filter lists, text lines and tag counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from eventpulse.operators.windows import bucket_of_file
from eventpulse.schemas import TWEET


def read_tweets(spark: SparkSession, path: str, schema: StructType = TWEET) -> DataFrame:
    """JSON lines of one file or of a folder with all its sub-folders.

    A malformed line becomes a row of nulls, so it still counts as a post.
    """
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .json(path)
    )


def posts_of_tweets(
    tweets: DataFrame, *, other_text: str | Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``text, timestamp_ms, tags`` of nested tweets, plus the columns in ``keep``.

    Text and tags are those of the extended tweet; ``other_text`` is used for
    the text where there is none.
    """
    text = F.col("extended_tweet.full_text")
    if other_text is not None:
        other = F.col(other_text) if isinstance(other_text, str) else other_text
        text = F.coalesce(text, other)
    return tweets.select(
        text.alias("text"),
        "timestamp_ms",
        F.col("extended_tweet.entities.hashtags.text").alias("tags"),
        *keep,
    )


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts from JSON lines."""
    return posts_of_tweets(read_tweets(spark, path))


def read_terms(spark: SparkSession, path: str, column: str = "term") -> DataFrame:
    """A ``;``-separated list with a header; rows without a term are dropped.

    All columns stay text, so a term of digits keeps its leading zeros.
    """
    table = spark.read.option("sep", ";").option("header", True).csv(path)
    return table.where(F.col(f"`{column}`").isNotNull())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line, of all files of a folder."""
    return spark.read.option("recursiveFileLookup", True).text(path)


# Fixed value: how annotated text gives a sentence, its label in the line before it.
ANNOTATED = r"^\d+ \(\d+ tokens, sentiment: ([^)]*)\):\r?\n([^\n]*)"
ANNOTATED_START = "Sentence #"


def read_annotated(spark: SparkSession, path: str) -> DataFrame:
    """``bucket, label, sentence`` of annotated text: a header line with the label, then the
    sentence. Records without both are dropped.

    The bucket is that of the folder (``bucket=7``), or else the one the file is named after
    (``7.txt``), null where it is named otherwise.
    """
    records = spark.read.option("lineSep", ANNOTATED_START).text(path)
    own = bucket_of_file("_metadata.file_name")
    bucket = F.coalesce("bucket", own) if "bucket" in records.columns else own
    return records.where(F.col("value").rlike(ANNOTATED)).select(
        bucket.cast("int").alias("bucket"),
        F.regexp_extract("value", ANNOTATED, 1).alias("label"),
        F.trim(F.regexp_extract("value", ANNOTATED, 2)).alias("sentence"),
    )


def read_tag_counts(spark: SparkSession, path: str, *, broken_lines: bool = False) -> DataFrame:
    """``(tag, n)`` from ``count:tag`` lines; all part files are one table.

    With ``broken_lines``, quoted tags may hold line breaks; a file is then read by one task.
    """
    reader = spark.read.schema("n BIGINT, tag STRING").option("sep", ":")
    table = reader.option("multiLine", broken_lines).csv(path)
    return table.select("tag", "n")


def register_view(table: DataFrame, name: str) -> DataFrame:
    """Make a table available to ``spark.sql`` under a name."""
    table.createOrReplaceTempView(name)
    return table
