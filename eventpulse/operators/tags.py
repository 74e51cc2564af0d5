"""Counting tags, merging counts, weights for a tag cloud."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventpulse._columns import ColumnOrName, as_column
from eventpulse.functions.share import linear_scale

# Rows shown of the count table, and the font sizes of the cloud.
TOP_TAGS = 100
FONT_LOW = 20
FONT_HIGH = 50


def has_tags(tags: ColumnOrName) -> Column:
    """The list exists and its first tag is not empty; later tags are not looked at."""
    c = as_column(tags)
    return c.isNotNull() & (F.get(c, F.lit(0)) > "")


def tag_counts(posts: DataFrame, tags: str = "tags") -> DataFrame:
    """How often each ``tag`` occurs (``n``). Hot tags are combined before the shuffle."""
    exploded = posts.where(has_tags(tags)).select(F.explode(tags).alias("tag"))
    return exploded.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*tables: DataFrame) -> DataFrame:
    """Sum of several count tables ``(tag, n)``; a tag may be in any of them."""
    rows = tables[0].select("tag", "n")
    for table in tables[1:]:
        rows = rows.unionByName(table.select("tag", "n"))
    return rows.groupBy("tag").agg(F.sum("n").alias("n"))


def tags_only_in(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` whose tag is not in ``old``."""
    return new.join(old, "tag", "left_anti")


def tags_in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tags of both tables with the sum of their counts."""
    joined = left.alias("l").join(right.alias("r"), "tag", "inner")
    return joined.select("tag", (F.col("l.n") + F.col("r.n")).alias("n"))


def tags_with_counterpart(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every tag of ``left`` with its count in ``right``, null where it has none."""
    joined = left.alias("l").join(right.alias("r"), "tag", "left")
    return joined.select("tag", F.col("l.n").alias("n"), F.col("r.n").alias("n_right"))


def top_tags(counts: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """The k most frequent tags, ties in order of the tag."""
    return counts.orderBy(F.desc("n"), "tag").limit(k)


def cloud_weights(
    counts: DataFrame, low: float = FONT_LOW, high: float = FONT_HIGH
) -> DataFrame:
    """Font size ``weight`` of every tag, linear in the count.

    The bounds of the scale are one row, which every task gets.
    """
    bounds = counts.agg(F.min("n").alias("_min"), F.max("n").alias("_max"))
    weight = linear_scale(F.col("n"), F.col("_min"), F.col("_max"), low, high)
    return counts.crossJoin(F.broadcast(bounds)).select(*counts.columns, weight.alias("weight"))
