"""Sentence ends by statistics: a full stop behind an abbreviation or between digits ends nothing.

Which words are abbreviations is learnt from the texts alone, by how words and full stops go together
(Kiss and Strunk, "Unsupervised Multilingual Sentence Boundary Detection", 2006). A word is one if that
it always has a stop explains its occurrences much better than that it has one as often as any word,
the more so the shorter it is, and the less the more often it stands without.

Counting is a grouping by word, combined before the shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from eventpulse._session import rows_if_small, shared_folder
from eventpulse._skew import SALT, digest, salted
from eventpulse.functions.text import has_controls, longer_than_one, trim_blanks

# A word has a stop with this probability if it is an abbreviation.
ALWAYS = 0.99
THRESHOLD = 0.3
MIN_COUNT = 5
# Longer words are no abbreviations.
MAX_LETTERS = 20
# A list up to this length becomes part of one pattern.
PLAN_ABBREVIATIONS = 200

WORD = r"\p{L}+\.?"


def stop_counts(posts: DataFrame, text: str = "text") -> DataFrame:
    """``word, n, n_stop`` per run of letters in lower case: how often it occurs, and how often with a
    full stop right behind it."""
    words = posts.select(F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0))).alias("w"))
    stop = F.endswith(F.col("w"), F.lit("."))
    word = F.lower(F.rtrim(F.col("w"), F.lit(".")))
    return words.select(word.alias("word"), stop.alias("_stop")).groupBy("word").agg(
        F.count("*").alias("n"), F.count_if("_stop").alias("n_stop")
    )


def _log_likelihood(hits: Column, n: Column, p: Column) -> Column:
    return hits * F.log(p) + (n - hits) * F.log(1 - p)


def abbreviations(
    counts: DataFrame, *, threshold: float = THRESHOLD, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, score`` of the words of :func:`stop_counts` that are abbreviations.

    Words seen with a stop fewer than ``min_count`` times are none: there is too little to tell from.
    """
    # Counted once: the share and the ratings both look at it.
    spark, folder = counts.sparkSession, shared_folder(counts.sparkSession, "stop-counts")
    counts.where(F.col("word").isNotNull()).select("word", "n", "n_stop").write.parquet(folder)
    known = spark.read.schema("word string, n bigint, n_stop bigint").parquet(folder)
    share = known.agg((F.sum("n_stop") / F.sum("n")).alias("_share"))
    # Away from the ends, where every stop, or none, would be explained already.
    p = F.least(F.greatest("_share", F.lit(1e-6)), F.lit(ALWAYS - 1e-6))
    ratio = 2 * (
        _log_likelihood(F.col("n_stop"), F.col("n"), F.lit(ALWAYS))
        - _log_likelihood(F.col("n_stop"), F.col("n"), p)
    )
    length = F.length("word")
    # As a logarithm, for words that very often stand without a stop.
    weight = -length - (F.col("n") - F.col("n_stop")) * F.log(F.greatest(length, F.lit(2)))
    able = (F.col("n_stop") >= min_count) & (length <= MAX_LETTERS) & (ratio > 0)
    rated = known.crossJoin(F.broadcast(share)).where(able)
    return rated.select("word", F.exp(F.log(ratio) + weight).alias("score")).where(
        F.col("score") >= threshold
    )


def ends_pattern(words: list[str]) -> str:
    """What parts sentences, given the abbreviations in lower case: runs of ``.!?`` and line ends, but
    for stops behind one of these words or between digits."""
    return _pattern("|".join(map(re.escape, sorted(words))))


def _pattern(listed: str) -> str:
    # Looked at behind a stop only: in front of one, it would be tried at every character.
    behind = rf"(?<!(?<!\p{{L}})(?iu:{listed})\.)" if listed else ""
    return rf"(?:\.{behind}(?!(?<=[0-9]\.)[0-9])|[!?\n])+"


def split_by_statistics(
    posts: DataFrame, abbreviated: DataFrame, *, text: str = "text", short_too: bool = False,
    max_words: int = PLAN_ABBREVIATIONS,
) -> DataFrame:
    """As :func:`eventpulse.operators.sentiment.split_sentences`, with the abbreviations ``word``.

    A short list becomes one pattern. Of a longer one, each distinct text gets those that it holds.
    """
    others = [c for c in posts.columns if c != text]
    rows = rows_if_small(abbreviated.select("word").distinct(), max_words)
    column = F.col(f"`{text}`")
    if rows is not None:
        pieces, marked = F.split(column, ends_pattern([r.word for r in rows]), -1), posts
    else:
        marked = _with_own(posts, abbreviated, text)
        # Letters only, so that nothing has to be quoted.
        listed = F.array_join(F.array_sort("_own"), "|")
        before, after = _pattern("@").split("@")
        ends = F.when(F.size("_own") > 0, F.concat(F.lit(before), listed, F.lit(after))).otherwise(
            F.lit(ends_pattern([]))
        )
        pieces = F.split(column, ends, F.lit(-1))
    marked = marked.withColumn("_controls", has_controls(text))
    cut = marked.select(*others, "_controls", F.posexplode(pieces).alias("pos", "_p"))
    found = cut.select(*others, "pos", trim_blanks("_p", F.col("_controls")).alias("sentence"))
    return found.where(F.col("sentence") != "" if short_too else longer_than_one("sentence"))


def _with_own(posts: DataFrame, abbreviated: DataFrame, text: str, salts: int = 16) -> DataFrame:
    """The posts with ``_own``, the abbreviations that stand before a stop in their text."""
    texts = posts.select(F.col(f"`{text}`").alias("_text")).where("_text IS NOT NULL").distinct()
    stopped = F.regexp_extract_all("_text", F.lit(r"(\p{L}+)\."), F.lit(1))
    words = texts.select(
        digest("_text").alias("_digest"),
        F.explode(F.array_distinct(F.transform(stopped, F.lower))).alias("word"),
    )
    left, right = salted(words, abbreviated.select("word").distinct(), salts)
    own = left.join(right, ["word", SALT]).groupBy("_digest").agg(F.collect_set("word").alias("_own"))
    # On another form of the digest than was grouped by, so that the join can be split.
    keyed = posts.withColumn("_hex", F.hex(digest(text)))
    own = own.select(F.hex("_digest").alias("_hex"), "_own")
    none = F.array().cast("array<string>")
    return keyed.join(own, "_hex", "left").withColumn("_own", F.coalesce("_own", none)).drop("_hex")
