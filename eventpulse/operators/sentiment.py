"""Sentences and their sentiment.

The sentiment of a sentence is a class from 0 (very negative) to 4 (very
positive). It comes from a weighted word list, or from a classifier fitted with
:mod:`eventpulse.operators.classifier`.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventpulse._columns import ColumnOrName, as_column
from eventpulse._session import rows_if_small
from eventpulse._skew import SALT, digest, salted
from eventpulse.calendars import TOURNAMENT
from eventpulse.functions.text import (
    SENTENCE_END, has_controls, longer_than_one, sentence_array, sql_list, sql_string, trim_blanks,
    word_array, words_sql,
)
from eventpulse.operators.windows import AnyCalendar, with_window_name

LABELS = ("very negative", "negative", "neutral", "positive", "very positive")
NEGATIVE = 1  # classes up to this one are negative

# A word list of at most this many tokens is written into the plan.
# Hit windows up to this number become a filter.
MAX_PLAN_WINDOWS = 1_000
MAX_PLAN_TOKENS = 10_000
# Each different weight is a comparison per word.
MAX_PLAN_WEIGHTS = 32


def split_sentences(
    posts: DataFrame, *, text: str = "text", short_too: bool = False
) -> DataFrame:
    """One row per sentence: the other columns, ``pos`` in the text and ``sentence``.

    Blank pieces are dropped; so are those of one character, unless ``short_too``.
    """
    others = [c for c in posts.columns if c != text]
    # Looked up once per text, below the explode; beside it, it would run per sentence.
    marked = posts.withColumn("_controls", has_controls(text))
    cut = marked.select(*others, "_controls", F.posexplode(sentence_array(text)).alias("pos", "_p"))
    trimmed = trim_blanks("_p", F.col("_controls")).alias("sentence")
    pieces = cut.select(*others, "pos", trimmed)
    return pieces.where(F.col("sentence") != "" if short_too else longer_than_one("sentence"))


@dataclass(frozen=True)
class Lexicon:
    """A weighted word list that is written into the plan: tokens by weight."""

    tokens: dict[int, tuple[str, ...]]

    @staticmethod
    def of(weights: dict[str, int]) -> Lexicon:
        by_weight: dict[int, list[str]] = defaultdict(list)
        for token, weight in sorted(weights.items()):
            if weight:
                by_weight[weight].append(token)
        return Lexicon({w: tuple(t) for w, t in sorted(by_weight.items())})

    def rate(self, sentence: str) -> Column:
        """Struct of ``score``, the sum of the weights of all words, and ``sentiment``.

        The class is made where the sum ends, so both cost one pass over the words.
        """
        finish = f"named_struct('score', total, 'sentiment', {sentiment_sql('total')})"
        return F.expr(self._sum_sql(sentence, finish))

    def negatives_in(self, text: str) -> Column:
        """Number of negative sentences in a text, null for a null text.

        As many as :func:`split_sentences` with ``short_too`` and :meth:`rate`
        find, without a row per sentence: what a trim takes off holds no words,
        and a blank piece is neutral.
        """
        sentences = f"split(`{text}`, {sql_string(SENTENCE_END)}, -1)"
        negative = f"{self._sum_sql('s', sentiment_sql('total'))} <= {NEGATIVE}"
        return F.when(
            F.col(f"`{text}`").isNotNull(), F.expr(f"size(filter({sentences}, s -> {negative}))")
        )

    def _sum_sql(self, sentence: str, finish: str) -> str:
        """SQL text of ``finish``, an expression of the ``total`` of all word weights."""
        weight = "CASE" + "".join(
            f" WHEN w IN {sql_list(tokens)} THEN {weight}L" for weight, tokens in self.tokens.items()
        ) + " ELSE 0L END" if self.tokens else "0L"
        return (
            f"aggregate({words_sql(sentence)}, 0L, (total, w) -> total + {weight}, "
            f"total -> {finish})"
        )


def compile_lexicon(
    lexicon: DataFrame, *, max_tokens: int = MAX_PLAN_TOKENS
) -> Lexicon | None:
    """The word list ``(token, weight)`` as a :class:`Lexicon`, or None beyond the bound."""
    rows = rows_if_small(lexicon.select("token", "weight"), max_tokens)
    if rows is None:
        return None
    weights: dict[str, int] = defaultdict(int)
    for row in rows:
        if row.token is not None and row.weight is not None:
            weights[row.token] += row.weight
    if len(set(weights.values())) > MAX_PLAN_WEIGHTS:
        return None
    return Lexicon.of(weights)


def sentiment_sql(score: str) -> str:
    """SQL text of the class of a score."""
    return (
        f"CASE WHEN {score} <= -4 THEN 0 WHEN {score} < 0 THEN 1 WHEN {score} = 0 THEN 2 "
        f"WHEN {score} < 4 THEN 3 ELSE 4 END"
    )


def sentiment_label(sentiment: ColumnOrName) -> Column:
    return F.get(F.array(*[F.lit(n) for n in LABELS]), as_column(sentiment))


def score_sentences(
    sentences: DataFrame, lexicon: DataFrame, *, max_tokens: int = MAX_PLAN_TOKENS
) -> DataFrame:
    """Add ``score`` and ``sentiment`` (0..4) to every sentence.

    Scored row by row inside the scan, so nothing is shuffled. Only a word list
    beyond the bound is joined to the words of the distinct sentences instead.
    """
    compiled = compile_lexicon(lexicon, max_tokens=max_tokens)
    if compiled is None:
        scored = _score_by_join(sentences, lexicon)
        return scored.withColumn("sentiment", F.expr(sentiment_sql("score")))
    rated = sentences.withColumn("_rate", compiled.rate("sentence"))
    return rated.select(*sentences.columns, "_rate.score", "_rate.sentiment")


def negatives(scored: DataFrame, calendar: AnyCalendar = TOURNAMENT) -> DataFrame:
    """Negative sentences worth writing out, with the name of their window."""
    found = scored.where((F.col("sentiment") <= NEGATIVE) & longer_than_one("sentence"))
    return with_window_name(found, calendar)


def negatives_per_window(scored: DataFrame) -> DataFrame:
    """Number ``n`` of negative sentences per ``bucket``, those of one character included."""
    found = scored.where(F.col("sentiment") <= NEGATIVE)
    return found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def windows_with_any(scored: DataFrame, calendar: AnyCalendar = TOURNAMENT) -> DataFrame:
    """Windows with at least one negative sentence: ``bucket, name, sentences, negatives``."""
    marked = scored.select("bucket", (F.col("sentiment") <= NEGATIVE).alias("_negative"))
    per_window = marked.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sentences"),
        F.count_if("_negative").alias("negatives"),
        F.bool_or("_negative").alias("_any"),
    )
    return with_window_name(per_window.where("_any").drop("_any"), calendar).select(
        "bucket", "name", "sentences", "negatives"
    )


def keep_windows_with_any(
    scored: DataFrame, calendar: AnyCalendar | None = TOURNAMENT, *, max_windows: int = MAX_PLAN_WINDOWS
) -> DataFrame:
    """All sentences of the windows that have a negative one.

    The list of hit windows is read with a bound on its length and becomes a filter, so that the
    sentences are not shuffled. A longer one, of a window table, is joined.
    """
    hit = scored.where(F.col("sentiment") <= NEGATIVE).select("bucket").distinct()
    rows = rows_if_small(hit.where("bucket IS NOT NULL"), max_windows)
    if rows is None:
        return scored.join(hit, "bucket", "left_semi")
    return scored.where(F.col("bucket").isin([r.bucket for r in rows]))


def _score_by_join(sentences: DataFrame, lexicon: DataFrame, salts: int = 16) -> DataFrame:
    """Scores for a word list of any size.

    The score depends on the sentence alone, so copies are scored once. Words
    are counted per sentence before the join, which is salted, as a few of them
    are in nearly every sentence. Adaptive execution splits a hot sentence when
    the scores are joined back.
    """
    texts = sentences.select(F.col("sentence").alias("_sentence")).distinct()
    words = texts.select(
        digest("_sentence").alias("_digest"), F.explode(word_array("_sentence")).alias("token")
    )
    counted = words.groupBy("_digest", "token").agg(F.count(F.lit(1)).alias("_times"))
    left, right = salted(counted, lexicon.select("token", "weight"), salts)
    sums = (
        left.join(right, ["token", SALT]).groupBy("_digest")
        .agg(F.sum(F.col("_times") * F.col("weight")).alias("_sum"))
    )
    # Joined on another form of the digest than was grouped by: otherwise the join
    # would reuse the partitions of the grouping, and those cannot be split.
    keyed = sentences.withColumn("_key", F.hex(digest("sentence")))
    sums = sums.select(F.hex("_digest").alias("_key"), "_sum")
    score = F.coalesce(F.col("_sum"), F.lit(0).cast("bigint")).alias("score")
    return keyed.join(sums, "_key", "left").select(*sentences.columns, score)
