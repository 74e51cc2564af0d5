"""The composite jobs: window report, tag cloud, cloud of flagged tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.functions.share import percent_half_up
from eventpulse.functions.time import event_millis
from eventpulse.operators.sentiment import (
    NEGATIVE, Lexicon, compile_lexicon, score_sentences, split_sentences,
)
from eventpulse.operators.tags import FONT_HIGH, FONT_LOW, cloud_weights, tag_counts
from eventpulse.operators.terms import (
    LIKE, PER_POST, TermSet, compile_terms, drop_copies, flag_posts,
)
from eventpulse.operators.windows import (
    HALF_OPEN, AnyCalendar, bucket_sql, name_table, with_bucket,
)

# Fixed value: the line format of the report.
REPORT_LINE = (
    "%s\t hate tweets:%d\t sentiment hate tweets: %d\t all tweets:%d\t Prozentual: %d"
)


def report(
    posts: DataFrame,
    flagged: DataFrame,
    scored: DataFrame,
    calendar: AnyCalendar = TOURNAMENT,
) -> DataFrame:
    """One row per bucket of the calendar: all, flagged, negative, share flagged.

    All three inputs carry ``bucket``; ``scored`` has sentences, not posts. The
    calendar joins the union as rows of zeros, so a single aggregation counts
    and fills at once: no joins, and at most one row per bucket and task shuffled.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def counting(table: DataFrame, all_: Column, flag: Column, negative: Column) -> DataFrame:
        return table.select(
            "bucket", all_.alias("all_posts"), flag.alias("flagged_posts"),
            negative.alias("negative_sentences"),
        )

    rows = counting(posts, one, zero, zero)
    for part in (
        counting(flagged, zero, one, zero),
        counting(scored.where(F.col("sentiment") <= NEGATIVE), zero, zero, one),
    ):
        rows = rows.unionByName(part)
    return _summed(rows, calendar)


def tally(
    posts: DataFrame,
    terms: TermSet,
    calendar: Calendar = TOURNAMENT,
    *,
    bounds: str = HALF_OPEN,
) -> DataFrame:
    """All posts and the distinct flagged ones in one pass: ``all_bucket, bucket, text,
    timestamp_ms, n``.

    A flagged post keeps text and time, so its copies become one row; all others
    of a bucket become one row with null for both. ``bucket`` is null where the
    time is unusable or the post not flagged; ``all_bucket``, under ``bounds``, never is.
    """
    timed = posts.select("text", "timestamp_ms", event_millis("timestamp_ms").alias("_millis"))
    found = timed.withColumn("_found", F.coalesce(terms.found_in("text"), F.lit(False)))
    flagged, usable = F.col("_found"), F.col("_millis").isNotNull()
    keys = found.select(
        F.expr(bucket_sql(calendar, "_millis", bounds)).alias("all_bucket"),
        F.when(flagged & usable, F.expr(bucket_sql(calendar, "_millis"))).alias("bucket"),
        F.when(flagged, F.col("text")).alias("text"),
        F.when(flagged, F.col("timestamp_ms")).alias("timestamp_ms"),
    )
    return keys.groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("n"))


def tally_of_parts(posts: DataFrame, flagged: DataFrame) -> DataFrame:
    """A :func:`tally` from bucketed posts and the flagged ones without copies, for lists and
    calendars of any size: counts of all posts, beside flagged posts that count none."""
    nothing = F.lit(None).cast("string")
    counts = posts.groupBy(F.col("bucket").alias("all_bucket")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.select(
        "all_bucket", F.lit(None).cast("int").alias("bucket"), nothing.alias("text"),
        F.lit(None).cast(flagged.schema["timestamp_ms"].dataType).alias("timestamp_ms"), "n",
    )
    hits = flagged.select(
        F.col("bucket").alias("all_bucket"), "bucket", "text", "timestamp_ms",
        F.lit(0).cast("bigint").alias("n"),
    )
    return totals.unionByName(hits)


def report_of_tally(
    tallied: DataFrame, lexicon: Lexicon, calendar: AnyCalendar = TOURNAMENT
) -> DataFrame:
    """The report from a :func:`tally`, row by row up to the sums per bucket."""
    zero = F.lit(0).cast("bigint")
    hit = F.col("bucket").isNotNull()
    negative = F.when(hit, lexicon.negatives_in("text")).otherwise(0).cast("bigint")
    counted = tallied.select(
        "all_bucket", "bucket", "n", hit.cast("int").cast("bigint").alias("_flag"),
        negative.alias("_negative"),
    )
    # With open bounds the two buckets of a row may differ, so each row is counted under both.
    in_all = F.struct(
        F.col("all_bucket").alias("bucket"), F.col("n").alias("all_posts"),
        zero.alias("flagged_posts"), zero.alias("negative_sentences"),
    )
    in_flagged = F.struct(
        "bucket", zero.alias("all_posts"), F.col("_flag").alias("flagged_posts"),
        F.col("_negative").alias("negative_sentences"),
    )
    rows = counted.select(F.inline(F.array(in_all, in_flagged))).where("bucket is not null")
    return _summed(rows, calendar)


def report_of_sums(totals: DataFrame, hits: DataFrame, calendar: AnyCalendar = TOURNAMENT) -> DataFrame:
    """The report from sums per bucket: ``all_posts``, and ``flagged_posts, negative_sentences``."""
    zero = F.lit(0).cast("bigint")
    rows = totals.select(
        "bucket", "all_posts", zero.alias("flagged_posts"), zero.alias("negative_sentences")
    ).unionByName(hits.select("bucket", zero.alias("all_posts"), "flagged_posts", "negative_sentences"))
    return _summed(rows, calendar)


def _summed(rows: DataFrame, calendar: AnyCalendar) -> DataFrame:
    """Sums per bucket of ``all_posts, flagged_posts, negative_sentences``, with name and share."""
    zero = F.lit(0).cast("bigint")
    empty = name_table(rows.sparkSession, calendar).select(
        "bucket", zero.alias("all_posts"), zero.alias("flagged_posts"),
        zero.alias("negative_sentences"), "name",
    )
    rows = rows.withColumn("name", F.lit(None).cast("string"))
    sums = empty.unionByName(rows).groupBy("bucket").agg(
        F.max("name").alias("name"),
        F.sum("flagged_posts").alias("flagged_posts"),
        F.sum("negative_sentences").alias("negative_sentences"),
        F.sum("all_posts").alias("all_posts"),
    )
    return sums.select(
        "bucket",
        "name",
        "flagged_posts",
        "negative_sentences",
        "all_posts",
        percent_half_up("flagged_posts", "all_posts").alias("percent"),
    ).orderBy("bucket")


def report_lines(table: DataFrame) -> DataFrame:
    """The report as text, ``(bucket, line)``."""
    line = F.format_string(
        REPORT_LINE, "name", "flagged_posts", "negative_sentences", "all_posts", "percent"
    )
    return table.select("bucket", line.alias("line")).orderBy("bucket")


def flagged_in_windows(
    posts: DataFrame, terms: DataFrame, calendar: AnyCalendar = TOURNAMENT, *, mode: str = LIKE
) -> DataFrame:
    """Flagged posts without copies and without unusable times: ``text, timestamp_ms, bucket``."""
    flagged = drop_copies(flag_posts(posts, terms, mode=mode))
    return with_bucket(flagged, calendar, drop_bad_time=True)


def scored_in_windows(flagged: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Sentences of flagged posts with ``score``, ``sentiment`` and ``bucket``."""
    return score_sentences(split_sentences(flagged, short_too=True), lexicon)


def window_report(
    posts: DataFrame,
    terms: DataFrame,
    lexicon: DataFrame,
    calendar: AnyCalendar = TOURNAMENT,
    *,
    mode: str = LIKE,
    bounds: str = HALF_OPEN,
    one_pass: bool = False,
) -> DataFrame:
    """The whole main job as one lazy plan, from posts to the report.

    Of a columnar source the totals read the time alone; the text is read once,
    as both uses of the flagged posts share the shuffle that drops the copies.
    Where every reading of the posts is costly, as they are JSON or come out of a
    join, ``one_pass`` goes through a :func:`tally`: one scan, one grouping that
    counts all posts and drops the copies, and sentences rated where it ends. A
    filter list, word list or calendar too large for a plan is done in two all the same.
    ``bounds="open"`` applies to the totals only.
    """
    if one_pass and isinstance(calendar, Calendar):
        compiled, rated = compile_terms(terms, mode=mode), compile_lexicon(lexicon)
        if compiled is not None and rated is not None:
            tallied = tally(posts, compiled, calendar, bounds=bounds)
            return report_of_tally(tallied, rated, calendar)
    flagged = flagged_in_windows(posts, terms, calendar, mode=mode)
    return report(
        with_bucket(posts, calendar, bounds=bounds),
        flagged,
        scored_in_windows(flagged, lexicon),
        calendar,
    )


def tag_cloud(
    posts: DataFrame, low: float = FONT_LOW, high: float = FONT_HIGH
) -> DataFrame:
    """Weights of the tags of all posts."""
    return cloud_weights(tag_counts(posts), low, high)


def flagged_tag_counts(
    posts: DataFrame, terms: DataFrame, *, multiplicity: str = PER_POST, mode: str = LIKE
) -> DataFrame:
    """Tag counts of flagged posts; with ``per_term`` a post counts once per matching term."""
    flagged = flag_posts(posts, terms, multiplicity=multiplicity, mode=mode)
    return tag_counts(flagged)


def flagged_tag_cloud(
    posts: DataFrame,
    terms: DataFrame,
    low: float = FONT_LOW,
    high: float = FONT_HIGH,
    *,
    multiplicity: str = PER_POST,
    mode: str = LIKE,
) -> DataFrame:
    """Weights of the tags of the flagged posts."""
    counts = flagged_tag_counts(posts, terms, multiplicity=multiplicity, mode=mode)
    return cloud_weights(counts, low, high)
