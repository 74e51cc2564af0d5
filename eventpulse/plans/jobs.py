"""The three jobs from folders to folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.functions.time import event_millis
from eventpulse.operators.sentiment import compile_lexicon, negatives
from eventpulse.operators.tags import cloud_weights, tag_counts
from eventpulse.operators.terms import (
    PER_POST, compile_terms, drop_copies, flag_posts, matched_timestamps,
)
from eventpulse.operators.windows import AnyCalendar, with_bucket
from eventpulse.plans.report import (
    flagged_tag_counts, report, report_of_tally, scored_in_windows, tally, tally_of_parts,
)
from eventpulse.sources.readers import read_posts, read_tag_counts, read_terms
from eventpulse.sources.writers import (
    write_by_window, write_negatives, write_report, write_tag_counts, write_timestamps,
)


def run_report(
    spark: SparkSession,
    posts_path: str,
    terms_path: str,
    lexicon: DataFrame,
    out: str,
    calendar: AnyCalendar = TOURNAMENT,
) -> None:
    """Posts and filter list in; below ``out``: ``flagged``, ``times``, ``windows``,
    ``negatives`` and ``report``, and ``tally``, from which they are made.

    The tally holds counts per bucket and the flagged posts, a small part of the input. All
    outputs read that table, so a lost executor costs no second pass over the text. What is
    written does not depend on sizes: with a filter list or calendar beyond what fits into a plan,
    the tally is put together from two passes over the posts instead of one.
    """
    posts = read_posts(spark, posts_path)
    terms = read_terms(spark, terms_path)
    compiled, rated = compile_terms(terms), compile_lexicon(lexicon)
    if compiled is not None and isinstance(calendar, Calendar):
        tallied = tally(posts, compiled, calendar)
    else:
        hits = with_bucket(drop_copies(flag_posts(posts, terms)), calendar, drop_bad_time=False)
        usable = event_millis("timestamp_ms").isNotNull()
        hits = hits.withColumn("bucket", F.when(usable, F.col("bucket")))
        tallied = tally_of_parts(with_bucket(posts, calendar), hits)
    tallied.write.mode("overwrite").parquet(f"{out}/tally")
    tallied = spark.read.parquet(f"{out}/tally")
    kept = tallied.where("text is not null")
    kept.select("text", "timestamp_ms").write.mode("overwrite").parquet(f"{out}/flagged")
    write_timestamps(matched_timestamps(spark.read.parquet(f"{out}/flagged")), f"{out}/times")
    flagged = kept.where("bucket is not null").select("text", "timestamp_ms", "bucket")
    write_by_window(flagged, f"{out}/windows")
    scored = scored_in_windows(flagged, lexicon)
    write_negatives(negatives(scored, calendar), f"{out}/negatives")
    if rated is not None:
        table = report_of_tally(tallied, rated, calendar)
    else:
        table = report(with_bucket(posts, calendar), flagged, scored, calendar)
    write_report(table, f"{out}/report")


def run_cloud(spark: SparkSession, posts_path: str, out: str) -> DataFrame:
    """Tag counts of all posts to ``out/tags``; their weights to ``out/cloud``."""
    return _cloud(spark, tag_counts(read_posts(spark, posts_path)), out)


def run_flagged_cloud(
    spark: SparkSession,
    posts_path: str,
    terms_path: str,
    out: str,
    *,
    multiplicity: str = PER_POST,
) -> DataFrame:
    """As :func:`run_cloud` for the flagged posts."""
    posts, terms = read_posts(spark, posts_path), read_terms(spark, terms_path)
    return _cloud(spark, flagged_tag_counts(posts, terms, multiplicity=multiplicity), out)


def _cloud(spark: SparkSession, counts: DataFrame, out: str) -> DataFrame:
    write_tag_counts(counts, f"{out}/tags")
    weights = cloud_weights(read_tag_counts(spark, f"{out}/tags"))
    weights.write.mode("overwrite").parquet(f"{out}/cloud")
    return spark.read.parquet(f"{out}/cloud")
