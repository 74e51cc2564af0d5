"""The window report as a standing one: kept up to date as files arrive.

Nothing that was read is read again. Three parts go on from where they were: the number of posts per
window; the flagged posts, of which the state of the stream lets each text and time through once; and,
from the posts that come through, the flagged posts and negative sentences per window. Each part adds
what a batch brings to its sums, so a report is made of a few rows per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventpulse._session import shared_folder
from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.functions.time import event_millis
from eventpulse.operators.as_of import assign_as_of
from eventpulse.operators.sentiment import negatives_per_window
from eventpulse.operators.terms import LIKE
from eventpulse.operators.windows import HALF_OPEN, AnyCalendar, with_bucket
from eventpulse.plans.report import report_of_sums, scored_in_windows
from eventpulse.streaming.intake import run_flagged_distinct, run_sums

TOTALS = "bucket int, all_posts bigint"
HITS = "bucket int, flagged_posts bigint, negative_sentences bigint"


def run_window_report(
    posts: DataFrame,
    terms: DataFrame,
    lexicon: DataFrame,
    calendar: AnyCalendar = TOURNAMENT,
    root: str | None = None,
    *,
    mode: str = LIKE,
    bounds: str = HALF_OPEN,
) -> DataFrame:
    """The report over all files of a stream of ``text, timestamp_ms`` so far.

    Equals :func:`eventpulse.plans.report.window_report` of the same files, whatever the batches; lists and
    calendars may have any size. With the folder ``root`` of an earlier run it goes on from there.
    ``bounds`` applies to the totals only.
    """
    spark = posts.sparkSession
    root = root or shared_folder(spark, "report")

    def located(rows: DataFrame, kind: str) -> DataFrame:
        if isinstance(calendar, Calendar):
            return with_bucket(rows, calendar, bounds=kind)
        return assign_as_of(
            rows, calendar.windows, base_ms=calendar.base_ms, before=calendar.before,
            other=calendar.other, bounds=kind,
        )

    def totals(batch: DataFrame) -> DataFrame:
        times = batch.groupBy("timestamp_ms").agg(F.count(F.lit(1)).alias("all_posts"))
        return located(times, bounds)

    def hits(batch: DataFrame) -> DataFrame:
        usable = batch.where(event_millis("timestamp_ms").isNotNull())
        flagged = located(usable, HALF_OPEN)
        zero = F.lit(0).cast("bigint")
        counted = flagged.groupBy("bucket").agg(F.count(F.lit(1)).alias("flagged_posts"))
        negative = negatives_per_window(scored_in_windows(flagged, lexicon))
        return counted.withColumn("negative_sentences", zero).unionByName(
            negative.select("bucket", zero.alias("flagged_posts"), F.col("n").alias("negative_sentences"))
        )

    counted = run_sums(
        posts.select("timestamp_ms"), totals, TOTALS, f"{root}/totals", progress=f"{root}/totals-progress"
    )
    kept = run_flagged_distinct(
        posts.select("text", "timestamp_ms"), terms, f"{root}/flagged", mode=mode,
        progress=f"{root}/flagged-progress",
    )
    arriving = spark.readStream.schema(kept.schema).parquet(f"{root}/flagged")
    found = run_sums(arriving, hits, HITS, f"{root}/hits", progress=f"{root}/hits-progress")
    return report_of_sums(counted, found, calendar)
