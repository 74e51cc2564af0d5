"""Writing posts, flagged text, counts and the report.

Every writer replaces what was there, so a rerun does not double a result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.functions.text import word_array
from eventpulse.operators.sentiment import sentiment_label
from eventpulse.operators.windows import with_window_name
from eventpulse.plans.report import report_lines

# Fixed value: records per file when input is cut into chunks.
CHUNK_RECORDS = 10000


def write_json(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    table.write.mode(mode).json(path)


def write_chunks(
    table: DataFrame, path: str, *, records: int = CHUNK_RECORDS, format: str = "json",
    mode: str = "overwrite",
) -> None:
    """Rewrite a table as files of at most ``records`` records."""
    table.write.mode(mode).option("maxRecordsPerFile", records).format(format).save(path)


def write_tag_counts(counts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``count:tag`` lines without a header."""
    counts.select("n", "tag").write.mode(mode).option("sep", ":").csv(path)


def write_timestamps(timestamps: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-column table of :func:`matched_timestamps` with its header."""
    timestamps.write.mode(mode).option("header", True).csv(path)


def write_by_window(
    flagged: DataFrame, path: str, *, text: str = "text", format: str = "text",
    mode: str = "overwrite",
) -> None:
    """Flagged text routed to one folder per ``bucket``; an empty window has none.

    ``rebalance`` gathers each bucket into few files and lets adaptive execution
    split a bucket that is larger than the rest, instead of one task per bucket.
    The text format has one post per line and writes a line break as ``\\n``.
    """
    table = flagged
    if format == "text":
        one_line = F.replace(F.replace(F.col(text), F.lit("\r"), F.lit(r"\r")), F.lit("\n"), F.lit(r"\n"))
        table = flagged.select(one_line.alias("value"), "bucket")
    _partitioned(table, "bucket").mode(mode).format(format).save(path)


def write_negatives(
    negative: DataFrame, path: str, calendar: Calendar = TOURNAMENT, mode: str = "overwrite"
) -> None:
    """Negative sentences as text, one folder per window name."""
    named = negative if "name" in negative.columns else with_window_name(negative, calendar)
    _partitioned(named.select("sentence", "name"), "name").mode(mode).text(path)


def write_annotated(scored: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sentences with their labels as annotated text, one folder per ``bucket``."""
    value = F.format_string(
        "Sentence #%d (%d tokens, sentiment: %s):\n%s", F.col("pos") + 1,
        F.size(word_array("sentence")), sentiment_label("sentiment"), F.col("sentence"),
    )
    _partitioned(scored.select(value.alias("value"), "bucket"), "bucket").mode(mode).text(path)


def write_report(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The report as text in order of the windows: one file, or several that follow each other where
    the calendar is so large that one task should not write it."""
    report_lines(table).select("line").write.mode(mode).text(path)


def show_top(counts: DataFrame, k: int = 100) -> None:
    """Print the k most frequent tags."""
    counts.orderBy(F.desc("n"), "tag").show(k, truncate=False)


def _partitioned(table: DataFrame, column: str):
    return table.hint("rebalance", column).write.partitionBy(column)
