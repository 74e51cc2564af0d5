"""Event-window text analytics on Spark.

Posts with a millisecond timestamp are assigned to named windows, flagged by a
filter list, split into sentences, classified and reported per window; tags are
counted and weighted for a cloud. Everything takes and gives DataFrames.
"""

from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.operators.as_of import assign_as_of
from eventpulse.operators.classifier import classify, fit_negative, precision_recall
from eventpulse.operators.instances import classify_documents, classify_sentences, fit_sentences
from eventpulse.operators.sentiment import (
    keep_windows_with_any, negatives, negatives_per_window, score_sentences, split_sentences,
    windows_with_any,
)
from eventpulse.operators.sentence_ends import abbreviations, split_by_statistics, stop_counts
from eventpulse.operators.tags import (
    cloud_weights, merge_counts, tag_counts, tags_in_both, tags_only_in, tags_with_counterpart,
    top_tags,
)
from eventpulse.operators.terms import drop_copies, flag_posts, matched_timestamps
from eventpulse.operators.windows import (
    WindowTable, assign_from_table, calendar_table, count_per_window, window_name, with_bucket,
    with_window_name,
)
from eventpulse.plans.jobs import run_cloud, run_flagged_cloud, run_report
from eventpulse.plans.report import (
    flagged_in_windows, flagged_tag_cloud, flagged_tag_counts, report, report_lines,
    scored_in_windows, tag_cloud, window_report,
)
from eventpulse.sources.readers import (
    posts_of_tweets, read_lines, read_posts, read_tag_counts, read_terms, read_tweets,
)

__all__ = [
    "TOURNAMENT", "Calendar", "abbreviations", "split_by_statistics", "stop_counts", "WindowTable", "assign_as_of", "assign_from_table", "calendar_table", "classify",
    "classify_documents", "classify_sentences", "cloud_weights", "count_per_window", "drop_copies",
    "fit_negative", "fit_sentences", "flag_posts", "flagged_in_windows",
    "flagged_tag_cloud", "flagged_tag_counts", "keep_windows_with_any", "matched_timestamps",
    "merge_counts", "negatives", "negatives_per_window", "posts_of_tweets", "precision_recall",
    "read_lines", "read_posts", "read_tag_counts", "read_terms", "read_tweets", "report",
    "report_lines", "run_cloud", "run_flagged_cloud", "run_report", "score_sentences",
    "scored_in_windows", "split_sentences", "tag_cloud", "tag_counts", "tags_in_both",
    "tags_only_in", "tags_with_counterpart", "top_tags", "window_name", "window_report",
    "windows_with_any", "with_bucket", "with_window_name",
]
