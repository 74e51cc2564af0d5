"""Queries over the driver tables, and the SQL they are checked against.

``documents`` are the posts; the event with five times the id of a document
gives it its time. There are no tags in the texts, so all words of a text stand
for them. The calendar is moved so that the events fall into it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import eventpulse as ep
from eventpulse._session import shared_folder
from eventpulse.functions.time import millis_of_ntz
from eventpulse.operators.terms import PER_TERM
from eventpulse.operators.windows import OPEN
from eventpulse.sources.count_table import merge_batches
from eventpulse.sources.readers import (
    posts_of_tweets, read_annotated, read_lines, read_posts, read_tag_counts, read_terms, read_tweets,
    register_view,
)
from eventpulse.sources.writers import (
    write_annotated, write_by_window, write_chunks, write_json, write_negatives, write_tag_counts,
)
from eventpulse.streaming.consume import Intake
from eventpulse.streaming.intake import (
    flag_stream, run_counts, run_counts_by_table, run_flagged, run_flagged_distinct, run_to_parquet,
    running_counts, stream_files,
)
from eventpulse.streaming.standing import run_window_report

BASE_MS = 1704133800000  # 2024-01-01 18:30 UTC
CALENDAR = ep.TOURNAMENT.at(BASE_MS)

INSULTS = (
    "trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser", "stupid",
    "disgusting",
)
TERMS = INSULTS + ("of the", "on the")
WILD_TERMS = ("st_pid", "wor%less", "of t_e", "idiot", "mor_n")
INNER_LETTERS = "abdfghkmpz"
LEXICON = {**{w: -2 for w in INSULTS}, "the": 1, "with": 1, "and": 1}


# ---- inputs -------------------------------------------------------------------

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_words(text: str) -> Column:
    """The words that stand for tags."""
    return F.split(text, " ", -1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as posts without a time."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"), "text", all_words("text").alias("tags")
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", millis_of_ntz("ts").alias("timestamp_ms")
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the time of their event; the tags, larger than the text, are cut behind the join."""
    docs, times = documents(spark, sf_dir).select("post_id", "text"), event_times(spark, sf_dir)
    joined = docs.join(times, F.col("event_id") == F.col("post_id") * 5, "left")
    return joined.select("post_id", "text", "timestamp_ms", all_words("text").alias("tags"))


# A file that arrives has at most so many posts.
FILE_RECORDS = 10_000


def arriving_files(spark: SparkSession, sf_dir: str, least: int) -> tuple[int, int]:
    """How many posts a file is to hold so that there are ``least`` files or more, none larger than a
    task should read, and about how many files that gives."""
    rows = table(spark, sf_dir, "documents").count()
    records = max(min(FILE_RECORDS, -(-rows // least)), 1)
    return records, max(-(-rows // records), least)


def conversation_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select(all_words("text").alias("tags"))
    return ep.tag_counts(talks)


def terms(spark: SparkSession, values: tuple[str, ...] = TERMS) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias("term"))


def lexicon(spark: SparkSession) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(t), F.lit(w)) for t, w in LEXICON.items()])
    return spark.range(1).select(F.inline(entries).alias("token", "weight"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.flagged_in_windows(posts(spark, sf_dir), terms(spark), CALENDAR)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.scored_in_windows(flagged(spark, sf_dir), lexicon(spark))


# ---- queries ------------------------------------------------------------------

def posts_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.count_per_window(event_times(spark, sf_dir), CALENDAR).orderBy("bucket")


def posts_per_window_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = event_times(spark, sf_dir)
    return ep.count_per_window(times, CALENDAR, bounds=OPEN).orderBy("bucket")


def events_per_window_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = ep.calendar_table(spark, CALENDAR).where(F.col("bucket") < CALENDAR.before)
    assigned = ep.assign_from_table(
        event_times(spark, sf_dir), windows, base_ms=BASE_MS,
        before=CALENDAR.before, other=CALENDAR.other,
    )
    return assigned.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def events_per_window_by_table_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as if the window table were too large for a broadcast."""
    windows = ep.calendar_table(spark, CALENDAR).where(F.col("bucket") < CALENDAR.before)
    assigned = ep.assign_from_table(
        event_times(spark, sf_dir), windows, base_ms=BASE_MS,
        before=CALENDAR.before, other=CALENDAR.other, max_broadcast_cells=0,
    )
    return assigned.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def window_table(spark: SparkSession) -> ep.WindowTable:
    windows = ep.calendar_table(spark, CALENDAR).where(F.col("bucket") < CALENDAR.before)
    return ep.WindowTable.of(windows, BASE_MS)


def events_per_window_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and events merged in order of time."""
    calendar = window_table(spark)
    assigned = ep.assign_as_of(
        event_times(spark, sf_dir), calendar.windows, base_ms=BASE_MS, before=CALENDAR.before,
        other=CALENDAR.other,
    )
    return assigned.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def flag_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.drop_copies(ep.flag_posts(posts(spark, sf_dir), terms(spark)))


def flag_posts_per_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ep.flag_posts(posts(spark, sf_dir), terms(spark), multiplicity=PER_TERM)
    return pairs.select("post_id", "text", "timestamp_ms", "term")


def flag_posts_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ep.flag_posts(
        documents(spark, sf_dir), terms(spark, WILD_TERMS), multiplicity=PER_TERM
    )
    return pairs.select("post_id", "term")


def flag_posts_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter list that grows with the data: every word of the conversations."""
    words = table(spark, sf_dir, "conversations").select(
        F.explode(F.split("text", " ")).alias("term")
    ).distinct()
    pairs = ep.flag_posts(
        documents(spark, sf_dir).select("post_id", "text"), words, multiplicity=PER_TERM,
        mode="literal",
    )
    return pairs.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_terms"))


def conversation_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of wildcard terms that grows with the data: longer words, one letter left open."""
    words = table(spark, sf_dir, "conversations").select(F.explode(F.split("text", " ")).alias("w"))
    plain = words.where(F.col("w").rlike("^[A-Za-z]{4,}$")).distinct()
    return plain.select(F.expr("concat(left(w, 1), '_', substring(w, 3))").alias("term")).distinct()


def flag_posts_wildcards_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ep.flag_posts(
        documents(spark, sf_dir).select("post_id", "text"), conversation_wildcards(spark, sf_dir),
        multiplicity=PER_TERM,
    )
    return pairs.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_terms"))


def inner_wildcards(spark: SparkSession) -> DataFrame:
    """A thousand terms with three letters anywhere inside."""
    letter = lambda i: F.substr(F.lit(INNER_LETTERS), i.cast("int") + 1, F.lit(1))
    digits = [F.floor(F.col("id") / 10**k) % 10 for k in (2, 1, 0)]
    return spark.range(10**3).select(
        F.concat(F.lit("%"), *[letter(d) for d in digits], F.lit("%")).alias("term")
    )


def flag_posts_inner_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ep.flag_posts(
        documents(spark, sf_dir).select("post_id", "text"), inner_wildcards(spark),
        multiplicity=PER_TERM,
    )
    return pairs.select("post_id", "term")


def flagged_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = ep.drop_copies(ep.flag_posts(posts(spark, sf_dir), terms(spark)))
    return ep.count_per_window(flags, CALENDAR, drop_bad_time=True)


def flagged_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.matched_timestamps(flag_posts(spark, sf_dir))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.split_sentences(documents(spark, sf_dir).select("post_id", "text"))


def sentence_stop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each word occurs, and with a full stop behind it."""
    return ep.stop_counts(documents(spark, sf_dir))


def sentences_by_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that do not end behind what these statistics say are abbreviations."""
    found = ep.abbreviations(sentence_stop_counts(spark, sf_dir))
    return ep.split_by_statistics(documents(spark, sf_dir).select("post_id", "text"), found)


def sentence_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.score_sentences(sentences(spark, sf_dir), lexicon(spark)).select(
        "post_id", "pos", "score", "sentiment"
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.select("doc_id", "text", F.col("toxic").alias("negative"))


def sentence_sentiment_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sentences classified by a model of words; SQL says which sentences those are."""
    model = ep.fit_negative(labelled(spark, sf_dir))
    return ep.classify(model, sentences(spark, sf_dir)).where(
        F.col("probability").between(0.0, 1.0) & F.col("sentiment").isin(1, 2)
    ).select("post_id", "pos")


def model_document_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a model of sentences, learnt from labels of documents, does on a held-out fifth of them."""
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    documents = labelled(spark, sf_dir)
    model = ep.fit_sentences(documents.where(~held))
    rest = documents.where(held)
    scored = ep.classify_documents(model, rest).join(rest.select("doc_id", "negative"), "doc_id")
    return ep.precision_recall(scored)


def windows_with_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.windows_with_any(scored(spark, sf_dir), CALENDAR)


def sentences_of_windows_with_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.keep_windows_with_any(scored(spark, sf_dir)).select(
        "bucket", "timestamp_ms", "pos", "sentence"
    )


def negative_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.negatives(scored(spark, sf_dir), CALENDAR).select("name", "sentence")


def negative_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.negatives_per_window(scored(spark, sf_dir))


def window_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.window_report(
        posts(spark, sf_dir), terms(spark), lexicon(spark), CALENDAR, one_pass=True
    )


def window_report_two_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.window_report(posts(spark, sf_dir), terms(spark), lexicon(spark), CALENDAR)


def window_report_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a calendar that is a table, and so may have any size."""
    windows = ep.calendar_table(spark, CALENDAR).where(F.col("bucket") < CALENDAR.before)
    calendar = ep.WindowTable.of(windows, BASE_MS)
    return ep.window_report(posts(spark, sf_dir), terms(spark), lexicon(spark), calendar)


def window_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.report_lines(window_report(spark, sf_dir))


def window_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User ids taken as bucket ids: the first 47 have a name."""
    ids = table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("bucket"))
    counted = ids.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return ep.with_window_name(counted, CALENDAR)


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.tag_counts(documents(spark, sf_dir))


def tag_counts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in four batches, each merged into the counts of those before it."""
    batches = [
        ep.tag_counts(documents(spark, sf_dir).where(F.pmod("post_id", F.lit(4)) == i)) for i in range(4)
    ]
    return merge_batches(spark, shared_folder(spark, "tag-counts"), batches, buckets=8)


def top_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.top_tags(tag_counts(spark, sf_dir))


def tag_counts_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.merge_counts(tag_counts(spark, sf_dir), conversation_tags(spark, sf_dir))


def tags_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.tags_only_in(conversation_tags(spark, sf_dir), tag_counts(spark, sf_dir))


def tags_in_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.tags_in_both(tag_counts(spark, sf_dir), conversation_tags(spark, sf_dir))


def tags_with_counterpart(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = ep.tags_with_counterpart(tag_counts(spark, sf_dir), conversation_tags(spark, sf_dir))
    return both.fillna(0, "n_right")


def flagged_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.flagged_tag_counts(documents(spark, sf_dir), terms(spark))


def flagged_tag_counts_per_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.flagged_tag_counts(documents(spark, sf_dir), terms(spark), multiplicity=PER_TERM)


def tag_cloud_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.tag_cloud(documents(spark, sf_dir))


def flagged_tag_cloud_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.flagged_tag_cloud(documents(spark, sf_dir), terms(spark))


def posts_per_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event counted as it streams in; the tables are read-only, so nothing is consumed."""
    schema = table(spark, sf_dir, "events").select("event_id", "ts").schema
    events = stream_files(spark, f"{sf_dir}/events*.parquet", schema, format="parquet")
    timed = events.select(millis_of_ntz("ts").alias("timestamp_ms"))
    return run_counts(running_counts(timed, CALENDAR))


def posts_per_window_stream_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a calendar that is a table, of any size."""
    schema = table(spark, sf_dir, "events").select("event_id", "ts").schema
    events = stream_files(spark, f"{sf_dir}/events*.parquet", schema, format="parquet")
    timed = events.select(millis_of_ntz("ts").alias("timestamp_ms"))
    return run_counts_by_table(timed, window_table(spark))


def flag_posts_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts in files that arrive one after the other, and all of them once more."""
    path, own = shared_folder(spark, "arriving"), posts(spark, sf_dir).select("text", "timestamp_ms")
    records, files = arriving_files(spark, sf_dir, least=2)
    for day in (1, 2):
        write_chunks(own, f"{path}/day={day}", records=records, format="parquet")
    arriving = stream_files(
        spark, f"{path}/day=*", own.schema, format="parquet", files_per_batch=files // 2
    )
    return run_flagged_distinct(arriving, terms(spark))


def window_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report kept up to date while the posts arrive in several files."""
    path, own = shared_folder(spark, "arriving"), posts(spark, sf_dir).select("text", "timestamp_ms")
    records, files = arriving_files(spark, sf_dir, least=4)
    write_chunks(own, path, records=records, format="parquet")
    arriving = stream_files(spark, path, own.schema, format="parquet", files_per_batch=files // 2)
    return run_window_report(arriving, terms(spark), lexicon(spark), CALENDAR)


def consumed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as JSON files that are read once, noted and deleted."""
    path, state = shared_folder(spark, "incoming"), shared_folder(spark, "intake")
    records, files = arriving_files(spark, sf_dir, least=4)
    write_chunks(tweets(spark, sf_dir), path, records=records)
    intake, read = Intake(spark, path, state), shared_folder(spark, "read")

    def keep(rows: DataFrame, batch: int) -> None:
        own = posts_of_tweets(rows).select("text", "timestamp_ms")
        own.write.mode("overwrite").parquet(intake.folder_of(read, batch))

    intake.run(keep, files_per_batch=files // 2)
    return intake.read(read, "text string, timestamp_ms string")


def flag_posts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "documents").select("doc_id", "text").schema
    arriving = stream_files(spark, f"{sf_dir}/documents*.parquet", schema, format="parquet")
    return run_to_parquet(flag_stream(arriving, terms(spark)))


def flag_posts_stream_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream and a list beyond what fits into a plan."""
    schema = table(spark, sf_dir, "documents").select("doc_id", "text").schema
    arriving = stream_files(spark, f"{sf_dir}/documents*.parquet", schema, format="parquet")
    return run_flagged(arriving, conversation_wildcards(spark, sf_dir)).select("doc_id")


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts in the nested shape in which they come as JSON."""
    hashtags = F.transform("tags", lambda t: F.struct(t.alias("text")))
    return posts(spark, sf_dir).select(
        F.col("timestamp_ms").cast("string").alias("timestamp_ms"),
        F.struct(
            F.col("text").alias("full_text"), F.struct(hashtags.alias("hashtags")).alias("entities")
        ).alias("extended_tweet"),
    )


def json_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "tweets")
    write_json(tweets(spark, sf_dir), path)
    return read_posts(spark, path)


def json_posts_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.drop_copies(ep.flag_posts(json_posts(spark, sf_dir), terms(spark)))


def json_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.tag_counts(json_posts(spark, sf_dir))


def chunks_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "chunks")
    write_chunks(tweets(spark, sf_dir), path, records=100)
    return posts_of_tweets(read_tweets(spark, path)).select("text", "timestamp_ms")


def routed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged posts in a folder per window, and read from there."""
    path = shared_folder(spark, "routed")
    write_by_window(flagged(spark, sf_dir), path)
    return spark.read.text(path).select("bucket", F.col("value").alias("line"))


def tag_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "tags")
    write_tag_counts(tag_counts(spark, sf_dir), path)
    return read_tag_counts(spark, path, broken_lines=True)


def annotated_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored sentences as annotated text, and the negative ones of it by their label."""
    path = shared_folder(spark, "annotated")
    write_annotated(scored(spark, sf_dir), path)
    read = read_annotated(spark, path).where(F.contains(F.lower("label"), F.lit("negative")))
    return read.select("bucket", "label", "sentence")


def listed_terms_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged by a list that is read from a file: every first word of a conversation."""
    path = shared_folder(spark, "terms")
    first = table(spark, sf_dir, "conversations").select(
        F.substring_index("text", " ", 1).alias("term"), "role"
    ).where("term rlike '^[A-Za-z]+$'").distinct()
    first.write.option("sep", ";").option("header", True).csv(path)
    found = ep.flag_posts(documents(spark, sf_dir), read_terms(spark, path), multiplicity=PER_TERM)
    return found.select("post_id", "term", "role")


def lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all texts, written and read as lines, through a view and SQL."""
    path = shared_folder(spark, "lines")
    texts = documents(spark, sf_dir).where("text IS NOT NULL")
    texts.select(F.explode(F.split("text", "\n", -1)).alias("value")).write.text(path)
    name = "post_lines"
    register_view(read_lines(spark, path), name)
    return spark.sql(f"SELECT value AS line, count(*) AS n FROM {name} GROUP BY value")


def negatives_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative sentences in a folder per window name, and read from there."""
    path = shared_folder(spark, "negatives")
    write_negatives(ep.negatives(scored(spark, sf_dir), CALENDAR), path)
    return spark.read.text(path).select("name", F.col("value").alias("sentence"))


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    posts_per_window, posts_per_window_open, events_per_window_by_table, flag_posts,
    flag_posts_per_term, flag_posts_wildcards, flag_posts_long_list, flagged_per_window,
    flagged_timestamps, sentences, sentence_sentiment, sentence_sentiment_model,
    windows_with_negatives, sentences_of_windows_with_negatives, negative_sentences,
    negative_per_window, window_report, window_report_lines, window_names, tag_counts, top_tags,
    tag_counts_merged, tags_only_new, tags_in_both, tags_with_counterpart, flagged_tag_counts,
    flagged_tag_counts_per_term, tag_cloud_weights, flagged_tag_cloud_weights,
    posts_per_window_stream, flag_posts_stream, events_per_window_by_table_shuffled,
    flag_posts_wildcards_long, flag_posts_inner_wildcards, window_report_two_pass, window_report_by_table,
    flag_posts_stream_long_list, json_posts_flagged, json_tag_counts, chunks_round_trip,
    routed_round_trip, tag_file_round_trip, annotated_round_trip, events_per_window_as_of,
    model_document_recall, tag_counts_incremental, posts_per_window_stream_by_table,
    flag_posts_stream_distinct, listed_terms_flagged, lines_round_trip, negatives_round_trip,
    window_report_stream, consumed_round_trip, sentence_stop_counts, sentences_by_statistics,
)


def entry(spark: SparkSession) -> DataFrame:
    """The window report at the smallest scale."""
    return window_report(spark, "/root/testdata/sf0.001")


def _corpus_queries() -> tuple[dict, dict]:
    """Queries and SQL of the optional subpackage for training corpora; none where it, or what it
    needs, cannot be imported."""
    found, sql = {}, {}
    try:
        from eventpulse.llm import queries as corpus

        found, sql = dict(corpus.QUERIES), dict(corpus.ORACLE_SQL)
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    except ImportError:
        pass
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES} | _corpus_queries()[0]


# ---- the same in SQL ----------------------------------------------------------

def _rows(*columns: tuple) -> str:
    def cell(v: object) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in columns)


def _bucketed(name: str, source: str, bounds: str = ">=") -> str:
    """A CTE: ``source`` with its bucket, by a range join with the windows."""
    z = f"(p.timestamp_ms - {BASE_MS})"
    return f"""{name} AS (
      SELECT p.*, CAST(CASE WHEN {z} < 0 THEN {CALENDAR.before}
                            ELSE coalesce(w.bucket, {CALENDAR.other}) END AS INTEGER) AS bucket
      FROM {source} p LEFT JOIN windows w
        ON {z} {bounds} w.lo_ms AND {z} < w.hi_ms)"""


_BASE = f"""
    windows(bucket, name, lo_ms, hi_ms) AS (
      VALUES {_rows(*[(i, n, lo, hi) for i, (n, lo, hi) in enumerate(CALENDAR.windows)])}),
    names(bucket, name) AS (VALUES {_rows(*enumerate(CALENDAR.names))}),
    terms(term) AS (VALUES {_rows(*[(t,) for t in TERMS])}),
    lexicon(token, weight) AS (VALUES {_rows(*LEXICON.items())}),
    times AS (SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms FROM events),
    docs AS (SELECT doc_id AS post_id, text, string_split(text, ' ') AS tags FROM documents),
    posts AS (SELECT d.post_id, d.text, t.timestamp_ms, d.tags
              FROM docs d LEFT JOIN times t ON t.event_id = d.post_id * 5)"""

_FLAGGED = """
    flags AS (SELECT DISTINCT p.text, p.timestamp_ms FROM posts p JOIN terms t
              ON p.text LIKE '% ' || t.term || ' %')"""


def _sentences(name: str, source: str, keys: str, kept: str) -> str:
    return f"""{name} AS (
      SELECT {keys}, CAST(pos AS INTEGER) AS pos, sentence FROM (
        SELECT {keys}, generate_subscripts(pieces, 1) - 1 AS pos,
               regexp_replace(unnest(pieces), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS sentence
        FROM (SELECT {keys}, string_split_regex(text, '[.!?\\n]+') AS pieces FROM {source}))
      WHERE {kept})"""


def _scores(name: str, source: str, keys: str) -> str:
    """A CTE: score and class per sentence; ``keys`` identify a sentence."""
    on = " AND ".join(f"s.{k.strip()} = h.{k.strip()}" for k in keys.split(","))
    return f"""{name} AS (
      SELECT s.*, CAST(coalesce(h.score, 0) AS BIGINT) AS score,
             CAST(CASE WHEN coalesce(h.score, 0) <= -4 THEN 0 WHEN coalesce(h.score, 0) < 0 THEN 1
                       WHEN coalesce(h.score, 0) = 0 THEN 2 WHEN h.score < 4 THEN 3
                       ELSE 4 END AS INTEGER) AS sentiment
      FROM {source} s LEFT JOIN (
        SELECT {keys}, sum(l.weight) AS score FROM (
          SELECT {keys}, unnest(string_split_regex(lower(sentence), '[^\\pL]+')) AS token
          FROM {source}) w JOIN lexicon l ON l.token = w.token GROUP BY {keys}) h ON {on})"""


_LONG = "length(sentence) > 1 OR strlen(sentence) >= 4"

_SCORED = ",".join((
    _FLAGGED,
    _bucketed("flagged", "flags"),
    _sentences("parts", "flagged", "text, timestamp_ms, bucket", "length(sentence) > 0"),
    _scores("scored", "parts", "text, timestamp_ms, bucket, pos"),
))

_REPORT = f"""{_SCORED}, {_bucketed("bucketed", "posts")},
    report AS (
      SELECT n.bucket, n.name,
             CAST(coalesce(f.n, 0) AS BIGINT) AS flagged_posts,
             CAST(coalesce(s.n, 0) AS BIGINT) AS negative_sentences,
             CAST(coalesce(a.n, 0) AS BIGINT) AS all_posts,
             CAST(CASE WHEN coalesce(a.n, 0) = 0 THEN -1
                  ELSE floor(coalesce(f.n, 0) * 100.0::DOUBLE / a.n + 0.5::DOUBLE) END AS INTEGER)
               AS percent
      FROM names n
      LEFT JOIN (SELECT bucket, count(*) AS n FROM bucketed GROUP BY bucket) a ON a.bucket = n.bucket
      LEFT JOIN (SELECT bucket, count(*) AS n FROM flagged GROUP BY bucket) f ON f.bucket = n.bucket
      LEFT JOIN (SELECT bucket, count(*) AS n FROM scored WHERE sentiment <= 1 GROUP BY bucket) s
        ON s.bucket = n.bucket)"""


def _tag_counts(name: str, source: str) -> str:
    return f"""{name} AS (
      SELECT tag, count(*) AS n FROM (
        SELECT unnest(tags) AS tag FROM {source} WHERE tags[1] > '') GROUP BY tag)"""


_TAGS = ",".join((
    _tag_counts("doc_tags", "docs"),
    "talks AS (SELECT string_split(text, ' ') AS tags FROM conversations)",
    _tag_counts("talk_tags", "talks"),
))


def _cloud(counts: str) -> str:
    return f"""top AS (SELECT tag, n FROM {counts}),
    span AS (SELECT min(n) AS lo, max(n) AS hi FROM top)"""


_CLOUD_SELECT = """
    SELECT tag, n, CASE WHEN hi = lo THEN 50.0::DOUBLE
      ELSE 20.0::DOUBLE + (n - lo)::DOUBLE * 30.0::DOUBLE / (hi - lo)::DOUBLE END AS weight
    FROM top, span"""

# The letter left open is one of a word, or the space between two words.
_OPEN = """open AS (SELECT DISTINCT w[1:1] || '_' || w[3:] AS term FROM (
      SELECT unnest(string_split(text, ' ')) AS w FROM conversations)
      WHERE regexp_full_match(w, '[A-Za-z]{4,}')),
    placed AS (SELECT post_id, len(ws) AS n, generate_subscripts(ws, 1) AS i, unnest(ws) AS w
      FROM (SELECT post_id, string_split(text, ' ') AS ws FROM docs)),
    within AS (SELECT * FROM placed WHERE i BETWEEN 2 AND n - 1),
    opened AS (SELECT DISTINCT k.post_id, k.term FROM (
      SELECT post_id, w[1:1] || '_' || w[3:] AS term FROM within WHERE length(w) >= 2
      UNION ALL
      SELECT a.post_id, a.w || '_' || b.w FROM within a
      JOIN within b ON b.post_id = a.post_id AND b.i = a.i + 1 WHERE length(a.w) = 1) k
      JOIN open t ON t.term = k.term)"""

_HITS = """hits AS (SELECT d.*, t.term FROM docs d JOIN terms t
      ON d.text LIKE '% ' || t.term || ' %'),
    hit_docs AS (SELECT DISTINCT post_id, tags FROM hits)"""


def oracle_sql() -> dict[str, str]:
    def with_(select: str, *ctes: str) -> str:
        return f"WITH {', '.join((_BASE, *ctes))} {select}"

    per_bucket = "SELECT bucket, count(*) AS n FROM {} GROUP BY bucket"
    wild = f"wild(term) AS (VALUES {_rows(*[(t,) for t in WILD_TERMS])})"
    own = {
        "posts_per_window": with_(per_bucket.format("b"), _bucketed("b", "times")),
        "posts_per_window_open": with_(per_bucket.format("b"), _bucketed("b", "times", ">")),
        "events_per_window_by_table_shuffled": with_(per_bucket.format("b"), _bucketed("b", "times")),
        "events_per_window_by_table": with_(per_bucket.format("b"), _bucketed("b", "times")),
        "events_per_window_as_of": with_(per_bucket.format("b"), _bucketed("b", "times")),
        "posts_per_window_stream_by_table": with_(per_bucket.format("b"), _bucketed("b", "times")),
        "flag_posts_stream_distinct": with_("SELECT text, timestamp_ms FROM flags", _FLAGGED),
        "tag_counts_incremental": with_("SELECT tag, n FROM doc_tags", _TAGS),
        "listed_terms_flagged": """
            WITH t AS (SELECT DISTINCT string_split(text, ' ')[1] AS term, role FROM conversations
                       WHERE regexp_full_match(string_split(text, ' ')[1], '[A-Za-z]+'))
            SELECT doc_id AS post_id, term, role FROM documents, t
            WHERE text LIKE '% ' || term || ' %'""",
        "lines_round_trip": """
            SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
            GROUP BY line""",
        "posts_per_window_stream": with_(per_bucket.format("b"), _bucketed("b", "times")),
        "flag_posts": with_("SELECT text, timestamp_ms FROM flags", _FLAGGED),
        "flag_posts_per_term": with_(
            "SELECT p.post_id, p.text, p.timestamp_ms, t.term FROM posts p JOIN terms t "
            "ON p.text LIKE '% ' || t.term || ' %'"
        ),
        "flag_posts_wildcards": with_(
            "SELECT d.post_id, t.term FROM docs d JOIN wild t ON d.text LIKE '% ' || t.term || ' %'",
            wild,
        ),
        "flag_posts_long_list": with_(
            "SELECT post_id, count(DISTINCT word) AS n_terms FROM inner_words "
            "WHERE word IN (SELECT unnest(string_split(text, ' ')) FROM conversations) "
            "GROUP BY post_id",
            "inner_words AS (SELECT post_id, unnest(string_split(text, ' ')[2:-2]) AS word FROM docs)",
        ),
        "flag_posts_wildcards_long": with_(
            "SELECT post_id, count(*) AS n_terms FROM opened GROUP BY post_id", _OPEN,
        ),
        "flag_posts_inner_wildcards": f"""
            WITH l(c) AS (SELECT unnest(string_split('{INNER_LETTERS}', ''))),
            t AS (SELECT '%' || a.c || b.c || d.c || '%' AS term FROM l a, l b, l d)
            SELECT doc_id AS post_id, term FROM documents, t
            WHERE text LIKE '% ' || term || ' %'""",
        "flag_posts_stream_long_list": with_(
            "SELECT DISTINCT post_id AS doc_id FROM opened", _OPEN,
        ),
        "json_posts_flagged": with_(
            "SELECT text, CAST(timestamp_ms AS VARCHAR) AS timestamp_ms FROM flags", _FLAGGED
        ),
        "json_tag_counts": with_("SELECT tag, n FROM doc_tags", _TAGS),
        "tag_file_round_trip": with_("SELECT tag, n FROM doc_tags", _TAGS),
        "chunks_round_trip": with_(
            "SELECT text, CAST(timestamp_ms AS VARCHAR) AS timestamp_ms FROM posts"
        ),
        "routed_round_trip": with_(
            "SELECT bucket, replace(replace(text, chr(13), '\\r'), chr(10), '\\n') AS line FROM flagged",
            _FLAGGED, _bucketed("flagged", "flags"),
        ),
        "annotated_round_trip": with_(
            "SELECT bucket, CASE sentiment WHEN 0 THEN 'very negative' ELSE 'negative' END AS label, "
            "sentence FROM scored WHERE sentiment <= 1", _SCORED,
        ),
        "sentence_sentiment_model": with_(
            "SELECT post_id, pos FROM s", _sentences("s", "docs", "post_id", _LONG)
        ),
        "flag_posts_stream": with_(
            "SELECT DISTINCT d.post_id AS doc_id, d.text FROM docs d JOIN terms t "
            "ON d.text LIKE '% ' || t.term || ' %'"
        ),
        "flagged_per_window": with_(
            per_bucket.format("flagged"), _FLAGGED, _bucketed("flagged", "flags")
        ),
        "flagged_timestamps": with_(
            'SELECT CAST(timestamp_ms AS VARCHAR) AS "Timestamp" FROM flags', _FLAGGED
        ),
        "sentences": with_(
            "SELECT post_id, pos, sentence FROM s", _sentences("s", "docs", "post_id", _LONG)
        ),
        "sentence_sentiment": with_(
            "SELECT post_id, pos, score, sentiment FROM x",
            _sentences("s", "docs", "post_id", _LONG), _scores("x", "s", "post_id, pos"),
        ),
        "windows_with_negatives": with_(
            "SELECT n.bucket, n.name, count(*) AS sentences, "
            "count(*) FILTER (WHERE s.sentiment <= 1) AS negatives "
            "FROM scored s JOIN names n ON n.bucket = s.bucket GROUP BY n.bucket, n.name "
            "HAVING count(*) FILTER (WHERE s.sentiment <= 1) > 0", _SCORED,
        ),
        "sentences_of_windows_with_negatives": with_(
            "SELECT bucket, timestamp_ms, pos, sentence FROM scored WHERE bucket IN "
            "(SELECT bucket FROM scored WHERE sentiment <= 1)", _SCORED,
        ),
        "negatives_round_trip": with_(
            "SELECT n.name, s.sentence FROM scored s JOIN names n ON n.bucket = s.bucket "
            f"WHERE s.sentiment <= 1 AND ({_LONG})", _SCORED,
        ),
        "negative_sentences": with_(
            "SELECT n.name, s.sentence FROM scored s JOIN names n ON n.bucket = s.bucket "
            f"WHERE s.sentiment <= 1 AND ({_LONG})", _SCORED,
        ),
        "negative_per_window": with_(
            "SELECT bucket, count(*) AS n FROM scored WHERE sentiment <= 1 GROUP BY bucket", _SCORED
        ),
        "window_report": with_("SELECT * FROM report", _REPORT),
        "window_report_two_pass": with_("SELECT * FROM report", _REPORT),
        "window_report_stream": with_("SELECT * FROM report", _REPORT),
        "sentence_stop_counts": """
            SELECT lower(rtrim(w, '.')) AS word, count(*) AS n,
                   count(*) FILTER (WHERE w LIKE '%.') AS n_stop
            FROM (SELECT unnest(regexp_extract_all(text, '\\pL+\\.?')) AS w FROM documents) GROUP BY 1""",
        "consumed_round_trip": with_(
            "SELECT text, CAST(timestamp_ms AS VARCHAR) AS timestamp_ms FROM posts"
        ),
        "window_report_by_table": with_("SELECT * FROM report", _REPORT),
        "window_report_lines": with_(
            "SELECT bucket, name || chr(9) || ' hate tweets:' || flagged_posts || chr(9) || "
            "' sentiment hate tweets: ' || negative_sentences || chr(9) || ' all tweets:' || "
            "all_posts || chr(9) || ' Prozentual: ' || percent AS line FROM report", _REPORT,
        ),
        "window_names": with_(
            "SELECT e.bucket, e.n, coalesce(n.name, 'error') AS name FROM "
            "(SELECT CAST(user_id AS INTEGER) AS bucket, count(*) AS n FROM events GROUP BY 1) e "
            "LEFT JOIN names n ON n.bucket = e.bucket"
        ),
        "tag_counts": with_("SELECT tag, n FROM doc_tags", _TAGS),
        "top_tags": with_("SELECT tag, n FROM doc_tags ORDER BY n DESC, tag LIMIT 100", _TAGS),
        "tag_counts_merged": with_(
            "SELECT tag, CAST(sum(n) AS BIGINT) AS n FROM "
            "(SELECT * FROM doc_tags UNION ALL SELECT * FROM talk_tags) GROUP BY tag", _TAGS,
        ),
        "tags_only_new": with_(
            "SELECT tag, n FROM talk_tags WHERE tag NOT IN (SELECT tag FROM doc_tags)", _TAGS
        ),
        "tags_in_both": with_(
            "SELECT d.tag, d.n + t.n AS n FROM doc_tags d JOIN talk_tags t ON t.tag = d.tag", _TAGS
        ),
        "tags_with_counterpart": with_(
            "SELECT d.tag, d.n, coalesce(t.n, 0) AS n_right FROM doc_tags d LEFT JOIN talk_tags t "
            "ON t.tag = d.tag", _TAGS,
        ),
        "flagged_tag_counts": with_("SELECT tag, n FROM c", _HITS, _tag_counts("c", "hit_docs")),
        "flagged_tag_counts_per_term": with_("SELECT tag, n FROM c", _HITS, _tag_counts("c", "hits")),
        "tag_cloud_weights": with_(_CLOUD_SELECT, _TAGS, _cloud("doc_tags")),
        "flagged_tag_cloud_weights": with_(
            _CLOUD_SELECT, _HITS, _tag_counts("c", "hit_docs"), _cloud("c")
        ),
    }
    return own | _corpus_queries()[1]
