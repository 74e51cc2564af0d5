"""One text, word or window that holds a third of the rows."""

import collections
import contextlib

import pytest
from pyspark.sql import functions as F

from eventpulse.operators.sentiment import score_sentences
from eventpulse.operators.terms import PER_TERM, TermSet, drop_copies, flag_posts
from eventpulse.operators.windows import assign_from_table, calendar_table
from eventpulse.plans.report import tally

ROWS = 30_000


@pytest.fixture(scope="module")
def posts(spark, tmp_path_factory):
    """Every third post is the same; all have the same word at their second place."""
    path = str(tmp_path_factory.mktemp("hot"))
    own = F.concat_ws(" ", F.lit("x"), F.lit("the"), F.concat(F.lit("w"), F.col("id")), F.lit("z"))
    hot = F.when(F.col("id") % 3 == 0, F.lit("a hot text the same here")).otherwise(own)
    spark.range(ROWS).repartition(8, "id").select(
        hot.alias("text"), F.col("id").cast("string").alias("timestamp_ms")
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def small_thresholds(spark):
    """Make adaptive execution see a few kilobytes as a large partition, and broadcast nothing."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_text_is_split_when_matches_are_joined_back(spark, posts, terms_of):
    listed = terms_of("hot", "the", "w1", "the same")
    with small_thresholds(spark):
        kept = flag_posts(posts, listed, max_terms=0)
        assert len(kept.collect()) == ROWS
        assert "skew=true" in final_plan(kept)
        pairs = flag_posts(posts, listed, multiplicity=PER_TERM, max_terms=0)
        got = collections.Counter(r.term for r in pairs.collect())
        assert "skew=true" in final_plan(pairs)
    assert got == {"the": ROWS, "hot": ROWS // 3, "the same": ROWS // 3, "w1": 1}


def test_term_listed_many_times_flags_a_post_once(spark, posts, terms_of):
    listed = terms_of(*["the"] * 500, "w1")
    assert flag_posts(posts, listed, max_terms=0).count() == ROWS


def test_posts_that_are_not_flagged_cost_one_row_per_task(spark, posts, terms_of):
    counted = tally(posts, TermSet.of(["w1"]))
    rows = counted.collect()
    assert {(r.text, r.n) for r in rows} == {(None, ROWS - 1), ("x the w1 z", 1)}
    plan = final_plan(counted)
    assert plan.count("HashAggregate") == 2 and plan.count("FileScan") == 1


def test_hot_text_costs_one_row_per_task_when_copies_are_dropped(spark, posts):
    same_time = posts.select("text", F.lit("1").alias("timestamp_ms"))
    kept = drop_copies(same_time)
    assert kept.count() == ROWS - ROWS // 3 + 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2


def test_hot_sentence_and_hot_word(spark, posts):
    sentences = posts.select("timestamp_ms", F.col("text").alias("sentence"))
    lexicon = spark.createDataFrame([("the", 1), ("hot", -3)], "token string, weight int")
    with small_thresholds(spark):
        scored = score_sentences(sentences, lexicon, max_tokens=0)
        counts = scored.groupBy("score").agg(F.count("*").alias("n"))
        got = {r.score: r.n for r in counts.collect()}
        assert "skew=true" in final_plan(counts)
    assert got == {1: ROWS - ROWS // 3, -2: ROWS // 3}


def test_hot_window_is_spread_by_time(spark, posts):
    windows = calendar_table(spark).where("bucket < 45")
    with small_thresholds(spark):
        assigned = assign_from_table(
            posts, windows, base_ms=0, before=45, other=46, max_broadcast_cells=0
        )
        assert {r.bucket for r in assigned.select("bucket").distinct().collect()} == {0}
        used = assigned.select(F.spark_partition_id().alias("p")).distinct().count()
    assert used >= 4
