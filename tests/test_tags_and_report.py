import pytest
from pyspark.sql import functions as F

from eventpulse.calendars import TOURNAMENT
from eventpulse.functions.share import percent_half_up
from eventpulse.operators.tags import (
    cloud_weights, merge_counts, tag_counts, tags_in_both, tags_only_in, tags_with_counterpart,
    top_tags,
)
from eventpulse.operators.terms import PER_TERM
from eventpulse.operators.windows import HALF_OPEN, OPEN, with_bucket
from eventpulse.plans.report import (
    flagged_in_windows, flagged_tag_cloud, flagged_tag_counts, report, report_lines,
    scored_in_windows, tag_cloud, window_report,
)

BASE = TOURNAMENT.base_ms


def as_dict(counts):
    return {r.tag: r.n for r in counts.collect()}


def counts_of(spark, **counts):
    return spark.createDataFrame(list(counts.items()), "tag string, n bigint")


def test_only_the_first_tag_is_checked(spark):
    posts = spark.createDataFrame(
        [(["a", "b", "a"],), (["a", ""],), (["", "c"],), ([],), (None,), ([None, "d"],)],
        "tags array<string>",
    )
    assert as_dict(tag_counts(posts)) == {"a": 3, "b": 1, "": 1}


def test_merging(spark):
    first, second = counts_of(spark, a=2, b=1), counts_of(spark, b=6, c=3, d=7)
    merged = merge_counts(first, second)
    assert as_dict(merged) == {"a": 2, "b": 7, "c": 3, "d": 7}
    assert as_dict(merge_counts(first)) == {"a": 2, "b": 1}
    third = counts_of(spark, a=1)
    assert as_dict(merge_counts(merged, third)) == as_dict(
        merge_counts(first, merge_counts(second, third))
    )
    assert as_dict(tags_only_in(second, first)) == {"c": 3, "d": 7}
    assert as_dict(tags_in_both(first, second)) == {"b": 7}
    assert sorted(map(tuple, tags_with_counterpart(first, second).collect())) == [
        ("a", 2, None), ("b", 1, 6)
    ]


def test_merging_equals_counting_all_posts(spark):
    one = spark.createDataFrame([(["a", "b"],), (["a"],)], "tags array<string>")
    two = spark.createDataFrame([(["b", "c"],)], "tags array<string>")
    both = merge_counts(tag_counts(one), tag_counts(two))
    assert as_dict(both) == as_dict(tag_counts(one.unionByName(two)))


def test_top_and_weights(spark):
    counts = counts_of(spark, a=10, b=30, c=20, d=20, e=1)
    assert [r.tag for r in top_tags(counts, 3).collect()] == ["b", "c", "d"]
    got = {r.tag: r.weight for r in cloud_weights(counts).collect()}
    assert got == {
        "b": 50.0, "c": 20 + 19 * 30.0 / 29, "d": 20 + 19 * 30.0 / 29, "a": 20 + 9 * 30.0 / 29, "e": 20.0
    }
    many = spark.range(150).selectExpr("cast(id AS string) AS tag", "id + 1 AS n")
    assert cloud_weights(many).count() == 150
    assert [r.weight for r in cloud_weights(counts_of(spark, a=1, b=1)).collect()] == [50.0, 50.0]
    assert cloud_weights(counts_of(spark, a=1).where("false")).count() == 0


def test_shares_round_half_up(spark):
    frame = spark.createDataFrame(
        [(1, 200), (1, 201), (3, 200), (0, 5), (5, 5), (0, 0), (1, 8)], "p bigint, w bigint"
    )
    got = [r.x for r in frame.select(percent_half_up("p", "w").alias("x")).collect()]
    assert got == [1, 0, 2, 0, 100, -1, 13]


ROWS = [
    ("you idiot go. fine now", str(BASE), ["x", "y"]),
    ("you idiot go. fine now", str(BASE), ["x", "y"]),
    ("an idiot and clown in", str(BASE + 1), ["x"]),
    ("calm words", str(BASE + 2), ["z"]),
    ("an idiot too late", None, ["x"]),
    ("an idiot before", str(BASE - 5), None),
    (None, str(BASE + 64800000), ["z"]),
]


def frames(spark, terms_of):
    posts = spark.createDataFrame(ROWS, "text string, timestamp_ms string, tags array<string>")
    lexicon = spark.createDataFrame([("idiot", -2), ("fine", 1)], "token string, weight int")
    return posts, terms_of("idiot", "clown"), lexicon


def test_report_by_hand(spark, terms_of):
    table = window_report(*frames(spark, terms_of))
    rows = {r.bucket: tuple(r)[1:] for r in table.collect()}
    assert len(rows) == 47 and [r.bucket for r in table.collect()] == list(range(47))
    # Four posts in the first window; copies count once as flagged: 2 of 4.
    assert rows[0] == ("TUR_ITA", 2, 2, 4, 50)
    assert rows[1] == ("WAL_SUI", 0, 0, 1, 0)
    assert rows[2] == ("DEN_FIN", 0, 0, 0, -1)
    assert rows[45] == ("PRE_CUP", 1, 1, 1, 100)
    # Without a time: in the total of the last bucket, but not among the flagged.
    assert rows[46] == ("POST_CUP", 0, 0, 1, 0)
    line = report_lines(table).first().line
    assert line == (
        "TUR_ITA\t hate tweets:2\t sentiment hate tweets: 2\t all tweets:4\t Prozentual: 50"
    )


def test_open_bounds_change_the_totals_only(spark, terms_of):
    rows = {r.bucket: r for r in window_report(*frames(spark, terms_of), bounds="open").collect()}
    assert (rows[0].all_posts, rows[0].flagged_posts) == (2, 2)
    # Two at the base, one at the start of the second window, one without a time.
    assert rows[46].all_posts == 4 and rows[1].all_posts == 0


def test_report_reads_the_text_once(spark, terms_of, tmp_path):
    posts, terms, lexicon = frames(spark, terms_of)
    posts.write.parquet(str(tmp_path / "posts"))
    table = window_report(spark.read.parquet(str(tmp_path / "posts")), terms, lexicon)
    table.collect()
    final = table._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final and "Join" not in final
    scans = [line for line in final.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert sum("struct<timestamp_ms:string>" in line for line in scans) == 1


def test_flagged_tags(spark, terms_of):
    posts, terms, _ = frames(spark, terms_of)
    assert as_dict(flagged_tag_counts(posts, terms)) == {"x": 4, "y": 2}
    per_term = flagged_tag_counts(posts, terms, multiplicity=PER_TERM)
    assert as_dict(per_term) == {"x": 5, "y": 2}
    assert as_dict(flagged_tag_cloud(posts, terms)) == {"x": 4, "y": 2}
    assert as_dict(tag_cloud(posts)) == as_dict(tag_counts(posts))


def test_hot_tag_is_combined_before_the_shuffle(spark):
    posts = spark.range(1000).select(F.array(F.lit("hot")).alias("tags"))
    plan = tag_counts(posts)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and as_dict(tag_counts(posts)) == {"hot": 1000}


@pytest.mark.parametrize("bounds", [HALF_OPEN, OPEN])
def test_one_pass_report_equals_the_composed_one(spark, posts_of, terms_of, bounds):
    base = TOURNAMENT.base_ms
    texts = [
        "you idiot you. idiot! fine, idiot ok", "no match", "idiot", None, "", "an idiot \x01.\n . x",
        "the clown here. Nice IDIOT\u03a3 . idiot. \U0001f600!",
    ]
    times = [base, base + 1, base - 1, base + 64800000, base + 75600000, None, "soon", " 7"]
    rows = [(x, None if t is None else str(t)) for x in texts for t in times]
    posts = posts_of(*rows, *rows[:9])
    terms = terms_of("idiot", "clown here.")
    lexicon = spark.createDataFrame(
        [("idiot", -2), ("you", 1), ("fine", 3)], "token string, weight int"
    )
    flagged = flagged_in_windows(posts, terms)
    composed = report(
        with_bucket(posts, bounds=bounds), flagged, scored_in_windows(flagged, lexicon)
    )
    got = window_report(posts, terms, lexicon, bounds=bounds, one_pass=True)
    assert got.dtypes == composed.dtypes
    assert list(map(tuple, got.collect())) == list(map(tuple, composed.collect()))
    assert sum(r.negative_sentences for r in got.collect()) > 0
