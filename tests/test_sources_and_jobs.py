import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

import eventpulse as ep
from eventpulse.calendars import TOURNAMENT
from eventpulse.schemas import TWEET
from eventpulse.sources.readers import (
    posts_of_tweets, read_lines, read_posts, read_tag_counts, read_terms, read_tweets,
    register_view,
)
from eventpulse.sources.writers import (
    show_top, write_by_window, write_chunks, write_json, write_negatives, write_report,
    write_tag_counts, write_timestamps,
)

BASE = TOURNAMENT.base_ms


def tweet(text, time, *tags):
    return json.dumps({
        "id": 1, "extended_tweet": {"full_text": text, "entities": {
            "hashtags": [{"text": t, "indices": [0, 1]} for t in tags]}},
        "timestamp_ms": time,
    })


@pytest.fixture
def folder(tmp_path):
    """Two files, one in a sub-folder, with copies, a short tweet and a broken line."""
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "one.json").write_text("\n".join([
        tweet("you idiot go\nhome now", str(BASE), "a", "b"),
        tweet("calm words", str(BASE + 1), "a"),
        json.dumps({"text": "short", "timestamp_ms": str(BASE + 2)}),
        "{broken",
    ]) + "\n")
    (root / "sub" / "two.json").write_text("\n".join([
        tweet("you idiot go\nhome now", str(BASE), "a", "b"),
        tweet("an idiot, and no clown here", "soon", "c"),
    ]) + "\n")
    (tmp_path / "terms.csv").write_text("id;term;note\n1;idiot;x\n2;clown;y\n3;;z\n4;007;w\n")
    return tmp_path


def text_files(path):
    return sorted(
        line for f in glob.glob(f"{path}/**/part-*", recursive=True)
        for line in open(f, encoding="utf-8").read().splitlines()
    )


def test_tweets_of_all_sub_folders(spark, folder):
    tweets = read_tweets(spark, str(folder / "in"))
    assert tweets.count() == 6
    posts = posts_of_tweets(tweets)
    assert posts.columns == ["text", "timestamp_ms", "tags"]
    assert posts.where("timestamp_ms is null").count() == 1
    assert posts.where("text is null").count() == 2
    from_file = posts_of_tweets(tweets, keep=("_metadata.file_name",))
    assert {r.file_name: r["count"] for r in from_file.groupBy("file_name").count().collect()} == {
        "one.json": 4, "two.json": 2
    }


def test_text_of_short_tweets_on_request(spark, folder):
    schema = StructType([*TWEET.fields, StructField("text", StringType())])
    tweets = read_tweets(spark, str(folder / "in"), schema)
    posts = posts_of_tweets(tweets, other_text="text", keep=("extended_tweet",))
    assert posts.where("text = 'short'").count() == 1
    assert posts.columns[-1] == "extended_tweet"


def test_terms(spark, folder):
    terms = read_terms(spark, str(folder / "terms.csv"))
    assert terms.columns == ["id", "term", "note"]
    assert [r.term for r in terms.collect()] == ["idiot", "clown", "007"]


def test_lines_and_view(spark, folder):
    lines = register_view(read_lines(spark, str(folder / "in")), "raw_lines")
    assert lines.where(F.length("value") > 14).count() == 5
    assert spark.sql("SELECT count(*) AS n FROM raw_lines").first().n == 6


def test_flagging_in_sql_gives_the_same(spark, folder):
    register_view(read_posts(spark, str(folder / "in")), "p")
    terms = register_view(read_terms(spark, str(folder / "terms.csv")), "t")
    text = "SELECT DISTINCT text, timestamp_ms FROM p JOIN t ON text LIKE '% ' || term || ' %'"
    flagged = ep.drop_copies(ep.flag_posts(read_posts(spark, str(folder / "in")), terms))
    assert sorted(map(tuple, spark.sql(text).collect())) == sorted(map(tuple, flagged.collect()))


def test_chunks(spark, tmp_path):
    write_chunks(spark.range(25_000).coalesce(1), str(tmp_path / "chunks"))
    sizes = [sum(1 for _ in open(f)) for f in glob.glob(str(tmp_path / "chunks/part-*"))]
    assert sorted(sizes) == [5_000, 10_000, 10_000]


def test_a_rerun_replaces(spark, tmp_path):
    path = str(tmp_path / "json")
    for _ in range(2):
        write_json(spark.range(3), path)
    assert spark.read.json(path).count() == 3


def test_tag_counts_round_trip(spark, tmp_path, capsys):
    counts = spark.createDataFrame([("a", 3), ("b:c", 1), ("ü", 2)], "tag string, n bigint")
    path = str(tmp_path / "tags")
    write_tag_counts(counts, path)
    assert "3:a" in text_files(path)
    assert sorted(read_tag_counts(spark, path).collect()) == sorted(counts.collect())
    show_top(counts, 1)
    assert "|a  |3  |" in capsys.readouterr().out


def test_timestamps(spark, tmp_path):
    write_timestamps(spark.createDataFrame([("1",), ("x",)], "Timestamp string").coalesce(1),
                     str(tmp_path / "times"))
    assert text_files(tmp_path / "times") == ["1", "Timestamp", "x"]


def test_routing_by_window(spark, tmp_path):
    rows = [("a\nb", 0), ("c", 0), ("d", 46)] + [("hot", 7)] * 100
    flagged = spark.createDataFrame(rows, "text string, bucket int")
    write_by_window(flagged, str(tmp_path / "text"))
    assert text_files(tmp_path / "text" / "bucket=0") == ["a\\nb", "c"]
    assert len(text_files(tmp_path / "text" / "bucket=7")) == 100
    assert sorted(os.listdir(tmp_path / "text"))[-3:] == ["bucket=0", "bucket=46", "bucket=7"]
    write_by_window(flagged, str(tmp_path / "table"), format="parquet")
    assert spark.read.parquet(str(tmp_path / "table")).where("bucket = 7").count() == 100


def test_negatives_by_name(spark, tmp_path):
    rows = spark.createDataFrame([("bad", 0), ("worse", 46)], "sentence string, bucket int")
    write_negatives(rows, str(tmp_path / "neg"))
    assert text_files(tmp_path / "neg" / "name=TUR_ITA") == ["bad"]
    assert text_files(tmp_path / "neg" / "name=POST_CUP") == ["worse"]


@pytest.mark.parametrize("token", ["other", "x" * 1001])
def test_report_job(spark, folder, token):
    """In one pass, and with a word list that is too large for it."""
    lexicon = spark.createDataFrame([("idiot", -2), (token, 1)], "token string, weight int")
    out = str(folder / "out")
    for _ in range(2):
        ep.run_report(spark, str(folder / "in"), str(folder / "terms.csv"), lexicon, out)
    report = [line for f in glob.glob(f"{out}/report/part-*") for line in open(f).read().splitlines()]
    assert len(report) == 47
    assert report[0] == (
        "TUR_ITA\t hate tweets:1\t sentiment hate tweets: 1\t all tweets:4\t Prozentual: 25"
    )
    assert report[46].startswith("POST_CUP\t hate tweets:0") and "all tweets:2" in report[46]
    assert sorted(set(text_files(f"{out}/times"))) == sorted({"Timestamp", str(BASE), "soon"})
    assert text_files(f"{out}/windows") == ["you idiot go\\nhome now"]
    assert text_files(f"{out}/negatives") == ["you idiot go"]


def test_cloud_jobs(spark, folder):
    posts, terms = str(folder / "in"), str(folder / "terms.csv")
    cloud = ep.run_cloud(spark, posts, str(folder / "cloud"))
    assert {r.tag: (r.n, r.weight) for r in cloud.collect()} == {
        "a": (3, 50.0), "b": (2, 35.0), "c": (1, 20.0)
    }
    flagged = ep.run_flagged_cloud(spark, posts, terms, str(folder / "flagged"))
    assert {r.tag: r.n for r in flagged.collect()} == {"a": 2, "b": 2, "c": 1}


def test_files_that_arrive_grow_in_number_not_in_size(spark, tmp_path):
    """Their number used to be fixed, so that one task read a share of all posts."""
    import __spark_entry__ as entry

    for rows, least, want in ((0, 4, (1, 4)), (10, 4, (3, 4)), (10_000, 4, (2_500, 4)), (95_000, 2, (10_000, 10))):
        folder = str(tmp_path / str(rows))
        spark.range(rows).toDF("doc_id").write.parquet(f"{folder}/documents.parquet")
        assert entry.arriving_files(spark, folder, least=least) == want


def test_tags_do_not_go_through_the_join_with_times(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.sql("SELECT 5L AS event_id, timestamp_ntz'2024-01-01 00:00:01' AS ts").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    posts = entry.posts(spark, str(tmp_path))
    assert sorted((r.post_id, r.tags) for r in posts.collect()) == [(1, ["a", "b"]), (2, None)]
    plan = posts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("split(") < plan.index("Join")
