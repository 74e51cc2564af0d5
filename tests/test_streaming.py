import json
import os

import pytest

from eventpulse._session import shared_folder
from eventpulse.calendars import TOURNAMENT
from eventpulse.operators.terms import drop_copies, flag_posts
from eventpulse.operators.windows import count_per_window
from eventpulse.sources.readers import posts_of_tweets, read_posts
from eventpulse.streaming.intake import (
    flag_batches, flag_stream, run_counts, run_to_parquet, running_counts, stream_files,
)

BASE = TOURNAMENT.base_ms


@pytest.fixture
def folder(tmp_path):
    """Three files of six posts and a broken line each."""
    root = tmp_path / "in"
    root.mkdir()
    for f in range(3):
        lines = [
            json.dumps({
                "extended_tweet": {"full_text": f"an idiot says {i % 2}"},
                "timestamp_ms": str(BASE + 64800000 * (i % 3)),
            })
            for i in range(5)
        ]
        lines += [json.dumps({"timestamp_ms": "soon"}), "{broken"]
        (root / f"{f}.json").write_text("\n".join(lines) + "\n")
        os.utime(root / f"{f}.json", (1700000000 + f, 1700000000 + f))
    return root


def posts_stream(spark, folder, **options):
    return posts_of_tweets(stream_files(spark, str(folder), files_per_batch=1, **options))


def pairs(table):
    return sorted((r.bucket, r.n) for r in table.collect())


def test_running_counts_equal_batch(spark, folder):
    streamed = run_counts(running_counts(posts_stream(spark, folder)))
    batch = count_per_window(read_posts(spark, str(folder)))
    assert pairs(streamed) == pairs(batch)
    assert sum(n for _, n in pairs(streamed)) == 21
    assert dict(pairs(streamed))[46] == 6 + 3


def test_consumed_files_are_archived(spark, folder, tmp_path):
    stream = posts_stream(spark, folder, consume="archive", archive=str(tmp_path / "done"))
    assert sum(n for _, n in pairs(run_counts(running_counts(stream)))) == 21
    # The files of the last batch stay until another batch has committed.
    assert len(os.listdir(folder)) < 3
    archived = [f for _, _, files in os.walk(tmp_path / "done") for f in files]
    assert len(archived) + len(os.listdir(folder)) == 3


def test_flagging_row_by_row_keeps_copies(spark, folder, terms_of):
    streamed = run_to_parquet(flag_stream(posts_stream(spark, folder), terms_of("idiot")))
    batch = flag_posts(read_posts(spark, str(folder)), terms_of("idiot"))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert streamed.count() == 15


def test_copies_within_a_span_are_dropped(spark, folder, terms_of):
    stream = flag_stream(posts_stream(spark, folder), terms_of("idiot"), copies_within="3 days")
    streamed = run_to_parquet(stream)
    batch = drop_copies(flag_posts(read_posts(spark, str(folder)), terms_of("idiot")))
    assert sorted((r.text, r.timestamp_ms) for r in streamed.collect()) == sorted(
        map(tuple, batch.collect())
    )


def test_a_list_beyond_the_bound_goes_by_batches(spark, folder, terms_of, tmp_path):
    long_list = terms_of("idiot", "x" * 1001)
    with pytest.raises(ValueError):
        flag_stream(posts_stream(spark, folder), long_list)
    out = str(tmp_path / "flagged")
    query = flag_batches(
        posts_stream(spark, folder), long_list,
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}"),
        str(tmp_path / "progress"),
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 15


def test_shared_folder_lies_below_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root) and first != second
