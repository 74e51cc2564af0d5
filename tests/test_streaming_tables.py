import json
import os

import pytest
from pyspark.sql import functions as F

from eventpulse.calendars import TOURNAMENT
from eventpulse.operators.terms import drop_copies, flag_posts
from eventpulse.operators.windows import WindowTable, calendar_table, count_per_window
from eventpulse.plans.report import window_report
from eventpulse.sources.readers import posts_of_tweets, read_posts
from eventpulse.sources.versions import Versions
from eventpulse.streaming.intake import (
    run_counts_by_table, run_flagged_distinct, state_on_disk, stream_files,
)
from eventpulse.streaming.standing import run_window_report

BASE = TOURNAMENT.base_ms


def put(folder, number, rows):
    lines = [
        json.dumps({"extended_tweet": {"full_text": text}, "timestamp_ms": time}) for text, time in rows
    ]
    path = folder / f"{number}.json"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1700000000 + number, 1700000000 + number))


def arriving(spark, folder):
    return posts_of_tweets(stream_files(spark, str(folder), files_per_batch=1)).select("text", "timestamp_ms")


FILES = [
    [("an idiot here", "1"), ("an idiot here", "1"), ("nothing", "1")],
    [("an idiot here", "1"), ("an idiot here", "2"), ("so stupid you", None)],
    [("so stupid you", None), ("an idiot here", "2"), ("an idiot again", "1")],
]


@pytest.mark.parametrize("long", [False, True], ids=["plan", "long list"])
def test_copies_are_dropped_over_all_files(spark, terms_of, tmp_path, long):
    folder = tmp_path / "in"
    folder.mkdir()
    terms = terms_of("idiot", "st_pid", *(["x" * 1001] if long else []))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        got = run_flagged_distinct(arriving(spark, folder), terms, out, progress=progress)
        return sorted(map(tuple, got.collect()), key=str)

    def batch():
        kept = drop_copies(flag_posts(read_posts(spark, str(folder)), terms))
        return sorted(map(tuple, kept.collect()), key=str)

    for number, rows in enumerate(FILES[:2]):
        put(folder, number, rows)
    assert run() == batch() and len(batch()) == 3
    put(folder, 2, FILES[2])  # copies of what an earlier run has read
    assert run() == batch() and len(batch()) == 4
    assert run() == batch()


@pytest.mark.parametrize("by_table", [False, True], ids=["calendar", "window table"])
def test_a_standing_report_equals_the_report_of_all_files(spark, terms_of, tmp_path, by_table):
    folder, root = tmp_path / "in", str(tmp_path / "report")
    folder.mkdir()
    terms = terms_of("idiot", "st_pid")
    lexicon = spark.createDataFrame([("idiot", -2), ("stupid", -5), ("nice", 1)], "token string, weight int")
    calendar = TOURNAMENT
    if by_table:
        windows = calendar_table(spark).where(F.col("bucket") < TOURNAMENT.before)
        calendar = WindowTable.of(windows, BASE)
    times = [str(BASE + t) for t in (0, 5, 64800000, -1, 10**12)] + [None, "soon"]
    texts = ["an idiot here. so nice", "you stupid one! an idiot", "nothing", "an idiot here. so nice"]

    def agree():
        got = run_window_report(arriving(spark, folder), terms, lexicon, calendar, root)
        want = window_report(read_posts(spark, str(folder)), terms, lexicon, calendar)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        return got

    for number in range(2):
        put(folder, number, [(x, t) for x in texts for t in times])
    agree()
    put(folder, 2, [("an idiot once more", t) for t in times] + [(texts[0], times[0])])
    report = agree()
    assert sum(r.all_posts for r in report.collect()) == 2 * 28 + 8
    agree()


def test_state_on_disk_leaves_the_settings_as_they_were(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with state_on_disk(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before


def test_counts_by_a_window_table(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    windows = calendar_table(spark).where(F.col("bucket") < TOURNAMENT.before)
    calendar = WindowTable.of(windows, BASE)
    root, progress = str(tmp_path / "counts"), str(tmp_path / "progress")
    times = [str(BASE + 64800000 * (i % 5) - 1) for i in range(30)] + [None, "soon"]
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def run():
            got = run_counts_by_table(arriving(spark, folder), calendar, root, progress=progress)
            return sorted((r.bucket, r.n) for r in got.collect())

        def batch():
            return sorted((r.bucket, r.n) for r in count_per_window(read_posts(spark, str(folder))).collect())

        assert run() == []
        for number in range(3):
            put(folder, number, [("x", t) for t in times[number:]])
        assert run() == batch()
        put(folder, 3, [("x", t) for t in times])
        # The batch fails after its counts were written, and is run again.
        commit = Versions.commit
        monkeypatch.setattr(Versions, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
        monkeypatch.setattr(Versions, "commit", commit)
        assert run() == batch()
        # It is committed, but the stream's own progress is lost: the batch comes again under its number.
        versions = Versions(spark, root)
        assert versions.current().notes["batch"] == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
