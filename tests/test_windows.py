import datetime

import pytest
from pyspark.sql import functions as F

from eventpulse.calendars import TOURNAMENT, Calendar
from eventpulse.functions.time import event_millis, millis_of_ntz
from eventpulse.operators.windows import (
    OPEN, assign_from_table, bucket_of_file, bucket_sql, calendar_table, count_per_window, overlapping_windows,
    rebased, window_name, with_bucket, with_window_name,
)

BASE = TOURNAMENT.base_ms


def expected(millis, bounds):
    """The bucket by going through the windows one after the other."""
    if millis is None:
        return 46
    z = millis - BASE
    if z < 0:
        return 45
    for i, (_, lo, hi) in enumerate(TOURNAMENT.windows):
        if (lo < z if bounds == OPEN else lo <= z) and z < hi:
            return i
    return 46


def interesting_times():
    times = {BASE - 1, BASE, BASE + 1, BASE - 10**9, BASE + 10**10, 0}
    for _, lo, hi in TOURNAMENT.windows:
        times |= {BASE + t + d for t in (lo, hi) for d in (-1, 0, 1)} | {BASE + (lo + hi) // 2}
    return sorted(times)


@pytest.mark.parametrize("bounds", ["half_open", OPEN])
def test_every_boundary(spark, bounds):
    times = interesting_times()
    frame = spark.createDataFrame([(t,) for t in times] + [(None,)], "timestamp_ms bigint")
    got = {r.timestamp_ms: r.bucket for r in with_bucket(frame, bounds=bounds).collect()}
    assert got == {t: expected(t, bounds) for t in [*times, None]}


def test_unknown_bounds_are_refused():
    with pytest.raises(ValueError):
        bucket_sql(TOURNAMENT, "t", "closed")


def test_bad_times_count_as_other_or_are_dropped(posts_of):
    posts = posts_of(("a", None), ("b", "soon"), ("c", ""), ("d", str(BASE)))
    assert {r.bucket: r.n for r in count_per_window(posts).collect()} == {46: 3, 0: 1}
    kept = count_per_window(posts, drop_bad_time=True).collect()
    assert {r.bucket: r.n for r in kept} == {0: 1}


def test_a_start_is_other_when_bounds_are_open(posts_of):
    posts = posts_of(("a", str(BASE)), ("b", str(BASE + 1)))
    got = {r.bucket: r.n for r in count_per_window(posts, bounds=OPEN).collect()}
    assert got == {46: 1, 0: 1}


def test_bucket_sql_in_a_statement(spark, posts_of):
    posts_of(("a", str(BASE + 64800000))).createOrReplaceTempView("arrived")
    text = bucket_sql(TOURNAMENT, "try_cast(timestamp_ms AS BIGINT)")
    assert spark.sql(f"SELECT {text} AS bucket FROM arrived").first().bucket == 1


def test_no_join_and_one_shuffle(posts_of):
    plan = count_per_window(posts_of(("a", "1")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_rebased(posts_of):
    rows = rebased(posts_of(("a", str(BASE + 7)), ("b", "x"))).collect()
    assert [r.offset_ms for r in rows] == [7, None]


def test_names(spark):
    frame = spark.createDataFrame(
        [("0",), ("44.txt",), ("45",), ("46",), ("47",), ("-1",), ("x",), (None,)], "b string"
    )
    named = frame.select(window_name(bucket_of_file("b")).alias("n"))
    assert [r.n for r in named.collect()] == [
        "TUR_ITA", "FINAL_ENG_ITA", "PRE_CUP", "POST_CUP", "error", "error", "error", "error",
    ]
    numbers = spark.range(2).select(F.col("id").cast("int").alias("bucket"))
    assert [r.name for r in with_window_name(numbers).collect()] == ["TUR_ITA", "WAL_SUI"]


def test_calendar_table(spark):
    rows = calendar_table(spark).orderBy("bucket").collect()
    assert len(rows) == 47
    assert tuple(rows[44]) == (44, "FINAL_ENG_ITA", 2592000000, 2604000000)
    assert tuple(rows[45]) == (45, "PRE_CUP", None, 0)
    assert tuple(rows[46]) == (46, "POST_CUP", None, None)


def test_calendar_refuses_overlaps():
    with pytest.raises(ValueError):
        Calendar(0, (("a", 0, 10), ("b", 9, 20)))
    with pytest.raises(ValueError):
        Calendar(0, (("a", 5, 5),))
    with pytest.raises(ValueError):
        Calendar(0, tuple((str(i), i, i + 1) for i in range(Calendar.MAX_WINDOWS + 1)))


@pytest.mark.parametrize("limit", [300_000, 0])
def test_window_table_equals_calendar(spark, limit):
    """Broadcast and shuffled lookup agree with the search tree."""
    times = spark.createDataFrame(
        [(t, str(t)) for t in interesting_times()] + [(None, "none")],
        "timestamp_ms bigint, text string",
    )
    windows = calendar_table(spark).where("bucket < 45")
    got = assign_from_table(
        times, windows, base_ms=BASE, before=45, other=46, max_broadcast_cells=limit
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, with_bucket(times).collect()))


@pytest.mark.parametrize("limit", [300_000, 0])
def test_windows_of_very_unequal_length(spark, limit):
    """One long window, and many short ones that an average cell would all hold."""
    bounds = [(i, 3 * i, 3 * i + 1 + i % 2) for i in range(200)] + [(200, 1000, 1_000_000)]
    windows = spark.createDataFrame(bounds, "bucket int, lo_ms bigint, hi_ms bigint")
    times = [*range(-2, 620), 999, 1000, 65_536, 999_999, 1_000_000]
    posts = spark.createDataFrame([(t,) for t in times], "timestamp_ms bigint")
    got = assign_from_table(
        posts, windows, base_ms=0, before=300, other=301, max_broadcast_cells=limit
    )
    want = {
        t: next((b for b, lo, hi in bounds if lo <= t < hi), 300 if t < 0 else 301) for t in times
    }
    rows = got.collect()
    assert len(rows) == len(times)
    assert {r.timestamp_ms: r.bucket for r in rows} == want
    assert got.schema["bucket"].dataType.simpleString() == "int"


def test_window_table_may_be_empty(spark, posts_of):
    empty = calendar_table(spark).where("false")
    posts = posts_of(("a", str(BASE)), ("b", str(BASE - 1)))
    got = assign_from_table(posts, empty, base_ms=BASE, before=0, other=1).collect()
    assert [r.bucket for r in got] == [1, 0]


def test_overlapping_windows_are_found(spark):
    good = "select 0 as bucket, 'a' as name, 0L as lo_ms, 10L as hi_ms union all select 1, 'b', 10L, 12L"
    assert overlapping_windows(spark.sql(good)).count() == 0
    bad = spark.sql(good + " union all select 2, 'c', 9L, 11L")
    assert {r.bucket for r in overlapping_windows(bad).collect()} == {1, 2}


def test_event_millis(spark):
    frame = spark.createDataFrame([("1623436200000",), ("1.5",), ("",), (None,)], "t string")
    got = [r.m for r in frame.select(event_millis("t").alias("m")).collect()]
    assert got == [1623436200000, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_millis_of_ntz_in_any_zone(spark, zone):
    start = datetime.datetime(2024, 3, 31)
    moments = [start + datetime.timedelta(minutes=30 * i, microseconds=999 * i) for i in range(96)]
    moments += [datetime.datetime(1969, 12, 31, 23, 59, 59, 999999), datetime.datetime(9999, 12, 31)]
    epoch = datetime.datetime(1970, 1, 1)
    want = [(m - epoch) // datetime.timedelta(milliseconds=1) for m in moments]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
        assert [r.ms for r in frame.select(millis_of_ntz("ts").alias("ms")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
