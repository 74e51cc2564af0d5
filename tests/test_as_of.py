import random

import pytest
from pyspark.sql import functions as F

from eventpulse.operators.as_of import assign_as_of
from eventpulse.operators.windows import HALF_OPEN, OPEN, assign_from_table


def calendar(rng, n, start=0):
    """Disjoint windows of very unequal lengths, some adjoining, in any order."""
    at, rows = start, []
    for i in range(n):
        at += rng.choice([0, 0, 1, 7, 1000])
        length = rng.choice([1, 2, 5, 100, 5000])
        rows.append((i, at, at + length))
        at += length
    rng.shuffle(rows)
    return rows, at


def brute(z, windows, bounds):
    if z is None:
        return -2
    for bucket, lo, hi in windows:
        if (lo < z if bounds == OPEN else lo <= z) and z < hi:
            return bucket
    return -1 if z < 0 else -2


@pytest.mark.parametrize("bounds", [HALF_OPEN, OPEN])
@pytest.mark.parametrize("slots", [1, 2, 7, 40])
def test_equals_brute_force(spark, bounds, slots):
    rng = random.Random(slots)
    windows, end = calendar(rng, 60, start=-3000)
    edges = [t + d for _, lo, hi in windows for t in (lo, hi) for d in (-1, 0, 1)]
    hot = rng.choice(edges)  # a time that a third of all posts share
    times = edges + [rng.randint(-5000, end + 50) for _ in range(300)] + [hot] * 350
    rows = [(i, str(t + 100)) for i, t in enumerate(times)] + [(-1, None), (-2, "soon")]
    posts = spark.createDataFrame(rows, "id int, timestamp_ms string").repartition(3)
    table = spark.createDataFrame(windows, "bucket int, lo_ms bigint, hi_ms bigint")
    got = assign_as_of(
        posts, table, base_ms=100, before=-1, other=-2, bounds=bounds, slots=slots
    ).collect()
    want = {i: brute(t, windows, bounds) for i, t in enumerate(times)} | {-1: -2, -2: -2}
    assert {r.id: r.bucket for r in got} == want and len(got) == len(rows)


def test_equals_the_lookup_by_cells(spark):
    rng = random.Random(9)
    windows, end = calendar(rng, 500)
    posts = spark.range(3000).select((F.rand(3) * (end + 100)).cast("bigint").alias("timestamp_ms"), "id")
    table = spark.createDataFrame(windows, "bucket int, lo_ms bigint, hi_ms bigint")
    same = {"base_ms": 0, "before": -1, "other": -2}
    merged = assign_as_of(posts, table, **same)
    looked_up = assign_from_table(posts, table, **same)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, looked_up.collect()))


def test_no_windows_and_no_posts(spark):
    none = spark.createDataFrame([], "bucket int, lo_ms bigint, hi_ms bigint")
    posts = spark.createDataFrame([(5,), (-5,)], "timestamp_ms bigint")
    same = {"base_ms": 0, "before": 7, "other": 8}
    assert sorted(r.bucket for r in assign_as_of(posts, none, **same).collect()) == [7, 8]
    one = spark.createDataFrame([(0, 0, 9), (1, 9, 9)], "bucket int, lo_ms bigint, hi_ms bigint")
    assert assign_as_of(posts.limit(0), one, **same).count() == 0
    assert sorted(r.bucket for r in assign_as_of(posts, one, **same).collect()) == [0, 7]


def test_both_sides_are_shuffled_once_and_nothing_is_broadcast(spark):
    windows = spark.createDataFrame([(0, 0, 9)], "bucket int, lo_ms bigint, hi_ms bigint")
    posts = spark.range(100).select(F.col("id").alias("timestamp_ms"))
    plan = assign_as_of(posts, windows, base_ms=0, before=1, other=2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Broadcast" not in text and "Join" not in text


def test_unknown_bounds_are_refused(spark):
    windows = spark.createDataFrame([(0, 0, 9)], "bucket int, lo_ms bigint, hi_ms bigint")
    with pytest.raises(ValueError):
        assign_as_of(spark.range(1), windows, base_ms=0, before=1, other=2, time="id", bounds="closed")
