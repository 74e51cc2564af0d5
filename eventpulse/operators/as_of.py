"""Point in interval for calendars of any size, as an as-of merge.

Windows and posts are put into one table, cut into slots of time that hold about the same number of
posts each, and sorted. Within a slot, the last window that began before a post is the only one it
can lie in. A window that goes on in the next slots is put into each of them; as windows are
disjoint, at most one crosses from a slot to the next, so there are no more copies than slots.

A time that very many posts share takes several slots, among which its posts are spread. The bounds
of the slots are quantiles of all times, a number per slot.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventpulse.functions.time import event_millis
from eventpulse.operators.windows import HALF_OPEN, OPEN

# Slots per shuffle partition, so that partitions get about the same number of posts.
SLOTS_PER_PARTITION = 3


class _Slots:
    """Where times and windows go, given the upper bounds of all slots but the last."""

    def __init__(self, bounds: list[float]):
        grouped = [(bound, len(list(same))) for bound, same in groupby(sorted(bounds))]
        self.bounds = [b for b, _ in grouped]
        upto = [0]
        for _, n in grouped:
            upto.append(upto[-1] + n)
        self.n = upto[-1] + 1
        # By the number of distinct bounds that are not above a time: its last slot, and its first
        # one if it equals the last of them.
        self._last = F.array(*[F.lit(x) for x in upto])
        self._first = F.array(*[F.lit(x) for x in [0, *upto[:-1]]])
        self._at = F.array(F.lit(float("-inf")), *[F.lit(b) for b in self.bounds])

    def add(self, table: DataFrame, time: str, first: str, last: str) -> DataFrame:
        """Add the first and the last slot that a time may be put into."""
        if not self.bounds:
            return table.withColumns({first: F.lit(0), last: F.lit(0)})
        cut = Bucketizer(
            splits=[float("-inf"), *self.bounds, float("inf")], inputCol="_time", outputCol="_place",
            handleInvalid="keep",
        )
        placed = cut.transform(table.withColumn("_time", F.coalesce(F.col(time), F.lit(0)).cast("double")))
        place = F.col("_place").cast("int")
        on_bound = F.col("_time") == F.get(self._at, place)
        return placed.withColumns({
            first: F.when(on_bound, F.get(self._first, place)).otherwise(F.get(self._last, place)),
            last: F.get(self._last, place),
        }).drop("_time", "_place")


def _slots(times: DataFrame, n: int) -> _Slots:
    shares = [i / n for i in range(1, n)]
    return _Slots(times.approxQuantile("_t", shares, 1 / (4 * n)) if shares else [])


def assign_as_of(
    posts: DataFrame,
    windows: DataFrame,
    *,
    base_ms: int,
    before: int,
    other: int,
    time: str = "timestamp_ms",
    bounds: str = HALF_OPEN,
    slots: int | None = None,
) -> DataFrame:
    """As :func:`eventpulse.operators.windows.assign_from_table`, by a merge instead of a join.

    Windows ``(bucket, lo_ms, hi_ms)`` must be disjoint. Neither side is broadcast nor cut into cells:
    both are shuffled once, together. An unusable time is ``other``.
    """
    if bounds not in (HALF_OPEN, OPEN):
        raise ValueError(f"bounds must be {HALF_OPEN!r} or {OPEN!r}, not {bounds!r}")
    spark = posts.sparkSession
    n = slots or SLOTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = posts.columns
    placed = posts.withColumn("_z", event_millis(time) - F.lit(base_ms))
    cut = _slots(placed.select(F.col("_z").cast("double").alias("_t")), n)

    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 31))
    points = cut.add(placed, "_z", "_first", "_last").withColumn(
        "_slot",
        F.when(F.col("_z").isNull(), spread % cut.n)
        .otherwise(F.col("_first") + spread % (F.col("_last") - F.col("_first") + 1)).cast("int"),
    ).select(*[F.col(f"`{c}`") for c in own], "_z", "_slot", F.lit(1).alias("_kind"))

    # A window comes before the posts of the same time, or behind them where it does not hold them.
    kind = 2 if bounds == OPEN else 0
    spans = windows.where("lo_ms < hi_ms").select("bucket", "lo_ms", "hi_ms", (F.col("hi_ms") - 1).alias("_end"))
    spans = cut.add(cut.add(spans, "lo_ms", "_from", "_x"), "_end", "_y", "_to")
    spans = spans.select(
        F.col("lo_ms").cast("bigint").alias("_z"), F.explode(F.sequence("_from", "_to")).alias("_slot"),
        F.lit(kind).alias("_kind"), F.struct(F.col("hi_ms"), F.col("bucket")).alias("_window"),
    )

    merged = points.unionByName(spans, allowMissingColumns=True)
    so_far = Window.partitionBy("_slot").orderBy("_z", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    opened = merged.withColumn("_open", F.last("_window", ignorenulls=True).over(so_far)).where("_kind = 1")
    missing = F.when(F.col("_z") < 0, F.lit(before)).otherwise(F.lit(other))
    bucket: Column = F.when(F.col("_z") < F.col("_open.hi_ms"), F.col("_open.bucket")).otherwise(missing)
    return opened.select(*[F.col(f"`{c}`") for c in own], bucket.cast("int").alias("bucket"))

