"""Event time to named window, and counts per window."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventpulse._columns import ColumnOrName, as_column
from eventpulse.calendars import (
    BEFORE_NAME, OTHER_NAME, TOURNAMENT, UNKNOWN_NAME, Calendar,
)
from eventpulse.functions.time import event_millis

HALF_OPEN = "half_open"
OPEN = "open"


def bucket_sql(calendar: Calendar, millis: str, bounds: str = HALF_OPEN) -> str:
    """SQL text giving the bucket of ``millis``, an SQL expression of epoch milliseconds.

    The calendar becomes a search tree of comparisons, about six per row for 45
    windows: no join, no broadcast, usable on a stream.
    ``bounds="open"`` leaves a time exactly on the start of a window, or on its
    end, to ``other``; the default counts the start to the window.
    """
    if bounds not in (HALF_OPEN, OPEN):
        raise ValueError(f"bounds must be {HALF_OPEN!r} or {OPEN!r}, not {bounds!r}")
    base, before, other = calendar.base_ms, calendar.before, calendar.other

    # Segments of the time axis: each starts at its number and ends at the next.
    segments: list[tuple[int | None, int]] = [(None, before)]
    end = 0
    for bucket, (_, lo, hi) in enumerate(calendar.windows):
        if lo > end:
            segments.append((base + end, other))
        segments.append((base + lo, bucket))
        end = hi
    segments.append((base + end, other))

    def leaf(start: int | None, bucket: int) -> str:
        if bounds == OPEN and bucket < before:
            return f"CASE WHEN {millis} > {start} THEN {bucket} ELSE {other} END"
        return str(bucket)

    def tree(first: int, last: int) -> str:
        if first == last:
            return leaf(*segments[first])
        middle = (first + last + 1) // 2
        return (
            f"CASE WHEN {millis} < {segments[middle][0]} THEN {tree(first, middle - 1)} "
            f"ELSE {tree(middle, last)} END"
        )

    return f"CASE WHEN {millis} IS NULL THEN {other} ELSE {tree(0, len(segments) - 1)} END"


@dataclass(frozen=True)
class WindowTable:
    """A calendar of any size: disjoint windows as a table ``(bucket, name, lo_ms, hi_ms)``.

    Bucket ids count from 0; the two after the largest are ``before`` and ``other``.
    """

    windows: DataFrame
    base_ms: int
    size: int
    before_name: str = BEFORE_NAME
    other_name: str = OTHER_NAME

    @staticmethod
    def of(windows: DataFrame, base_ms: int) -> WindowTable:
        largest = windows.agg(F.max("bucket")).first()[0]
        return WindowTable(windows, base_ms, 0 if largest is None else largest + 1)

    @property
    def before(self) -> int:
        return self.size

    @property
    def other(self) -> int:
        return self.size + 1


AnyCalendar = Calendar | WindowTable


def name_table(spark: SparkSession, calendar: AnyCalendar) -> DataFrame:
    """``(bucket, name)``, one row per bucket."""
    if isinstance(calendar, Calendar):
        return calendar_table(spark, calendar).select("bucket", "name")
    rest = F.array(*[
        F.struct(F.lit(b).alias("bucket"), F.lit(n).alias("name"))
        for b, n in ((calendar.before, calendar.before_name), (calendar.other, calendar.other_name))
    ])
    return calendar.windows.select(F.col("bucket").cast("int").alias("bucket"), "name").unionByName(
        spark.range(1, numPartitions=1).select(F.inline(rest))
    )


def with_bucket(
    posts: DataFrame,
    calendar: AnyCalendar = TOURNAMENT,
    *,
    time: str = "timestamp_ms",
    bounds: str = HALF_OPEN,
    drop_bad_time: bool = False,
) -> DataFrame:
    """Add ``bucket``; posts without a usable time go to ``other`` or are dropped."""
    if isinstance(calendar, WindowTable):
        if drop_bad_time:
            posts = posts.where(event_millis(time).isNotNull())
        return assign_from_table(
            posts, calendar.windows, base_ms=calendar.base_ms, before=calendar.before,
            other=calendar.other, time=time, bounds=bounds,
        )
    # Parsed once in its own projection; the tree reads the parsed column.
    posts = posts.withColumn("_millis", event_millis(time))
    if drop_bad_time:
        posts = posts.where(F.col("_millis").isNotNull())
    return posts.withColumn("bucket", F.expr(bucket_sql(calendar, "_millis", bounds))).drop("_millis")


def rebased(
    posts: DataFrame, base_ms: int = TOURNAMENT.base_ms, time: str = "timestamp_ms"
) -> DataFrame:
    """Add ``offset_ms``, the event time relative to the base; null when unusable."""
    return posts.withColumn("offset_ms", event_millis(time) - F.lit(base_ms))


def count_per_window(
    posts: DataFrame,
    calendar: AnyCalendar = TOURNAMENT,
    *,
    time: str = "timestamp_ms",
    bounds: str = HALF_OPEN,
    drop_bad_time: bool = False,
) -> DataFrame:
    """Number of posts ``n`` per non-empty ``bucket``."""
    bucketed = with_bucket(
        posts, calendar, time=time, bounds=bounds, drop_bad_time=drop_bad_time
    )
    return bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def window_name(bucket: ColumnOrName, calendar: Calendar = TOURNAMENT) -> Column:
    """Name of a bucket, ``error`` for an unknown one."""
    names = F.array(*[F.lit(n) for n in calendar.names])
    return F.coalesce(F.get(names, as_column(bucket).try_cast("int")), F.lit(UNKNOWN_NAME))


def bucket_of_file(name: ColumnOrName) -> Column:
    """The bucket a file is named after, with or without the ending ``.txt``."""
    return F.replace(as_column(name), F.lit(".txt"), F.lit("")).try_cast("int")


def with_window_name(
    table: DataFrame, calendar: AnyCalendar = TOURNAMENT, bucket: str = "bucket"
) -> DataFrame:
    if isinstance(calendar, WindowTable):
        names = name_table(table.sparkSession, calendar).withColumnRenamed("bucket", "_bucket")
        joined = table.join(names, F.col(f"`{bucket}`") == F.col("_bucket"), "left").drop("_bucket")
        return joined.withColumn("name", F.coalesce("name", F.lit(UNKNOWN_NAME)))
    return table.withColumn("name", window_name(bucket, calendar))


def calendar_table(spark: SparkSession, calendar: Calendar = TOURNAMENT) -> DataFrame:
    """The calendar as a table ``(bucket, name, lo_ms, hi_ms)``, one row per bucket."""
    lows = [w[1] for w in calendar.windows]
    highs = [w[2] for w in calendar.windows]

    def pick(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("bucket"))

    return (
        spark.range(len(calendar.names), numPartitions=1)
        .select(F.col("id").cast("int").alias("bucket"))
        .select(
            "bucket",
            pick(calendar.names).alias("name"),
            pick(lows).cast("bigint").alias("lo_ms"),
            F.when(F.col("bucket") == calendar.before, F.lit(0))
            .otherwise(pick(highs)).cast("bigint").alias("hi_ms"),
        )
    )


# ---- calendars that are tables ------------------------------------------------

# A broadcast window table has at most this many (window, cell) rows of 28 bytes.
MAX_BROADCAST_CELLS = 300_000


def overlapping_windows(windows: DataFrame) -> DataFrame:
    """Windows that start before an earlier one has ended; empty for a valid table."""
    cell = _cell_width(windows)
    if cell is None:
        return windows.limit(0)
    earlier = Window.partitionBy("_cell").orderBy("lo_ms", "hi_ms", "bucket")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return (
        _in_cells(windows, cell)
        .withColumn("_end", F.max("hi_ms").over(before))
        .where("lo_ms < _end")
        .select(*windows.columns)
        .distinct()
    )


def assign_from_table(
    posts: DataFrame,
    windows: DataFrame,
    *,
    base_ms: int,
    before: int,
    other: int,
    time: str = "timestamp_ms",
    bounds: str = HALF_OPEN,
    max_broadcast_cells: int = MAX_BROADCAST_CELLS,
) -> DataFrame:
    """As :func:`with_bucket` for a window table ``(bucket, lo_ms, hi_ms)`` of any size.

    The point-in-interval lookup becomes an equi-join on time cells, then the bounds are checked:
    for every power of two among the lengths of the windows there are cells of that width. A
    window lies in at most two of them and, as windows are disjoint, a cell has at most three,
    however unequal the lengths are. A table within the bound is broadcast, a width at a time.
    Beyond it, the distinct times are joined to the cells of all widths at once and the posts to
    what was found, so the posts are shuffled once, whatever the lengths.
    """
    offset = event_millis(time) - F.lit(base_ms)
    missing = F.when(F.col("_z") < 0, F.lit(before)).otherwise(F.lit(other))
    sized = windows.select("bucket", "lo_ms", "hi_ms", _cell_of_length().alias("_width"))
    # At most 63 rows, one per power of two.
    widths = dict(map(tuple, sized.groupBy("_width").count().collect()))
    placed = posts.withColumn("_z", offset)
    if 2 * sum(widths.values()) <= max_broadcast_cells:
        found = placed.withColumn("_bucket", F.lit(None).cast("int"))
        for width in sorted(widths):
            same = sized.where(F.col("_width") == width).drop("_width")
            found = _look_up(found, same, width, bounds)
    else:
        found = placed.join(_buckets_of_times(placed, sized, sorted(widths), bounds), "_z", "left")
    bucket = F.coalesce(F.col("_bucket"), missing).cast("int")
    return found.withColumn("bucket", bucket).select(*posts.columns, "bucket")


def _inside(time: str, lo: str, hi: str, bounds: str) -> Column:
    z = F.col(time)
    return (z > F.col(lo) if bounds == OPEN else z >= F.col(lo)) & (z < F.col(hi))


def _look_up(posts: DataFrame, windows: DataFrame, cell: int, bounds: str) -> DataFrame:
    """Fill ``_bucket`` where ``_z`` lies in one of the windows, none longer than a cell."""
    kept = [F.col(f"p.`{c}`") for c in posts.columns if c != "_bucket"]
    left = posts.withColumn("_cell", _cell_start(F.col("_z"), cell))
    right = F.broadcast(_in_cells(windows, cell))
    on = (F.col("p._cell") == F.col("w._cell")) & _inside("p._z", "w.lo_ms", "w.hi_ms", bounds)
    joined = left.alias("p").join(right.alias("w"), on, "left")
    bucket = F.coalesce(F.col("p._bucket"), F.col("w.bucket")).alias("_bucket")
    return joined.select(*kept, bucket)


def _buckets_of_times(
    placed: DataFrame, sized: DataFrame, widths: list[int], bounds: str
) -> DataFrame:
    """``(_z, _bucket)`` of every distinct time that lies in a window."""
    times = placed.select("_z").where("_z is not null").distinct()
    cells = F.explode(F.array(*[
        F.struct(F.lit(w).cast("bigint").alias("width"), _cell_start(F.col("_z"), w).alias("cell"))
        for w in widths
    ]))
    left = times.select("_z", cells.alias("c"))
    first = F.expr("lo_ms - pmod(lo_ms, _width)")
    last = F.expr("hi_ms - 1 - pmod(hi_ms - 1, _width)")
    right = sized.withColumn("_cell", F.explode(F.sequence(first, last, F.col("_width"))))
    on = (
        (F.col("c.width") == F.col("w._width")) & (F.col("c.cell") == F.col("w._cell"))
        & _inside("_z", "w.lo_ms", "w.hi_ms", bounds)
    )
    return left.join(right.alias("w"), on).select("_z", F.col("w.bucket").alias("_bucket"))


def _cell_of_length() -> Column:
    """The smallest power of two that is no less than the length of a window."""
    length = F.col("hi_ms") - F.col("lo_ms")
    digits = F.when(length <= 1, F.lit(0)).otherwise(F.length(F.bin(length - 1)))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), digits)


def _cell_width(windows: DataFrame) -> int | None:
    """The average length of a window, None where there are no windows."""
    width = windows.agg(F.avg(F.col("hi_ms") - F.col("lo_ms"))).first()[0]
    return None if width is None else math.ceil(width)


def _cell_start(millis: Column, cell: int) -> Column:
    return millis - F.pmod(millis, F.lit(cell))


def _in_cells(windows: DataFrame, cell: int) -> DataFrame:
    first = _cell_start(F.col("lo_ms"), cell)
    last = _cell_start(F.col("hi_ms") - 1, cell)
    return windows.withColumn(
        "_cell", F.explode(F.sequence(first, last, F.lit(cell).cast("bigint")))
    )


__all__ = [
    "AnyCalendar", "HALF_OPEN", "OPEN", "WindowTable", "assign_from_table", "bucket_of_file", "bucket_sql", "calendar_table",
    "count_per_window", "name_table", "overlapping_windows", "rebased", "window_name",
    "with_bucket", "with_window_name",
]
