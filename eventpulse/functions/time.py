"""Column expressions on event time."""

from pyspark.sql import Column, functions as F

from eventpulse._columns import ColumnOrName, as_column


def event_millis(timestamp: ColumnOrName) -> Column:
    """Epoch milliseconds from a string or number; null when it is not a number."""
    return as_column(timestamp).try_cast("bigint")


def millis_of_ntz(ts: ColumnOrName) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` read as UTC, rounded down.

    Subtracting two zone-less timestamps never consults the session time zone,
    unlike a cast to ``timestamp``. Whole seconds and the rest are converted
    apart, all in integer arithmetic, so no date overflows and none is rounded.
    """
    second = F.expr("INTERVAL '1' SECOND")
    since = as_column(ts) - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    whole = _seconds(since)
    # Between 0 and 2 seconds, as `whole` is cut towards 1970; so the cut rounds down.
    rest = since - whole * second + second
    return whole * 1000 + _seconds(rest * 1000) - 1000


def _seconds(interval: Column) -> Column:
    return interval.cast("interval second").cast("bigint")
