"""Time conversions on BIGINT epoch milliseconds, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panewise.schema import DATE_KEY_FORMAT, TIME_TEXT_FORMAT

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_ms_from_ntz(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch ms (truncating sub-millisecond digits)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_NTZ_EPOCH), ts)


def timestamp_to_ms(ts: Column) -> Column:
    """TIMESTAMP (an instant) -> epoch ms."""
    return F.unix_millis(ts)


def ms_to_timestamp(ms: Column) -> Column:
    """Epoch ms -> TIMESTAMP, the event-time column for windows and watermarks."""
    return F.timestamp_millis(ms)


def _ms_to_ntz(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, F.expr(_NTZ_EPOCH))


def ms_to_text(ms: Column, fmt: str = TIME_TEXT_FORMAT) -> Column:
    """Epoch ms -> UTC text ``yyyy-MM-dd HH:mm:ss`` whatever the session time zone is."""
    return F.date_format(_ms_to_ntz(ms), fmt)


def date_key(ms: Column) -> Column:
    """Epoch ms -> UTC ``yyyyMMdd`` partition key."""
    return F.date_format(_ms_to_ntz(ms), DATE_KEY_FORMAT)


def utc_date(ms: Column) -> Column:
    """Epoch ms -> DATE of the UTC day, whatever the session time zone is."""
    return F.to_date(_ms_to_ntz(ms))
