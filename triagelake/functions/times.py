"""Timestamp conversions, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_timestamp(iso: Column, epoch_ms: Column) -> Column:
    """ISO text (its offset respected), else epoch milliseconds, else null."""
    return F.coalesce(F.try_to_timestamp(iso), F.timestamp_millis(epoch_ms.try_cast("bigint")))


def doc_timestamp(raw: Column, unit: str = "ms") -> Column:
    """A document time given as an epoch (whole or floating, in "s", "ms" or "us") or as ISO text; null when neither."""
    text = raw.cast("string")
    epoch = F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    from_epoch = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit]
    return F.coalesce(from_epoch(epoch), F.try_to_timestamp(text))


def to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def to_epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts)


def epoch_ms_to_iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss")


def minutes(n: float) -> Column:
    """A day-time interval of `n` minutes."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n * 60))


def bucket_start(ts: Column, width: str) -> Column:
    """Start of the epoch-aligned bucket a timestamp falls in."""
    return F.window(ts, width)["start"]


def utc_day(ts: Column) -> Column:
    """The UTC day of a time, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))
