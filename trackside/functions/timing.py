"""Durations and event times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value: the time text of a message


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_seconds(interval: str | Column) -> Column:
    """A day-time interval in seconds as double, microseconds kept."""
    return _col(interval).cast("decimal(18,6)").cast("double")


def duration_text_clean(text: str | Column) -> Column:
    """Drop every ``0 days `` from a duration text."""
    return F.replace(_col(text), F.lit("0 days "), F.lit(""))


def event_time_text(ts: str | Column) -> Column:
    """An event time as message text, in whole seconds."""
    return F.date_format(_col(ts), TEXT_FORMAT)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 in the session time zone (pin it to UTC)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Make `ts` the event time of a stream, with a watermark `delay` behind it.

    A zone-less column is cast first, since a watermark does not take one. On a
    batch frame the watermark has no effect.
    """
    if dict(df.dtypes)[ts] != "timestamp":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)
