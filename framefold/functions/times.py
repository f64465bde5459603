"""Time, numeric and clamp helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framefold.constants import BATCH_TS_FORMAT
from framefold.functions.text import col


def batch_ts_text(ts) -> Column:
    return F.date_format(col(ts), BATCH_TS_FORMAT)


def batch_ts(text) -> Column:
    """Timestamp of a batch text, NULL when it is no such text."""
    return F.try_to_timestamp(col(text), F.lit(BATCH_TS_FORMAT))


def iso_ts(ts) -> Column:
    """ISO-8601 text with offset; the fraction is written only when there is one."""
    ts = col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(exact)


def display_ts(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:mm:ss")


def add_days_epoch(ts, days: int) -> Column:
    return F.unix_seconds(col(ts).cast("timestamp")) + F.lit(days * 86400)


def elapsed(start, end) -> Column:
    """Seconds from start to end, fraction kept."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return micros / F.lit(1000000.0)


def step_duration(entered, started, completed) -> Column:
    return F.coalesce(elapsed(entered, completed), elapsed(started, completed))


def ms_to_sec(ms) -> Column:
    """Milliseconds to seconds; 0 and missing are both NULL."""
    return F.nullif(col(ms), F.lit(0)) / F.lit(1000.0)


duration_sec = ms_to_sec


def clamp(value, low: int, high: int) -> Column:
    return F.greatest(F.least(col(value), F.lit(high)), F.lit(low))


def quota(batch, n_sources: int) -> Column:
    """Items per source: the floored share, at least one."""
    return F.greatest(F.lit(1), F.floor(col(batch) / F.lit(n_sources))).cast("bigint")


def event_time(value) -> Column:
    """Time of an epoch number: above 1e10 milliseconds, else seconds."""
    value = col(value).cast("double")
    micros = F.when(value > F.lit(1e10), value * F.lit(1e3)).otherwise(value * F.lit(1e6))
    return F.timestamp_micros(F.round(micros).cast("bigint"))
