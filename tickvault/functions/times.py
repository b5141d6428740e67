"""Time parsing and formatting.

The engine keeps UTC wall-clock time as TIMESTAMP_NTZ with microseconds. A text is parsed whole:
fraction and zone count, anything else after them makes it NULL (not an error under ANSI). Text
without a zone is UTC, whatever the session zone is.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text patterns of the sources.
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"        # 2024-01-01T00:00:00Z  (tickers, posts)
ISO_SPACE = "yyyy-MM-dd HH:mm:ss"          # 2024-01-01 00:00:00   (metadata rows, tweets)
ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?(?:Z|[+-]\d{2}:?\d{2})?$"
ISO_ZONE = r"(?:Z|[+-]\d{2}:?\d{2})$"
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_iso(c) -> Column:
    """X1: 'T' -> ' ' and drop a trailing 'Z' / '+00:00' zone suffix."""
    return F.regexp_replace(F.translate(_col(c), "T", " "), "(Z|\\+00:00)$", "")


def parse_iso(c) -> Column:
    """ISO text (with 'T' or ' ', optional fraction, optional Z or offset) -> TIMESTAMP_NTZ.

    The whole text is parsed: an offset moves the time to UTC, a fraction is kept to the
    microsecond, and empty or malformed text (also a valid time followed by anything) gives NULL.
    """
    text = _col(c)
    zoned = F.when(text.rlike(ISO_ZONE), text).otherwise(F.concat(text, F.lit("Z")))
    instant = F.try_to_timestamp(F.when(text.rlike(ISO_TEXT), zoned))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH_NTZ))


def iso_from_epoch(seconds) -> Column:
    """Epoch seconds -> ISO text with 'Z' (UTC), independent of the session zone."""
    return to_text(epoch_to_ts(seconds), ISO_Z)


def epoch_to_ts(seconds) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_add("SECOND", _col(seconds).cast("long"), F.expr(EPOCH_NTZ))


def to_text(c, fmt: str = ISO_SPACE) -> Column:
    """T4: timestamp -> text."""
    return F.date_format(_col(c), fmt)


def ts_date(c) -> Column:
    return F.to_date(_col(c))


def month(c) -> Column:
    """First day of the month."""
    return F.trunc(_col(c), "month")


def ts_hour(c) -> Column:
    return F.hour(_col(c)).cast("int")


def days_before(anchor, days: int) -> Column:
    """T5: ``anchor - days`` as a DATE; the anchor is a parameter (never ``now()`` in a query)."""
    a = F.lit(anchor) if isinstance(anchor, str) else anchor
    return F.date_sub(F.to_date(a), days)
