"""Time expressions: epoch conversion, text parsing, UTC hour floor, ISO text.

All of them are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HOUR_US = 3_600_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Instants representable by a calendar timestamp: years 1 through 9999 (Unix seconds).
MIN_EPOCH_S, MAX_EPOCH_S = -62_135_596_800, 253_402_300_799


def epoch_in_range(c, per_second: int = 1) -> Column:
    """True when a Unix time (in 1/per_second units) maps to a year between 1 and 9999."""
    v = _c(c).cast("double")
    return v.between(F.lit(float(MIN_EPOCH_S * per_second)), F.lit(float((MAX_EPOCH_S + 1) * per_second - 1)))


def epoch_millis_to_ts(c) -> Column:
    """Unix milliseconds -> UTC instant (timestamp); out of range -> NULL, never an error."""
    ms = _c(c)
    return F.when(epoch_in_range(ms, 1000), F.timestamp_millis(ms.cast("double").try_cast("long")))


def epoch_seconds_to_ts(c) -> Column:
    """Unix seconds -> UTC instant, fractions kept to the microsecond; out of range -> NULL."""
    col = _c(c)
    return F.when(epoch_in_range(col), F.timestamp_micros((col.cast("double") * 1_000_000).try_cast("long")))


def parse_utc(c, strict: bool = True) -> Column:
    """Text -> UTC instant.

    Accepts ``2024-01-01 02:05:00``, ``2024-01-01T02:05:00`` and either with an offset
    (``+00:00``, ``Z``, ``+05:30``); text without an offset is read as UTC because the session
    time zone is pinned to UTC. Both separators may be mixed within one column.
    ``strict`` uses an ANSI cast (an unparseable value fails the job); otherwise it yields null
    and the caller quarantines the row. Text must hold a whole date: a bare time of day, which a
    cast would complete with today's date, is unparseable.
    """
    col = _c(c)
    text = col.cast("string")
    whole = F.when(text.rlike(r"^\s*[+-]?\d{4,}-\d{1,2}-\d{1,2}"), text) if not strict else \
        F.when(text.rlike(r"^\s*[+-]?\d{4,}-\d{1,2}-\d{1,2}"), text).otherwise(F.concat(F.lit("no date: "), text))
    return whole.cast("timestamp") if strict else whole.try_cast("timestamp")


def floor_hour(c) -> Column:
    """Floor a UTC instant to the hour by instant arithmetic (independent of session zone)."""
    us = F.unix_micros(_c(c))
    return F.timestamp_micros(us - F.pmod(us, F.lit(_HOUR_US)))


def floor_hour_ntz(c) -> Column:
    """Floor a wall-clock (timestamp_ntz) value to the hour, keeping the ntz type."""
    return F.date_trunc("hour", _c(c)).cast("timestamp_ntz")


def floor_hour_of(df: DataFrame, name: str) -> Column:
    """Type-directed floor for column ``name`` of ``df``: text is parsed (strict), ntz stays ntz."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return floor_hour_ntz(name)
    if isinstance(dtype, T.StringType):
        return floor_hour(parse_utc(name, strict=True))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        raise TypeError(f"column {name!r} holds epoch numbers; convert with epoch_*_to_ts first")
    return floor_hour(F.col(name).cast("timestamp"))


def iso_utc_text(c) -> Column:
    """UTC instant -> ``yyyy-MM-ddTHH:mm:ss+00:00`` text (export form; storage keeps the type)."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def nan_to_null(c) -> Column:
    """NaN -> NULL so a NaN can never satisfy a NOT NULL column."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


__all__ = [
    "epoch_in_range", "epoch_millis_to_ts", "epoch_seconds_to_ts", "parse_utc", "floor_hour", "floor_hour_ntz",
    "floor_hour_of", "iso_utc_text", "nan_to_null",
]
