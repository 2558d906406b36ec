"""Scalar column functions (F2–F11).  All are built-in expressions (JVM-side,
inside whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kestrel.fixed import (BAR_GLYPH, BAR_STEP, CSV_STAMP as COMPACT, ENTITY_ID_FORMAT, ISO_Z,
                           PLACEHOLDER_SECOND, TAG_AT, TAG_PREFIX, TIME_TEXT_LENGTH)


# F2
def tag_processed(text: Column, at: Column) -> Column:
    """'Processed: <text>' and then ' at <ISO time>'."""
    return F.concat(F.lit(TAG_PREFIX), text, F.lit(TAG_AT), F.date_format(at, ISO_Z))


# F3
def bar(pct: Column) -> Column:
    """One glyph per 5 percent (floor)."""
    return F.repeat(F.lit(BAR_GLYPH), F.floor(pct / BAR_STEP).cast("int"))


def first_chars(text: Column, n: int = TIME_TEXT_LENGTH) -> Column:
    return F.substring(text, 1, n)


# F4
def sensor_columns(name: Column) -> tuple[Column, Column]:
    return F.concat(name, F.lit("_min")), F.concat(name, F.lit("_max"))


def entity_id(n: Column, fmt: str = ENTITY_ID_FORMAT) -> Column:
    """Zero-padded entity id ('user_%04d'); never truncates wider numbers (unlike lpad)."""
    return F.format_string(fmt, n)


# F5
def iso_z(ts: Column) -> Column:
    return F.date_format(ts, ISO_Z)


def compact_stamp(ts: Column) -> Column:
    return F.date_format(ts, COMPACT)


def to_offset(ts_utc: Column, hours: int, minutes: int = 0) -> Column:
    """Wall-clock time at a fixed UTC offset, formatted with the offset."""
    shifted = ts_utc + F.make_interval(hours=F.lit(hours), mins=F.lit(minutes))
    sign = "+" if hours >= 0 else "-"
    return F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit(f"{sign}{abs(hours):02d}:{abs(minutes):02d}"))


def shift_to_second(ts: Column, minutes: int, second: int = PLACEHOLDER_SECOND) -> Column:
    """ts minus ``minutes``, truncated to the minute, at second ``second`` with zero fraction."""
    t = F.date_trunc("minute", ts - F.make_interval(mins=F.lit(minutes))).cast("timestamp_ntz")
    return t + F.make_interval(secs=F.lit(second))


def elapsed_seconds(start: Column, end: Column, digits: int = 2) -> Column:
    return round_half_up((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6, digits)


def round_half_away(x, digits: int) -> Column:
    """SQL ROUND as DuckDB and most engines compute it on doubles: scale, round half away
    from zero on the binary product, unscale.  Spark's ``round`` rounds the decimal text
    half up instead, which differs on exact ties such as 44.5690625 -> 6 digits.
    Double arithmetic only (``y - y % 1`` is an exact floor), so large sums cannot
    overflow a long."""
    x = F.col(x) if isinstance(x, str) else x
    f = float(10 ** digits)
    y = F.abs(x) * F.lit(f) + F.lit(0.5)
    r = (y - y % F.lit(1.0)) / F.lit(f)
    return F.when(x < 0, -r).otherwise(r)


def round_half_up(x: Column, digits: int) -> Column:
    """Half-up rounding on the binary value: floor(x * 10^d + 0.5) / 10^d.  The same
    IEEE operations in every engine give the same result (``round`` differs between
    engines on values such as 150.075 whose decimal text is a tie)."""
    f = float(10 ** digits)
    return F.floor(x * f + 0.5) / f


# F6
def clip(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(x, F.lit(hi)), F.lit(lo))


def normalized_difference(new: Column, old: Column, scale: Column) -> Column:
    return F.abs(new - old) / F.nullif(scale, F.lit(0.0))


def truncate_int(x: Column) -> Column:
    """Toward zero, like int() in Python."""
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("int")


# F7, F8
def last_element(a: Column) -> Column:
    return F.try_element_at(a, F.lit(-1))


def lookup(m: Column, key: str, default) -> Column:
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


# F10
def base64_text(s: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line (no MIME line breaks)."""
    return F.regexp_replace(F.base64(s.cast("binary")), "[\r\n]", "")


# F11
def http_status_label(code: Column) -> Column:
    return (F.when(code >= 500, "error").when(code >= 400, "warning").when(code >= 200, "success")
             .otherwise("unknown"))


def drift_label(flag: Column) -> Column:
    return F.when(flag.isNull(), "running/no result").when(flag, "drift detected").otherwise("no drift")


#: ISO 8601 instants as the services write them: seconds, an optional fraction, an optional zone.
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.]\d{1,9})?(Z|[+-]\d{2}:?\d{2})?$"


def iso_timestamp(text) -> Column:
    """TIMESTAMP_NTZ (session zone) of an ISO 8601 instant; null for any other text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike(ISO_INSTANT), F.try_to_timestamp(c)).cast("timestamp_ntz")
