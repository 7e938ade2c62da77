"""Timestamp helpers: ISO text in and out, calendar-day and second differences,
duration text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_text(c: str | Column) -> Column:
    """Zone-less timestamp -> ISO-8601 text ``yyyy-MM-ddTHH:mm:ss`` with a
    six-digit fraction only when it is not zero; NULL stays NULL (JSON
    null). The wall clock is printed as is: no session time zone is applied
    (``date_format`` would convert, and shift times in a DST gap)."""
    text = F.regexp_replace(_c(c).cast("timestamp_ntz").cast("string"), " ", "T")
    # The cast prints the fraction without trailing zeros; pad it to six.
    return F.when(F.instr(text, ".") > 0, F.rpad(text, 26, "0")).otherwise(text)


def wall_micros(c: str | Column) -> Column:
    """Microseconds from 1970-01-01 00:00 to a zone-less wall clock, built
    from its date and clock parts (each zone-free for TIMESTAMP_NTZ;
    ``timestamp_diff`` would pass NTZ values through the session zone)."""
    t = _c(c)
    day = F.unix_date(F.to_date(t)).cast("long")
    secs = F.date_part(F.lit("SECOND"), t)          # seconds with fraction
    return (day * 86_400_000_000 + F.hour(t).cast("long") * 3_600_000_000
            + F.minute(t).cast("long") * 60_000_000
            + (secs * 1_000_000).cast("long"))


def wall_clock(micros: Column) -> Column:
    """Inverse of ``wall_micros``: a TIMESTAMP_NTZ from microseconds."""
    day = F.floor(micros / F.lit(86_400_000_000)).cast("long")
    rem = micros - day * 86_400_000_000
    d = F.date_from_unix_date(day.cast("int"))
    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d),
        F.floor(rem / F.lit(3_600_000_000)).cast("int"),
        F.floor((rem % 3_600_000_000) / F.lit(60_000_000)).cast("int"),
        ((rem % 60_000_000) / F.lit(1_000_000)).cast("decimal(16,6)"))


def ntz_to_instant(c: str | Column) -> Column:
    """Zone-less wall clock -> the instant with that wall clock in UTC,
    independent of the session time zone."""
    return F.timestamp_micros(wall_micros(c))


def instant_to_ntz(c: str | Column) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return wall_clock(F.unix_micros(_c(c)))


def parse_ts(c: str | Column) -> Column:
    """ISO text -> zone-less timestamp; unparsable text gives NULL instead of
    an ANSI error."""
    return _c(c).try_cast("timestamp_ntz")


def calendar_days(end: str | Column, start: str | Column) -> Column:
    """Whole calendar days from ``start`` to ``end`` (23:59 -> 00:01 is one
    day); NULL when either side is NULL."""
    return F.datediff(_c(end), _c(start))


def elapsed_seconds(end: str | Column, start: str | Column) -> Column:
    """Seconds between two zone-less timestamps (wall-clock difference, as
    for SQL ``TIMESTAMP`` without zone), rounded to an integer."""
    micros = wall_micros(end) - wall_micros(start)
    return F.round(micros / F.lit(1_000_000.0)).cast("int")


def duration_text(seconds: str | Column) -> Column:
    """``MMm SSs`` with two-digit zero padding (minutes may exceed 99)."""
    s = _c(seconds)
    return F.format_string("%02dm %02ds", F.floor(s / 60).cast("int"), (s % 60).cast("int"))
