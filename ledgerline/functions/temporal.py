"""Time helpers: ISO parsing to NTZ, intervals, the extract bound."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EPOCH

# ISO text as the reference's parser takes it: date, optionally one separator character, a time
# to the microsecond, and an offset; the basic form has no dashes and colons.
_CLOCK = r"[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?|[0-9]{2}([0-9]{2}([.,][0-9]+)?)?)?"
_ZONE = r"(Z|[+-][0-9]{2}(:[0-9]{2}(:[0-9]{2})?|[0-9]{2}([0-9]{2})?)?)?"
_ISO = f"(?s)^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}})(.{_CLOCK}{_ZONE})?$"


def ntz(value: _dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def minutes(m: int | float | Column) -> Column:
    """A day-time interval of ``m`` minutes."""
    m = m if isinstance(m, Column) else F.lit(m)
    return F.make_dt_interval(F.lit(0), F.lit(0), m)


def _since_epoch(seconds: Column) -> Column:
    """UTC wall clock of an instant in seconds, free of the session's zone."""
    return ntz(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once. Without it the optimizer copies a computed
    ``value`` into each place that names it, in every filter and projection above it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _parse_text(c: Column) -> Column:
    """One match decides; the parts are then cut out by position."""
    two = lambda text, at: F.substring(text, at, 2)

    def parse(x: Column) -> Column:
        width = F.when(F.substring(x, 5, 1) == "-", 10).otherwise(8)
        date = F.replace(F.substring(x, F.lit(1), width), F.lit("-"), F.lit(""))
        rest = F.substring(x, width + 2, F.length(x))
        return _let(rest, lambda r: _let(F.substring_index(F.translate(r, "Z+-,", "|||."), "|", 1), lambda clock: moment(date, r, clock)))

    def moment(date: Column, rest: Column, clock: Column) -> Column:
        whole = F.substring_index(clock, ".", 1)
        time = F.rpad(F.replace(whole, F.lit(":"), F.lit("")), 6, "0")
        micros = F.rpad(F.substring(clock, F.length(whole) + 2, F.lit(6)), 6, "0")
        digits = lambda text, *ats: [two(text, at) for at in ats]
        day, hour = _let(date, lambda d: F.concat_ws("-", F.substring(d, 1, 4), *digits(d, 5, 7))), _let(time, lambda t: F.concat_ws(":", *digits(t, 1, 3, 5)))
        local = F.concat(day, F.lit(" "), hour, F.lit("."), micros).try_cast(T.TimestampNTZType())
        zone = F.substring(rest, F.length(clock) + 1, F.length(rest))
        return F.when(F.length(zone) <= 1, local).otherwise(_let(zone, lambda z: shifted(local, z)))

    def shifted(local: Column, zone: Column) -> Column:
        digits = F.translate(zone, "+-:", "")
        sign = F.when(zone.startswith("-"), -1).otherwise(1)
        hours, mins, secs = (F.coalesce(two(digits, at).try_cast("int"), F.lit(0)) for at in (1, 3, 5))
        shift = F.make_dt_interval(F.lit(0), sign * hours, sign * mins, (sign * secs).cast("decimal(18,6)"))
        # an offset of a day or more is no offset
        return F.when((hours < 24) & (mins < 60) & (secs < 60), local - shift)

    return _let(c, lambda x: F.when(x.rlike(_ISO), parse(x)))


def parse_iso(c: Column, dtype: T.DataType) -> Column:
    """ISO-8601 text to UTC wall-clock NTZ, the same in every session zone.

    Text with an offset is read as an instant and shifted to UTC; text without one is
    taken as it is. Typed times pass through; an instant becomes its UTC wall clock. Null
    when the text is no ISO date or date and time.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return _since_epoch(F.unix_micros(c).cast("decimal(24,6)") / 1_000_000)
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return _parse_text(c)
    if isinstance(dtype, T.NumericType):
        # Epoch seconds, or milliseconds beyond 2e10 (the lax datetime rule of the contract).
        return _since_epoch(F.when(F.abs(c) > 2e10, c / 1000).otherwise(c))
    return F.lit(None).cast("timestamp_ntz")


def extract_since(last_completed: Column, overlap_minutes: int) -> Column:
    """K2: the lower bound of an extract, ``coalesce(last, epoch) - overlap``."""
    return F.coalesce(last_completed, ntz(EPOCH)) - minutes(overlap_minutes)
