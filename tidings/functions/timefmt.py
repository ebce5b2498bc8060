"""Timestamp parsing for feed values: ISO-8601, RFC-2822 and epoch seconds, all to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.functions.text import py_strip

# Month names and the zone names of RFC-2822 mail dates (hours from UTC).
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_HOURS = {"Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
              "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}

_CLOCK = r"(?:[T ]([0-9]{2})(?::([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?)?(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?"
_CLOCK_BASIC = r"(?:[T ]([0-9]{2})(?:([0-9]{2})(?:([0-9]{2})(?:[.,]([0-9]+))?)?)?(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?"
ISO_EXTENDED = r"\A([0-9]{4})-([0-9]{2})-([0-9]{2})" + _CLOCK + r"\z"
ISO_BASIC = r"\A([0-9]{4})([0-9]{2})([0-9]{2})" + _CLOCK_BASIC + r"\z"
MAIL_DATE = (r"(?i)\A(?:[a-z]{3,9},?\s+)?([0-9]{1,2})[\s-]+([a-z]{3})[a-z]*[\s-]+([0-9]{4}|[0-9]{2})\s+"
             r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?(?:\s+([a-z]{1,5}|[+-][0-9]{4}))?\z")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_MARK = "\u0001"  # between the groups of a match; a value that holds one is no timestamp


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def _groups(s: Column, pattern: str, n: int) -> Column:
    """The ``n`` groups of a match by one pass of the pattern, as an array; another length where it does not match."""
    return F.split(F.regexp_replace(s, pattern, _MARK.join(f"${i}" for i in range(1, n + 1))), _MARK)


def _int(part: Column) -> Column:
    return F.when(part == "", F.lit(0)).otherwise(part.try_cast("int"))


def _offset(zone: Column) -> Column:
    """``+HH:MM`` of ``Z``, ``+HH``, ``+HHMM``, ``+HH:MM`` or a known zone name; anything else is UTC."""
    digits = F.regexp_replace(zone, ":", "")
    hours = F.create_map(*[F.lit(x) for name, h in ZONE_HOURS.items() for x in (name, f"{h:+03d}:00")])
    numeric = F.concat(F.substring(digits, 1, 3), F.lit(":"), F.coalesce(F.nullif(F.substring(digits, 4, 2), F.lit("")), F.lit("00")))
    return F.when(digits.rlike(r"\A[+-]"), numeric).otherwise(F.coalesce(F.try_element_at(hours, F.upper(zone)), F.lit("+00:00")))


def _iso(s: Column, pattern: str) -> Column:
    def made(g: Column) -> Column:
        fraction = F.rpad(F.substring(F.get(g, 6), 1, 6), 6, "0")
        seconds = _int(F.get(g, 5)).cast("decimal(8,6)") + (fraction.try_cast("int") / 1_000_000).cast("decimal(8,6)")
        return F.when(F.size(g) == 8, F.try_make_timestamp(_int(F.get(g, 0)), _int(F.get(g, 1)), _int(F.get(g, 2)), _int(F.get(g, 3)), _int(F.get(g, 4)), seconds.cast("decimal(8,6)"), _offset(F.get(g, 7))))

    return _bound(_groups(s, pattern, 8), made)


def _mail(s: Column) -> Column:
    def made(g: Column) -> Column:
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.get(g, 1))).cast("int")
        year, short = _int(F.get(g, 2)), F.length(F.get(g, 2)) == 2
        year = F.when(short & (year > 68), year + 1900).when(short, year + 2000).otherwise(year)
        return F.when((F.size(g) == 7) & (month > 0), F.try_make_timestamp(
            year, month, _int(F.get(g, 0)), _int(F.get(g, 3)), _int(F.get(g, 4)), _int(F.get(g, 5)).cast("decimal(8,6)"), _offset(F.get(g, 6))))

    return _bound(_groups(s, MAIL_DATE, 7), made)


def parse_ts(col) -> Column:
    """String to an instant: ISO-8601 (extended or basic) or a mail date (weekday, seconds and zone optional,
    named or numeric zone). Values without a zone are UTC in any session; anything else (``2024``, ``12:30``)
    is null."""
    s = py_strip(_c(col))
    return _bound(F.when(~F.contains(s, F.lit(_MARK)), s), lambda s: F.coalesce(_iso(s, ISO_EXTENDED), _iso(s, ISO_BASIC), _mail(s)))


def coerce_ts(df, col: str) -> Column:
    """Dispatch on the column's type: strings are parsed, timestamps kept (naive = UTC), numbers are epoch seconds."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.StringType):
        return parse_ts(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_timestamp(F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z")))
    if isinstance(dtype, T.TimestampType):
        return c
    if isinstance(dtype, (T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType)):
        return F.timestamp_micros((c.cast("double") * 1_000_000).cast("long"))
    raise TypeError(f"unsupported timestamp type: {dtype}")
