"""Dates of many spellings, and the freshness window. The current time is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone names of RFC 822 dates and their offsets.
ZONES = {"UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
# Seconds of the units in "3 hours ago"; a month counts 30 days.
UNITS = {"second": 1, "sec": 1, "minute": 60, "min": 60, "hour": 3600, "hr": 3600, "day": 86400, "week": 604800, "month": 2592000}
# Words for the present.
NOW_WORDS = ["just now", "moments ago", "active today", "today"]
#: Epoch seconds of the year 9999's end, beyond which numbers are no dates.
LAST_SECOND = 253402300799


_CLOCK = r"(\d{1,2}:\d{2})(:\d{2})?"


def _stamp(day: Column, month: Column, year: Column, clock: Column, seconds: Column, zone: Column) -> Column:
    """A timestamp from the parts of an RFC 822 date. Two-digit years below 69 are of this century; a zone that is missing or has no known name is UTC."""
    offsets = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    offset = F.coalesce(F.try_element_at(offsets, F.upper(zone)), F.when(zone.rlike(r"\d"), zone), F.lit("+0000"))
    century = F.when(year.rlike(r"^\d{2}$"), F.when(year < "69", F.lit("20")).otherwise(F.lit("19"))).otherwise(F.lit(""))
    whole = F.concat(F.lpad(day, 2, "0"), F.lit(" "), F.initcap(month), F.lit(" "), century, year, F.lit(" "), F.lpad(clock, 5, "0"), F.when(seconds == "", F.lit(":00")).otherwise(seconds), offset)
    return F.try_to_timestamp(whole, F.lit("dd MMM yyyy HH:mm:ssxx"))


def _rfc(text: Column) -> Column:
    shape = rf"^(?:[A-Za-z]+\s*,\s*)?(\d{{1,2}})\s+([A-Za-z]{{3}})\s+(\d{{4}}|\d{{2}})\s+{_CLOCK}(?:\s+([+-]\d{{4}}|[A-Za-z]{{1,5}}))?$"
    return F.when(text.rlike(shape), _stamp(*(F.regexp_extract(text, shape, i) for i in range(1, 7))))


def _asctime(text: Column) -> Column:
    """As C's asctime writes it: the month before the day, the year last."""
    shape = rf"^(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),?\s+)?([A-Za-z]{{3}})\s+(\d{{1,2}})\s+{_CLOCK}\s+(\d{{4}})$"
    month, day, clock, seconds, year = (F.regexp_extract(text, shape, i) for i in range(1, 6))
    return F.when(text.rlike(shape), _stamp(day, month, year, clock, seconds, F.lit("")))


def _iso(text: Column) -> Column:
    fits = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    dated = F.regexp_replace(F.regexp_replace(text, ",", "."), r"([+-]\d{2})(\d{2})$", "$1:$2")
    dated = F.regexp_replace(dated, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})($|Z|[+-])", "$1:00$2")
    dated = F.regexp_replace(dated, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|[+-])", "$1:00$2")
    dated = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).otherwise(dated)
    return F.when(fits, dated.try_cast("timestamp"))


def _basic(text: Column) -> Column:
    """ISO 8601 without separators: 20260904T135135, with or without a zone."""
    shape = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})?(Z|[+-]\d{2}:?\d{2})?$"
    year, month, day, hour, minute, second, zone = (F.regexp_extract(text, shape, i) for i in range(1, 8))
    seconds = F.when(second == "", F.lit("")).otherwise(F.concat(F.lit(":"), second))
    whole = F.concat(F.concat_ws("-", year, month, day), F.lit("T"), hour, F.lit(":"), minute, seconds, zone)
    return F.when(text.rlike(shape), _iso(whole))


def _week(text: Column) -> Column:
    """An ISO week date, 2026-W36-5 or 2026-W36 (its Monday). Week 1 holds the fourth of January."""
    shape = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"
    year, week, day = F.regexp_extract(text, shape, 1), F.regexp_extract(text, shape, 2).try_cast("int"), F.regexp_extract(text, shape, 3)
    first = F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("timestamp"))
    days = (week - 1) * 7 + F.when(day == "", F.lit(0)).otherwise(day.try_cast("int") - 1)
    weeks = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))
    return F.when(text.rlike(shape) & (week >= 1) & (week <= weeks), first + F.make_dt_interval(days))


def parse_datetime(raw: Column, now: Column) -> Column:
    """A UTC timestamp from epoch seconds (digits), relative words, RFC 822, asctime or ISO 8601 (also week dates); null if none fits.

    A string of digits is read as seconds whatever its length, so 20240101 is a
    day in 1970 and milliseconds are no date. Spellings are tried in that order.
    """
    text = F.trim(raw)
    low = F.lower(text)
    seconds = F.when(text.rlike(r"^\d{1,18}$"), text.try_cast("long"))
    epoch = F.when(seconds <= LAST_SECOND, F.timestamp_seconds(seconds))
    pattern = rf"^(\d{{1,9}})\s+({'|'.join(UNITS)})s?\s+ago"
    amount, unit = F.regexp_extract(low, pattern, 1).try_cast("long"), F.regexp_extract(low, pattern, 2)
    scale = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    ago = F.timestamp_seconds(F.unix_micros(now) / 1_000_000 - amount * F.try_element_at(scale, unit))
    relative = F.when(low.rlike(pattern), ago).when(low.isin(NOW_WORDS), now).when(low == "yesterday", now - F.expr("INTERVAL 1 DAY"))
    return F.coalesce(epoch, relative, _rfc(text), _asctime(text), _iso(text), _basic(text), _week(text))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def is_fresh(ts: Column, now: Column, max_future_seconds: int = 3600) -> Column:
    """From 24 hours before now to max_future_seconds after it, both ends included."""
    return ts.between(now - F.expr("INTERVAL 24 HOURS"), now + F.expr(f"INTERVAL {int(max_future_seconds)} SECONDS"))


def pad_date(text: Column) -> Column:
    """A bare date gets midnight UTC; other text is unchanged."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00Z"))).otherwise(text)
