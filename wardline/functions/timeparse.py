"""Message time parsing (lenient HL7 timestamps) and US/Central localisation.

Every function here is independent of the session time zone: HL7 digits are
assembled into a timestamp in UTC so the result's UTC wall clock equals the
digits, and ``to_utc_timestamp`` / ``from_utc_timestamp`` shift wall clocks
without consulting the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone every HL7 wall-clock time is read in, and the accepted
# layouts, for both message kinds: 14, 12 and 8 digits (yyyyMMddHHmmss,
# yyyyMMddHHmm, yyyyMMdd) and ISO dates and date-times. An ISO time's zone is
# read where the time is an instant (XML received time) and makes a wall clock
# NULL. Anything else (years, months, bare clock times) is NULL.
CENTRAL = "US/Central"
DIGITS = r"^([0-9]{14}|[0-9]{12}|[0-9]{8})$"
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?"


def wall_clock(x: Column) -> Column:
    """Time text without a zone -> TIMESTAMP whose UTC wall clock equals it, or NULL.

    8 and 12 digits are padded to 14 (midnight, whole minute) so one parse
    pattern serves all three layouts; ISO forms are padded alike.
    """
    digits = F.regexp_extract(x, DIGITS, 1)
    iso = F.regexp_extract(x, ISO + "$", 0)
    rest = F.substr(F.lit("0000-00-00T00:00:00"), F.length(iso) + 1)
    # without digits nothing is tried: a failed try is an exception, which costs more than all the rest
    from_digits = F.when(digits != "", F.try_to_timestamp(F.concat(F.rpad(digits, 14, "0"), F.lit("+0000")), F.lit("yyyyMMddHHmmssZ")))
    return F.coalesce(from_digits, F.when(iso != "", F.concat(iso, rest, F.lit("Z")).try_cast("timestamp")))


def localize(w: Column, tz: str = CENTRAL) -> Column:
    """Wall clock (as UTC wall clock) -> instant in ``tz``.

    In the repeated autumn hour the standard-time (later) instant wins, as a
    non-DST localisation does; a skipped spring hour keeps the standard
    offset, i.e. moves forward. Spark resolves an overlap to the earlier
    instant, so the later one is found by converting one hour later and
    stepping back; the greater of the two is the answer in every case.
    """
    hour = F.expr("INTERVAL '1' HOUR")
    return F.greatest(F.to_utc_timestamp(w, tz), F.to_utc_timestamp(w + hour, tz) - hour)


def hl7_time(x: Column, tz: str = CENTRAL) -> Column:
    """C1 + C2: lenient HL7 timestamp text -> instant, NULL when unparseable."""
    return localize(wall_clock(x), tz)


def iso_time(x: Column) -> Column:
    """XML ReceivedDateTime: the same layouts as an instant; an ISO zone is honoured, without one it is UTC."""
    zoned = F.regexp_extract(x, ISO + r"(?:Z|[+-][0-9]{2}:?[0-9]{2})$", 0)
    colon = F.regexp_replace(zoned, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    return F.coalesce(F.when(zoned != "", colon.try_cast("timestamp")), wall_clock(x))


def utc_ntz(ts: Column) -> Column:
    """Instant -> TIMESTAMP_NTZ holding its UTC wall clock, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
