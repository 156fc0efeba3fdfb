"""Date functions on kick-off text and unix seconds.

Everything runs on zone-free timestamps, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KICKOFF_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def parse_kickoff(text: Column) -> Column:
    """``2020-06-12T19:00:00Z`` as a zone-free timestamp, NULL when malformed."""
    return F.when(text.rlike(KICKOFF_PATTERN), F.substring(text, 1, 19).try_cast("timestamp_ntz"))


def kickoff_text(moment: Column) -> Column:
    plain = moment.cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(plain, 1, 10), F.lit("T"), F.substring(plain, 12, 8), F.lit("Z"))


def shift_hours(moment: Column, hours: Column | int) -> Column:
    amount = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_add("HOUR", amount, moment)


def local_kickoff(text: Column, hours: Column | int) -> Column:
    """Kick-off text moved by an offset; the trailing ``Z`` stays although the value is local."""
    return kickoff_text(shift_hours(parse_kickoff(text), hours))


def kickoff_day(text: Column) -> Column:
    return F.substring(kickoff_text(parse_kickoff(text)), 1, 10)


def kickoff_clock(text: Column) -> Column:
    return F.substring(kickoff_text(parse_kickoff(text)), 12, 8)


def unix_moment(seconds: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds.cast("bigint"), epoch)


def unix_day(seconds: Column) -> Column:
    return F.to_date(unix_moment(seconds)).cast("string")


def unix_year(seconds: Column) -> Column:
    return F.year(unix_moment(seconds))


def strict_day(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date, NULL for any other shape."""
    return F.when(text.rlike(DAY_PATTERN), text.try_cast("date"))


def compact_day(text: Column) -> Column:
    """``2020-06-12`` to ``20200612``; NULL when the text is not a day."""
    return F.replace(strict_day(text).cast("string"), F.lit("-"), F.lit(""))
