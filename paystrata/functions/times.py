"""Event-time text and dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wire format of event and arrival times, and of the report.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
REPORT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
_USUAL_TIME = r"\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{1,3}Z\z"


def parse_event_time(text: Column) -> Column:
    """Timestamp of ``text``, or NULL where it does not have the wire format.

    ``to_timestamp`` raises under ANSI mode, which would let one bad message
    kill a stream. Texts of the usual form are cast, which gives the same times and is
    far cheaper than a pattern; the pattern reads all others.
    """
    cast = F.left(text, F.length(text) - 1).try_cast("timestamp")
    return F.when(text.rlike(_USUAL_TIME), cast).otherwise(F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN)))


def event_time_text(moment: Column) -> Column:
    """Wire text of a timestamp; sub-millisecond digits are cut, not rounded."""
    return F.date_format(moment, EVENT_TIME_PATTERN)


def days_before(moment: Column, days: Column) -> Column:
    return moment - F.make_dt_interval(days=days)


def event_hour(text: Column) -> Column:
    return F.hour(parse_event_time(text))


def report_time() -> Column:
    """Now, as ISO text with offset. The session runs in UTC."""
    return F.date_format(F.current_timestamp(), REPORT_TIME_PATTERN)


def parse_logical_date(text: str) -> dt.date:
    """``YYYY-MM-DD`` as a date; any other text raises ``ValueError``."""
    return dt.datetime.strptime(text, "%Y-%m-%d").date()
