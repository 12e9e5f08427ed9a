"""Time strings, keys and differences. Unparsable text never fails a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats of the data. `H` reads both `5` and `05`.
TIME_IN = "yyyy-MM-dd H:mm:ss"
TIME_OUT = "yyyy-MM-dd HH:mm:ss"
DATE = "yyyy-MM-dd"
DATE_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"
HOUR_KEY = "yyyy-MM-dd_HH"


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIME_IN))


def parse_date(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(DATE)).cast("date")


def parse_date_key(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(DATE_KEY)).cast("date")


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_OUT)


def format_date(ts: Column) -> Column:
    return F.date_format(ts, DATE)


def date_key(ts: Column) -> Column:
    return F.date_format(ts, DATE_KEY)


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_KEY)


def hour_key(ts: Column) -> Column:
    return F.date_format(ts, HOUR_KEY)


def is_before(left: Column, right: Column) -> Column:
    """Whether time text ``left`` is earlier than ``right``; false if either is unparsable."""
    return F.coalesce(parse_time(left) < parse_time(right), F.lit(False))


def is_after(left: Column, right: Column) -> Column:
    return F.coalesce(parse_time(left) > parse_time(right), F.lit(False))


def minus_seconds(later: Column, earlier: Column) -> Column:
    """Difference of two time texts in whole seconds; 0 if either is unparsable."""
    seconds = F.unix_timestamp(parse_time(later)) - F.unix_timestamp(parse_time(earlier))
    return F.coalesce(seconds, F.lit(0)).cast("bigint")


def today(now: Column | None = None) -> Column:
    """Date text of ``now`` (default: the query's start), as used for default ranges."""
    return format_date(F.current_timestamp() if now is None else now)


def yesterday(now: Column | None = None) -> Column:
    return format_date(F.date_sub(F.current_timestamp() if now is None else now, 1))
