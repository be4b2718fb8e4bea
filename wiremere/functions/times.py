"""Calendar strings of a timestamp."""

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(at: datetime) -> Column:
    """A point in time as a literal. A time without zone is UTC, wherever the driver runs."""
    known = at.replace(tzinfo=UTC) if at.tzinfo is None else at
    return F.timestamp_micros(F.lit(_micros(known)))


def _micros(at: datetime) -> int:
    since = at - datetime(1970, 1, 1, tzinfo=UTC)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def year_week(ts: Column) -> Column:
    """Calendar year with ISO week, so 2024-12-30 is 2024-W01."""
    week = F.lpad(F.weekofyear(ts).cast("string"), 2, "0")
    return F.concat(F.date_format(ts, "yyyy"), F.lit("-W"), week)


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def minute(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
