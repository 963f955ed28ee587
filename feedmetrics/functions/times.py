"""Timestamps, dates and time windows. All of it assumes a UTC session."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from feedmetrics.functions.text import strip

# Years 0001-9999, the span of ISO text.
_MIN_EPOCH, _MAX_EPOCH = -62135596800, 253402300799

# The usual form, which Spark's own cast takes; then any: calendar or week date, with hyphens or without; any one character; a time with
# colons or without, down to its hours; an offset. A date is read in one way only, hence the atomic groups.
_COMMON = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}([.]\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
_CLOCK = (r"(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
          r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)$")
_CALENDAR = r"^(?>(\d{4})(-?)(\d{2})\2(\d{2}).(?=\d))" + _CLOCK
_WEEK = r"^(?>(\d{4})(-?)W(\d{2})(?:\2(\d))?.(?=\d))" + _CLOCK
_PARTS = "|".join(f"${group}" for group in (1, 3, 4, 5, 7, 8, 9, 10))


def utc_text(ts: Column) -> Column:
    """ISO text with ``Z``; the fraction appears only when it is not zero."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
        F.lit("Z"))


def epoch_timestamp(seconds: Column) -> Column:
    """Bigint epoch seconds -> timestamp, null outside the ISO years."""
    return F.timestamp_seconds(F.when(seconds.between(_MIN_EPOCH, _MAX_EPOCH), seconds))


def epoch_text(seconds: Column) -> Column:
    return F.date_format(epoch_timestamp(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _week_day(year: Column, week: Column, day: Column) -> Column:
    """Date of an ISO week date; null where the year has no such week, or the week no such day."""
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in week 1
    date = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7 + day - 1)
    return F.when(day.between(1, 7) & (F.extract(F.lit("YEAROFWEEK"), date) == year), date)


def _stamped(value: Column, pattern: str, date_of: Callable[[Column, Column, Column], Column]) -> Column:
    """Timestamp of a text of this pattern, whose parts are put into the form that Spark's parser takes."""

    def stamp_of(parts: Column) -> Column:
        minute, second, fraction = (F.when(parts[i] == "", "00").otherwise(parts[i]) for i in (4, 5, 6))
        return F.try_to_timestamp(F.concat(
            date_of(parts[0], parts[1], parts[2]), F.lit(" "), parts[3], F.lit(":"), minute, F.lit(":"), second,
            F.lit("."), fraction, parts[7]))

    # Bound by the lambda: taken apart once, however often a part is used.
    return F.get(F.transform(F.array(F.split(F.regexp_replace(value, pattern, _PARTS), "[|]")), stamp_of), 0)


def _calendar_date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day)


def _week_date(year: Column, week: Column, day: Column) -> Column:
    number = F.coalesce(day.try_cast("int"), F.lit(1))
    return F.date_format(_week_day(year.try_cast("int"), week.try_cast("int"), number), "yyyy-MM-dd")


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text -> timestamp; null when malformed or without an offset.

    The usual form is one match and a cast. Others are taken apart by one
    pattern. Without an offset Spark would read the text in the session zone.
    Offsets beyond 18 hours stay null.
    """
    value = strip(text)
    return (F.when(value.rlike(_COMMON), value.try_cast("timestamp"))
            .when(value.rlike(_CALENDAR), _stamped(value, _CALENDAR, _calendar_date))
            .when(value.rlike(_WEEK), _stamped(value, _WEEK, _week_date)))


def iso_text(text: Column) -> Column:
    return utc_text(iso_timestamp(text))


def part_columns(ts: Column) -> dict[str, Column]:
    """Zero-padded year/month/day text of a timestamp."""
    return {"year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd")}


def day_of(text: Column) -> Column:
    """``YYYY-MM-DD`` text -> date, null for any other form or a bad day."""
    value = strip(text)
    return F.when(value.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}$"), value.try_cast("date"))


def date_part_columns(text: Column) -> dict[str, Column]:
    """year/month/day text of ``YYYY-MM-DD`` text, nulls when invalid."""
    value, valid = strip(text), day_of(text).isNotNull()
    return {"year": F.when(valid, F.substring(value, 1, 4)),
            "month": F.when(valid, F.substring(value, 6, 2)),
            "day": F.when(valid, F.substring(value, 9, 2))}


def hour_windows(day: Column) -> Column:
    """The 24 window starts (timestamps) of a date."""
    start = day.cast("timestamp")
    return F.sequence(start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))


# --- parameters of a run, resolved on the driver --------------------------

def parse_day(value: str, name: str = "data_date") -> dt.date:
    if not isinstance(value, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value.strip()):
        raise ValueError(f"{name} is not a day like 2026-05-20: {value!r}")
    try:
        return dt.date.fromisoformat(value.strip())
    except ValueError as error:
        raise ValueError(f"{name} is not a day like 2026-05-20: {value!r}") from error


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def default_dates(now: dt.datetime | None = None) -> tuple[str, str]:
    """(yesterday, today) in UTC: the default data and ingest dates."""
    today = (now or utc_now()).astimezone(dt.timezone.utc).date()
    return (today - dt.timedelta(days=1)).isoformat(), today.isoformat()


def stamp(now: dt.datetime | None = None) -> str:
    moment = (now or utc_now()).astimezone(dt.timezone.utc)
    fraction = f".{moment.microsecond:06d}" if moment.microsecond else ""
    return f"{moment:%Y-%m-%dT%H:%M:%S}{fraction}Z"


_EPOCH, _DAY_SECONDS = dt.date(1970, 1, 1), 86_400


def day_epoch_range(day: str) -> tuple[int, int]:
    """Epoch seconds at which a UTC day begins and the next one does."""
    number = (parse_day(day) - _EPOCH).days
    return number * _DAY_SECONDS, (number + 1) * _DAY_SECONDS
