"""Time columns: lenient parsing, epoch seconds, week ids, printed stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stamp layouts of the two transcript styles.
BASIC_STAMP = "yyyy-MM-dd HH:mm"
RICH_STAMP = "yyyy-MM-dd-HH-mm-ss"


def parse_time(text: Column) -> Column:
    """Timestamp, or NULL where the text is no date."""
    return F.try_to_timestamp(text)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def week_id(ts: Column) -> Column:
    """``yyyy-ww`` with Sunday-start weeks where week 1 holds 1 January.

    The year part is the calendar year, so the last days of December can fall
    into week 01 of their own year.
    """
    d = F.to_date(ts)
    saturday = F.date_add(d, F.lit(7) - F.dayofweek(d))
    offset = F.dayofweek(F.trunc(d, "year")) - 1
    week = F.when(F.year(saturday) > F.year(d), F.lit(1)).otherwise(
        F.floor((F.dayofyear(d) - 1 + offset) / 7) + 1
    )
    return F.when(
        ts.isNotNull(),
        F.concat(F.date_format(d, "yyyy"), F.lit("-"), F.lpad(week.cast("string"), 2, "0")),
    )


def time_fields(text: Column) -> dict[str, Column]:
    """The time columns of a message, by name."""
    ts = parse_time(text)
    return {"date_timestamp": ts, "date_unixtime": epoch_seconds(ts), "week_id": week_id(ts)}


def format_epoch(seconds: Column, layout: str) -> Column:
    """Epoch seconds printed in the session time zone."""
    return F.date_format(F.timestamp_seconds(seconds), layout)


def whole_minutes(start: Column, end: Column) -> Column:
    return F.floor((end - start) / 60).cast("bigint")


def velocity(messages: Column, start: Column, end: Column) -> Column:
    """Messages per minute; the plain count when the thread has no duration."""
    minutes = (end - start) / 60
    return F.when(minutes > 0, messages / minutes).otherwise(messages.cast("double"))
