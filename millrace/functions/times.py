"""Time expressions. The clock is always an explicit ``as_of`` argument, and nothing
depends on the time zone of the session."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.fraction]``. A cast of the time-zone-free type; the format
    functions would go through the session's time zone."""
    return moment.cast("timestamp_ntz").cast("string")


def month_text(moment: Column) -> Column:
    """``yyyy-MM``"""
    return F.substring(_text(moment), 1, 7)


def day_text(moment: Column) -> Column:
    """``yyyy-MM-dd``"""
    return F.substring(_text(moment), 1, 10)


def hour_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:00``"""
    return F.concat(F.substring(_text(moment), 1, 13), F.lit(":00"))


def time_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``"""
    text = _text(moment)
    fraction = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 19), F.lit("."), fraction)


def stamp_text(moment: Column) -> Column:
    """``yyyyMMdd_HHmmss``"""
    return F.translate(F.substring(_text(moment), 1, 19), " -:", "_")


def clock(as_of: dt.datetime | str) -> Column:
    """The fixed clock as a time-zone-free timestamp literal."""
    return F.lit(str(as_of)).cast("timestamp_ntz")


def shifted(moment: Column, *, days: int = 0, minutes: int = 0) -> Column:
    step = F.make_dt_interval(F.lit(days), F.lit(0), F.lit(minutes))
    return (moment + step).cast("timestamp_ntz")


def midnight(moment: Column) -> Column:
    return F.to_date(moment).cast("timestamp_ntz")


def days_between(earlier: Column, later: Column) -> Column:
    """Number of midnights crossed."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


def minutes_between(earlier: Column, later: Column) -> Column:
    """Number of minute marks crossed (59 s to 60 s counts as 1)."""
    hours = F.hour(later) - F.hour(earlier)
    minutes = F.minute(later) - F.minute(earlier)
    return days_between(earlier, later) * 1440 + hours * 60 + minutes


def parsed_time(text: Column) -> Column:
    """ISO text to a time-zone-free timestamp (the wall clock, an offset is ignored);
    NULL for text that is no time."""
    return text.try_cast("timestamp_ntz")


def within_days(moment: Column, as_of: Column, days: int) -> Column:
    """From midnight ``days`` days before the clock's date. A plain comparison on
    the column, so it reaches the parquet scan."""
    return moment >= shifted(midnight(as_of), days=-days)


def within_minutes(moment: Column, as_of: Column, minutes: int) -> Column:
    return moment >= shifted(as_of, minutes=-minutes)


def on_day(moment: Column, day: Column) -> Column:
    """Same calendar day, as a half-open range so that it can be pushed down."""
    start = midnight(day)
    return (moment >= start) & (moment < shifted(start, days=1))


def on_run_days(results: DataFrame, first: Column, last: Column | None = None) -> DataFrame:
    """Rows of the days ``first`` to ``last``, by the partition column ``run_date`` of a stored
    result table, so that other days are not opened. A frame without it stays as it is."""
    if "run_date" not in results.columns:
        return results
    day = F.col("run_date")
    return results.where((day >= first) & (day <= (first if last is None else last)))
