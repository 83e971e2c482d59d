"""Trading calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: days before the end of a range when no start is given.
DEFAULT_SPAN = 45


def _as_date(value: str | None) -> Column:
    return F.lit(value or dt.date.today().isoformat()).cast("date")


def range_bounds(start: str | None, end: str | None) -> tuple[Column, Column]:
    """Inclusive bounds; the end defaults to today and the start to ``DEFAULT_SPAN`` days earlier."""
    upper = _as_date(end)
    return (F.lit(start).cast("date") if start else F.date_sub(upper, DEFAULT_SPAN)), upper


def in_date_range(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    lower, upper = range_bounds(start, end)
    return df.where(F.col(column).between(lower, upper))


def calendar_range(bounds: DataFrame) -> DataFrame:
    """One row per day of each (start, end) row."""
    return bounds.select(F.explode(F.sequence("start", "end")).alias("date"))


def trading_calendar(trading_days: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every calendar day of the range with a 0/1 trading flag.

    Days are distinct on both sides, so the join moves at most one row per day; its size, not a
    hint, decides how Spark joins.
    """
    open_days = trading_days.select("date").distinct().withColumn("_open", F.lit(1))
    return calendar_range(bounds).join(open_days, "date", "left").select(
        F.date_format("date", "yyyy-MM-dd").alias("calendar_date"), F.coalesce("_open", F.lit(0)).alias("is_trading_day")
    )


def latest_trading_date(calendar: DataFrame, today: str | None = None) -> DataFrame:
    """The newest trading day up to ``today``; ``today`` itself when there is none."""
    ref = F.date_format(_as_date(today), "yyyy-MM-dd")
    usable = (F.col("is_trading_day") == 1) & (F.col("calendar_date") <= ref)
    return calendar.agg(F.coalesce(F.max(F.when(usable, F.col("calendar_date"))), ref).alias("latest_trading_date"))
