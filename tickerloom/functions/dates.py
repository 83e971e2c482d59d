"""Report dates, weekly and monthly labels, analysis periods, Chinese date texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names from Monday, and the period names of the analysis time frame.
WEEKDAYS = ["星期一", "星期二", "星期三", "星期四", "星期五", "星期六", "星期日"]
PERIODS = ["recent", "quarter", "half_year", "year", "month"]


def quarter_end_code(year: Column, quarter: Column) -> Column:
    """``YYYYMMDD`` of the last day of a quarter; null for a quarter outside 1..4."""
    valid = F.when(quarter.between(1, 4), quarter)
    return F.date_format(F.last_day(F.make_date(year.cast("int"), (valid * 3).cast("int"), F.lit(1))), "yyyyMMdd")


def compact_date(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def friday_on_or_after(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "FRI")


def analysis_timeframe(day: Column, period: Column) -> Column:
    """Struct of start, middle, end and display text of the period that ends on ``day``."""
    month = F.trunc(day, "MM")
    early_february = (F.dayofmonth(day) < 15) & (F.month(day) == 2)

    def back(n: int) -> Column:
        return F.add_months(month, -n)

    start = (
        F.when((period == "recent") & (F.dayofmonth(day) < 15) & ~early_february, back(2))
        .when(period == "quarter", back(3))
        .when(period == "half_year", back(6))
        .when(period == "year", back(12))
        .otherwise(back(1))
    )
    middle = (
        F.when((period == "recent") & (F.dayofmonth(day) < 15) & ~early_february, back(1))
        .when(period == "half_year", back(3))
        .when(period == "year", back(6))
        .otherwise(start)
    )

    def named_month(value: Column, with_year: bool) -> Column:
        month_text = F.concat(F.month(value).cast("string"), F.lit("月"))
        return F.concat(F.year(value).cast("string"), F.lit("年"), month_text) if with_year else month_text

    first, dash = named_month(start, True), F.lit("-")
    span = (
        F.when(F.year(start) != F.year(day), F.concat(first, dash, named_month(day, True)))
        .when(
            (F.month(middle) != F.month(start)) & (F.month(middle) != F.month(day)),
            F.concat(first, dash, named_month(middle, False), dash, named_month(day, False)),
        )
        .when(F.month(start) != F.month(day), F.concat(first, dash, named_month(day, False)))
        .otherwise(first)
    )
    text = F.concat(
        span,
        F.lit(" (ISO日期范围: "),
        F.date_format(start, "yyyy-MM-dd"),
        F.lit(" 至 "),
        F.date_format(day, "yyyy-MM-dd"),
        F.lit(")"),
    )
    return F.struct(start.alias("start"), middle.alias("middle"), day.alias("end"), text.alias("display"))


def date_parts_cn(ts: Column) -> Column:
    """Chinese date, ISO date, weekday name, clock time and the combined text of a timestamp."""
    cn = F.date_format(ts, "yyyy年MM月dd日")
    iso = F.date_format(ts, "yyyy-MM-dd")
    weekday = F.element_at(F.array(*[F.lit(x) for x in WEEKDAYS]), F.weekday(ts) + 1)
    clock = F.date_format(ts, "HH:mm:ss")
    info = F.concat(cn, F.lit(" ("), iso, F.lit(") "), weekday, F.lit(" "), clock)
    return F.struct(
        cn.alias("current_date_cn"),
        iso.alias("current_date"),
        weekday.alias("current_weekday_cn"),
        clock.alias("current_time"),
        info.alias("current_time_info"),
    )
