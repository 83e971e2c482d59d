"""Market-data table functions: one function per request shape, filters pushed to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.codes import exchange_code
from tickerloom.operators.project import BASIC_DEFAULT, project_existing

# Index names and macro series.
INDEXES = ["sz50", "hs300", "zz500"]
DEPOSIT, LOAN, RESERVE = "deposit_rate", "loan_rate", "required_reserve_ratio"


def date_between(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    """Open-ended inclusive range: an absent bound does not filter."""
    if start:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def by_code(df: DataFrame, code: str | None) -> DataFrame:
    return df if code is None else df.where(F.col("code") == code)


def stock_basic(instruments: DataFrame, code: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """Instrument master rows of a code with ``code``, ``code_name`` and trade status."""
    rows = instruments if code is None else instruments.where(F.col("代码") == exchange_code(F.lit(code)))
    named = F.col("plain_code") if code is None else F.lit(code)
    extended = rows.select(
        named.alias("code"), F.col("名称").alias("code_name"), *rows.columns, F.lit("1").alias("tradeStatus")
    )
    return project_existing(extended, fields, strict=True) if fields else extended


def stock_basic_default(instruments: DataFrame) -> DataFrame:
    return project_existing(stock_basic(instruments), None, BASIC_DEFAULT)


def all_stock(instruments: DataFrame, date: str | None = None) -> DataFrame:
    """The instrument list as of a date, with its trade status."""
    listed = instruments if date is None else instruments.where(F.col("ipoDate") <= F.lit(date).cast("date"))
    return listed.withColumnsRenamed({"代码": "code", "名称": "code_name", "listed": "tradeStatus"})


def dividends(table: DataFrame, code: str | None, year: int, year_type: str = "report") -> DataFrame:
    """Dividends of a year; the plan date counts for ``report``, the operating date for ``operate``."""
    column = {"report": "dividPlanDate", "operate": "dividOperateDate"}[year_type]
    in_year = F.col(column).between(F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31)))
    return by_code(table, code).where(in_year)


def snapshot(
    table: DataFrame, keys: Sequence[str], date: str | None = None, column: str = "updateDate", few_keys: bool = False
) -> DataFrame:
    """Rows of the newest snapshot on or before ``date`` for each key.

    Snapshot dates are aggregated first; only one row per key is joined back, whatever the number
    of members. ``few_keys`` says the key has a handful of values, which makes that side one row each
    and safe to broadcast.
    """
    eligible = table if date is None else table.where(F.col(column) <= F.lit(date).cast("date"))
    newest = eligible.groupBy(*keys).agg(F.max(column).alias(column))
    return eligible.join(F.broadcast(newest) if few_keys else newest, [*keys, column], "left_semi")


def industry(table: DataFrame, code: str | None = None, date: str | None = None) -> DataFrame:
    return snapshot(by_code(table, code), ["code"], date)


def index_members(table: DataFrame, index_name: str, date: str | None = None) -> DataFrame:
    if index_name not in INDEXES:
        raise ValueError(f"index must be one of {INDEXES}")
    return snapshot(table.where(F.col("index_name") == index_name), ["index_name"], date, few_keys=True)


def rates(table: DataFrame, series: str, start: str | None = None, end: str | None = None, year_type: str = "0") -> DataFrame:
    """A rate series; the reserve ratio may be selected by announcement (0) or effective date (1)."""
    column = "effectiveDate" if series == RESERVE and year_type == "1" else "pubDate"
    return date_between(table.where(F.col("series") == series), column, start, end)


def money_supply_month(table: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Monthly money supply between two ``YYYY-MM`` bounds."""
    month = F.concat_ws("-", "statYear", "statMonth")
    if start:
        table = table.where(month >= start)
    if end:
        table = table.where(month <= end)
    return table


def money_supply_year(table: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Year-end money supply between two ``YYYY`` bounds."""
    if start:
        table = table.where(F.col("statYear") >= start)
    if end:
        table = table.where(F.col("statYear") <= end)
    return table.groupBy("statYear").agg(F.max_by("m0", "statMonth").alias("m0"), F.max_by("m2", "statMonth").alias("m2"))


def peers(industries: DataFrame) -> DataFrame:
    """Each instrument with the number of instruments in its industry (null without one); no pairs are formed."""
    counts = industries.groupBy("industry").agg(F.count("*").alias("peer_count"))
    return industries.join(counts, "industry", "left")
