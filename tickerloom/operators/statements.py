"""Financial statements as of a date, and ratios derived from them.

Requests are reduced to distinct (code, target) keys before the lookup, and the lookup reduces to
one date per key by a partially aggregated ``max``. A code that dominates the requests therefore
meets at most its own quarters; the result is joined back to the requests on the full key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions.dates import compact_date, quarter_end_code
from tickerloom.operators.project import project_keyword_columns, union_by_name

# Statement names and the column keywords of the six reports.
PROFIT, BALANCE, CASH = "利润表", "资产负债表", "现金流量表"
KEYWORDS = {
    "profit": ["营业", "利润", "收益", "成本", "税"],
    "balance": ["资产", "负债", "所有者权益", "股东权益", "货币资金", "应收", "存货"],
    "cash_flow": ["现金", "经营活动", "投资活动", "筹资活动"],
    "growth": ["营业收入", "营业利润", "净利润", "资产总计", "所有者权益"],
    "operation": ["营业收入", "应收", "存货", "流动资产", "资产总计"],
    "dupont": ["营业收入", "净利润", "资产总计", "所有者权益"],
}
REPORT_DATE, REPORT_TYPE, UPDATED = "报告日", "报表", "更新日期"


def with_target(requests: DataFrame) -> DataFrame:
    return requests.withColumn("target", quarter_end_code(F.col("y"), F.col("q")))


def asof_statement(statement: DataFrame, requests: DataFrame, kinds: Sequence[str] = ()) -> DataFrame:
    """One statement row per request: dated on the target, else the newest before it; none when there is none.

    With ``kinds`` the statement holds several stacked ones, told apart by those columns, and each gives a row.

    Of several reports of one date (a restatement) the one updated last counts. The statement is read once.
    """
    keys = requests.select("code", "target").distinct()
    updated = F.col(f"`{UPDATED}`") if UPDATED in statement.columns else F.lit(None).cast("string")
    dated = statement.withColumns({"_date": compact_date(F.col(REPORT_DATE)), "_updated": updated})
    columns = [c for c in statement.columns if c not in ("code", *kinds)]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct("_date", "_updated", F.xxhash64(*[F.col(f"`{c}`") for c in columns])))
    chosen = keys.join(dated, "code").where(F.col("_date") <= F.col("target")).groupBy("code", "target", *kinds).agg(newest.alias("_row"))
    return requests.join(chosen, ["code", "target"]).select(*requests.columns, *kinds, *[F.col(f"_row.`{c}`") for c in columns])


def statement_at(statement: DataFrame, code: str | None, year: int, quarter: int) -> DataFrame:
    """One statement table at one quarter; the filters reach the scan."""
    target = quarter_end_code(F.lit(year), F.lit(quarter))
    rows = statement.where(compact_date(F.col(REPORT_DATE)) == target)
    return rows if code is None else rows.where(F.col("code") == code)


def two_period_reports(statements: Mapping[str, DataFrame], requests: DataFrame) -> DataFrame:
    """All statement types at the target quarter and one year before, stacked; missing parts are skipped."""
    wanted = with_target(
        requests.select("code", "y", "q", F.explode(F.array(F.lit(0), F.lit(1))).alias("_back"))
        .withColumn("report_year", F.col("y") - F.col("_back"))
        .select("code", F.col("y").alias("request_year"), F.col("report_year").alias("y"), "q")
    ).withColumnRenamed("y", "report_year")
    stacked = union_by_name([table.withColumn(REPORT_TYPE, F.lit(kind)) for kind, table in statements.items()])
    found = asof_statement(stacked, wanted, [REPORT_TYPE])
    lead = ["code", "request_year", "q", "report_year", REPORT_TYPE]
    return found.select(*lead, *[F.col(f"`{c}`") for c in stacked.columns if c not in lead])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def profitability(profit: DataFrame, balance: DataFrame) -> DataFrame:
    joined = profit.join(balance.select("code", REPORT_DATE, "所有者权益合计"), ["code", REPORT_DATE])
    income, revenue = F.col("净利润"), F.col("营业收入")
    return joined.select(
        "code",
        F.col(REPORT_DATE).alias("report_date"),
        (_ratio(revenue - F.col("营业成本"), revenue) * 100).alias("gross_margin"),
        (_ratio(income, revenue) * 100).alias("net_margin"),
        (_ratio(income, F.col("所有者权益合计")) * 100).alias("roe"),
    )


def growth_yoy(statement: DataFrame, items: Mapping[str, str]) -> DataFrame:
    """Change in percent against the same quarter one year before."""
    before = statement.select(
        "code",
        (F.col(REPORT_DATE).cast("int") + 10000).cast("string").alias(REPORT_DATE),
        *[F.col(item).alias(f"_{name}") for name, item in items.items()],
    )
    return statement.join(before, ["code", REPORT_DATE]).select(
        "code",
        F.col(REPORT_DATE).alias("report_date"),
        *[((_ratio(F.col(item), F.col(f"_{name}")) - 1) * 100).alias(name) for name, item in items.items()],
    )


def turnover(profit: DataFrame, balance: DataFrame) -> DataFrame:
    joined = profit.join(balance.select("code", REPORT_DATE, "应收账款", "存货", "资产总计"), ["code", REPORT_DATE])
    return joined.select(
        "code",
        F.col(REPORT_DATE).alias("report_date"),
        _ratio(F.col("营业收入"), F.col("应收账款")).alias("receivable_turnover"),
        _ratio(F.col("营业成本"), F.col("存货")).alias("inventory_turnover"),
        _ratio(F.col("营业收入"), F.col("资产总计")).alias("asset_turnover"),
    )


def leverage(balance: DataFrame) -> DataFrame:
    return balance.select(
        "code",
        F.col(REPORT_DATE).alias("report_date"),
        (_ratio(F.col("负债合计"), F.col("资产总计")) * 100).alias("debt_ratio"),
        _ratio(F.col("流动资产合计"), F.col("流动负债合计")).alias("current_ratio"),
    )


def price_multiple(bars: DataFrame, profit: DataFrame) -> DataFrame:
    """Close over the per-share income of the newest statement on or before the bar date."""
    earnings = profit.select(
        "code",
        F.to_date(REPORT_DATE, "yyyyMMdd").alias("date"),
        _ratio(F.col("净利润"), F.col("股数")).alias("_eps"),
        F.lit(0).alias("_bar"),
    )
    stacked = bars.select("code", "date", "close", F.lit(1).alias("_bar")).unionByName(earnings, allowMissingColumns=True)
    carried = F.last("_eps", ignorenulls=True).over(
        W.partitionBy("code").orderBy("date", "_bar").rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        stacked.withColumn("_carried", carried)
        .where("_bar = 1 AND _carried > 0")
        .select("code", "date", "close", (F.col("close") / F.col("_carried")).alias("pe"))
    )


def against_industry(latest: DataFrame, industry: DataFrame, value: str) -> DataFrame:
    """Value minus the mean of its industry; means are aggregated first and joined back. Without an industry there is no mean."""
    tagged = latest.join(industry.select("code", "industry"), "code")
    means = tagged.where("industry is not null").groupBy("industry").agg(F.avg(value).alias("industry_mean"), F.count("*").alias("peers"))
    return tagged.join(means, "industry", "left").select(
        "code", "industry", value, "industry_mean", "peers", (F.col(value) - F.col("industry_mean")).alias("gap")
    )


def percentile_in_history(series: DataFrame, value: str) -> DataFrame:
    return series.withColumn(
        "percentile", F.percent_rank().over(W.partitionBy("code").orderBy(value)) * 100
    )


def dividend_yield(dividends: DataFrame, bars: DataFrame) -> DataFrame:
    """Cash per share of the twelve months up to the last bar, over the last close."""
    last = bars.groupBy("code").agg(F.max("date").alias("last_date"), F.max_by("close", "date").alias("last_close"))
    paid = (
        dividends.join(last.select("code", "last_date"), "code")
        .where((F.col("dividOperateDate") <= F.col("last_date")) & (F.col("dividOperateDate") > F.add_months("last_date", -12)))
        .groupBy("code")
        .agg(F.sum("cash_per_share").alias("cash"))
    )
    return last.join(paid, "code", "left").select(
        "code", "last_close", F.coalesce("cash", F.lit(0.0)).alias("cash"),
        (F.coalesce("cash", F.lit(0.0)) / F.col("last_close") * 100).alias("dividend_yield"),
    )


#: Reports that compare with the year before, and the statement of each single-period report.
TWO_PERIODS = ("growth", "operation", "dupont")
STATEMENT_OF = {"profit": PROFIT, "balance": BALANCE, "cash_flow": CASH}


def statement_report(kind: str, statements: Mapping[str, DataFrame], requests: DataFrame, most: int | None = None) -> DataFrame:
    """One of the reports named in ``KEYWORDS`` for every request (``code``, ``y``, ``q``), with the columns its keywords pick.

    ``profit``, ``balance`` and ``cash_flow`` take their statement at the requested quarter, else the newest before it. The
    others stack all statements at that quarter and a year before. ``most`` bounds the picked columns, if given.
    """
    if kind in TWO_PERIODS:
        found, keep = two_period_reports(statements, requests), ["code", "request_year", "q", "report_year", REPORT_TYPE]
    else:
        found, keep = asof_statement(statements[STATEMENT_OF[kind]], with_target(requests)), ["code", "y", "q"]
        found = found.drop("target")
    return project_keyword_columns(found, KEYWORDS[kind], keep=keep, most=most)
