"""Queries that join the analysis branches into report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.operators import indicators, klines, reports, statements
from tickerloom.plans.market import BARS, TAIL, bars_of
from tickerloom.plans.registry import query
from tickerloom.sources import market

BRANCHES = f"""{BARS},
fundamental AS (SELECT code, 'income quarters: ' || count(*)::VARCHAR AS analysis, CASE WHEN count(*) % 4 = 0 THEN 'stale statements' END AS error FROM v_profit GROUP BY code),
technical AS (SELECT code, 'bars: ' || count(*)::VARCHAR AS analysis, CASE WHEN count(*) % 5 = 0 THEN 'price gap' END AS error FROM bars GROUP BY code),
valued AS (SELECT code, 'dividends: ' || count(*)::VARCHAR AS analysis, NULL::VARCHAR AS error FROM v_dividends WHERE cash_per_share > 0.5 GROUP BY code),
newsy AS (SELECT plain_code AS code, 'listed: ' || industry AS analysis, CASE WHEN listed = '0' THEN 'no news' END AS error FROM v_instruments)"""
WIDE = """joined AS (SELECT code, f.analysis AS fa, f.error AS fe, t.analysis AS ta, t.error AS te, v.analysis AS va, v.error AS ve, n.analysis AS na, n.error AS ne
FROM fundamental f FULL JOIN technical t USING (code) FULL JOIN valued v USING (code) FULL JOIN newsy n USING (code))"""


def counted(df, label, error):
    n = F.col("n").cast("string")
    return df.groupBy("code").agg(F.count("*").alias("n")).select("code", F.concat(F.lit(label), n).alias("analysis"), error.alias("error"))


def branches(t):
    none = F.lit(None).cast("string")
    return {
        "fundamental": counted(t.v_profit, "income quarters: ", F.when(F.col("n") % 4 == 0, "stale statements")),
        "technical": counted(bars_of(t), "bars: ", F.when(F.col("n") % 5 == 0, "price gap")),
        "value": counted(t.v_dividends.where("cash_per_share > 0.5"), "dividends: ", none),
        "news": t.v_instruments.select(
            F.col("plain_code").alias("code"), F.concat(F.lit("listed: "), "industry").alias("analysis"), F.when(F.col("listed") == "0", "no news").alias("error")
        ),
    }


@query("branch_fan_in", f"""WITH {BRANCHES}, {WIDE} SELECT code, fa AS fundamental_analysis, fe AS fundamental_analysis_error, ta AS technical_analysis, te AS technical_analysis_error,
va AS value_analysis, ve AS value_analysis_error, na AS news_analysis, ne AS news_analysis_error FROM joined""")
def branch_fan_in(t):
    return reports.fan_in(branches(t))


@query("report_sections", f"""WITH {BRANCHES}, {WIDE} SELECT code, fa IS NOT NULL AND fe IS NULL AS has_fundamental, ta IS NOT NULL AND te IS NULL AS has_technical,
va IS NOT NULL AND ve IS NULL AS has_value, na IS NOT NULL AND ne IS NULL AS has_news, coalesce(fa, 'Not available') AS fundamental, coalesce(ta, 'Not available') AS technical,
coalesce(va, 'Not available') AS "value", coalesce(na, 'Not available') AS news,
concat_ws('. ', 'Fundamental Analysis Error: ' || fe, 'Technical Analysis Error: ' || te, 'Value Analysis Error: ' || ve, 'News Analysis Error: ' || ne) AS errors FROM joined""")
def report_sections(t):
    return reports.report_sections(reports.fan_in(branches(t)))


FIELDS = {
    "股票代码": "i.plain_code", "股票名称": 'i."名称"', "所属行业": "i.industry", "上市日期": "strftime(i.\"ipoDate\", '%Y-%m-%d')",
    "ROE(净资产收益率)": "printf('%.2f', roe)", "销售净利率": "printf('%.2f', net_margin)", "流动比率": "printf('%.2f', current_ratio)",
    "资产负债率": "printf('%.2f', debt_ratio)", "净利润同比增长": "printf('%.2f', income_growth)", "最新收盘价": "printf('%.2f', latest)",
    "6个月价格变动": "printf('%.2f', change)", "20日均价": "printf('%.2f', ma20)", "同行业股票数量": "peers::VARCHAR",
}


@query("stock_report_fields", f"""WITH {BARS}, {TAIL},
span AS (SELECT *, max(date) OVER (PARTITION BY code) AS newest FROM bars),
chg AS (SELECT code, (arg_max(close, date) / arg_min(close, date) - 1) * 100 AS change, arg_max(close, date) AS latest FROM span WHERE date >= newest - 180 GROUP BY code HAVING count(*) > 1),
pr AS (SELECT p.code, p."报告日" AS d, "净利润" / nullif("所有者权益合计", 0) * 100 AS roe, "净利润" / "营业收入" * 100 AS net_margin FROM v_profit p JOIN v_balance b ON p.code = b.code AND p."报告日" = b."报告日"),
prl AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY code ORDER BY d DESC) = 1),
bl AS (SELECT code, "流动资产合计" / nullif("流动负债合计", 0) AS current_ratio, "负债合计" / nullif("资产总计", 0) * 100 AS debt_ratio FROM v_balance QUALIFY row_number() OVER (PARTITION BY code ORDER BY "报告日" DESC) = 1),
gr AS (SELECT a.code, (a."净利润" / nullif(b."净利润", 0) - 1) * 100 AS income_growth FROM v_profit a JOIN v_profit b ON a.code = b.code AND a."报告日"::INT = b."报告日"::INT + 10000
  QUALIFY row_number() OVER (PARTITION BY a.code ORDER BY a."报告日" DESC) = 1),
pc AS (SELECT industry, count(*) AS peers FROM v_instruments GROUP BY industry),
w AS (SELECT i.plain_code AS code, {', '.join(f'{sql} AS "{name}"' for name, sql in FIELDS.items())}
  FROM v_instruments i LEFT JOIN prl ON prl.code = i.plain_code LEFT JOIN bl ON bl.code = i.plain_code LEFT JOIN gr ON gr.code = i.plain_code
  LEFT JOIN chg ON chg.code = i.plain_code LEFT JOIN tail ON tail.code = i.plain_code JOIN pc ON pc.industry = i.industry)
SELECT code, field, value FROM ({' UNION ALL '.join(f'SELECT code, {chr(39)}{name}{chr(39)} AS field, "{name}" AS value FROM w' for name in FIELDS)}) WHERE value IS NOT NULL""")
def stock_report_fields(t):
    """Latest ratios, price block and peer count of every instrument as field/value rows."""
    def latest(df, order="report_date"):
        values = [c for c in df.columns if c not in ("code", order)]
        return df.groupBy("code").agg(*[F.max_by(c, order).alias(c) for c in values])

    bars = bars_of(t)
    basic = market.stock_basic(t.v_instruments).select(
        "code", "code_name", "industry", F.date_format("ipoDate", "yyyy-MM-dd").alias("ipoDate")
    )
    parts = (
        market.peers(basic)
        .join(latest(statements.profitability(t.v_profit, t.v_balance).drop("gross_margin")), "code", "left")
        .join(latest(statements.leverage(t.v_balance)), "code", "left")
        .join(latest(statements.growth_yoy(t.v_profit, {"income_growth": "净利润"})), "code", "left")
        .join(indicators.price_change(indicators.last_days(bars)).drop("start_price"), "code", "left")
        .join(indicators.ma_tail(bars).select("code", "ma20"), "code", "left")
    )
    return reports.report_fields(parts)
