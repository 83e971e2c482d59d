"""Stand-in tables: the market, news, label and run-log tables derived from the driver's parquet.

Each mapping is one statement in the SQL subset that Spark and DuckDB share, so the engine and
the check read the same rows. Names in braces are the inputs. Everything is derived row by row
or by a partially aggregated ``GROUP BY``; nothing is sampled or truncated.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _code(key: str) -> str:
    """A six-digit instrument code from a number; the first digits choose the exchange."""
    return (
        f"(CASE {key} % 5 WHEN 0 THEN '600' WHEN 1 THEN '000' WHEN 2 THEN '300' WHEN 3 THEN '830' ELSE '900' END"
        f" || CASE WHEN {key} < 1000 THEN lpad(cast({key} AS string), 3, '0') ELSE cast({key} AS string) END)"
    )


def _day(year: str, month: str, day: str) -> str:
    return f"make_date(cast({year} AS int), cast({month} AS int), cast({day} AS int))"


_QUARTER_DATE = "cast(y * 10000 + CASE q WHEN 1 THEN 331 WHEN 2 THEN 630 WHEN 3 THEN 930 ELSE 1231 END AS string)"

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "v_ticks": f"""
        SELECT {_code('(o_custkey % 50)')} AS code, cast(o_orderdate AS date) AS date, o_orderkey AS seq,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_totalprice / 1000 END AS price,
               cast(1 AS bigint) AS volume, o_totalprice AS amount
        FROM {{orders}}""",
    "v_ticks_intraday": """
        SELECT event_type AS code, ts, event_id AS seq, value AS price, cast(1 AS bigint) AS volume, value AS amount
        FROM {events}""",
    "v_instruments": f"""
        SELECT {_code('s_suppkey')} AS plain_code,
               CASE s_suppkey % 5 WHEN 0 THEN 'sh' WHEN 3 THEN 'bj' WHEN 4 THEN 'sh' ELSE 'sz' END
                 || {_code('s_suppkey')} AS `代码`,
               s_name AS `名称`, n_name AS industry, r_name AS market,
               {_day('1990 + s_suppkey % 20', '1 + s_suppkey % 12', '1 + s_suppkey % 28')} AS ipoDate,
               CASE WHEN s_suppkey % 13 = 0 THEN '0' ELSE '1' END AS listed, s_acctbal AS price, s_suppkey AS suppkey
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "v_quarters": f"""
        SELECT code, y, q, sum(o_totalprice) AS total, count(*) AS n,
               sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS f_total,
               sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END) AS o_total
        FROM (SELECT {_code('(o_custkey % 50)')} AS code, cast(year(o_orderdate) AS bigint) AS y,
                     cast(quarter(o_orderdate) AS bigint) AS q, o_totalprice, o_orderstatus FROM {{orders}}) x
        GROUP BY code, y, q""",
    "v_profit": f"""
        SELECT code, {_QUARTER_DATE} AS `报告日`, 'CNY' AS `币种`, round(total, 6) AS `营业收入`,
               round(total * 0.62, 6) AS `营业成本`, round(total * 0.3 - n * 1000, 6) AS `营业利润`,
               round(total * 0.2 + f_total * 0.01, 6) AS `净利润`, n AS `股数`
        FROM {{v_quarters}} WHERE n % 7 <> 0""",
    "v_balance": f"""
        SELECT code, {_QUARTER_DATE} AS `报告日`, 'CNY' AS `币种`, round(o_total * 0.4, 6) AS `货币资金`,
               round(f_total * 0.25, 6) AS `应收账款`, round(total * 0.15, 6) AS `存货`,
               round(o_total * 0.4 + f_total * 0.25 + total * 0.15, 6) AS `流动资产合计`,
               round(total * 2, 6) AS `资产总计`, round(f_total * 0.5, 6) AS `流动负债合计`,
               round(f_total * 0.5 + total * 0.3, 6) AS `负债合计`,
               round(total * 1.7 - f_total * 0.5, 6) AS `所有者权益合计`, n AS `股本`
        FROM {{v_quarters}} WHERE n % 5 <> 0""",
    "v_cash": f"""
        SELECT code, {_QUARTER_DATE} AS `报告日`, 'CNY' AS `币种`, '合并期末' AS `类型`,
               round(total * 0.18, 6) AS `经营活动产生的现金流量净额`, round(f_total * -0.07, 6) AS `投资活动产生的现金流量净额`,
               round(o_total * 0.05, 6) AS `筹资活动产生的现金流量净额`
        FROM {{v_quarters}} WHERE n % 3 <> 0""",
    "v_statement_requests": "SELECT DISTINCT code, y, q FROM {v_quarters}",
    "v_trading_days": "SELECT DISTINCT cast(o_orderdate AS date) AS date FROM {orders} WHERE o_orderkey % 3 = 0",
    "v_factors": f"""
        SELECT code, {_day('y', 'q * 3 - 2', '1')} AS dividOperateDate, round(1 + (n % 10) * 0.01, 6) AS factor
        FROM {{v_quarters}} WHERE n % 4 <> 0""",
    "v_dividends": f"""
        SELECT code, max(plan_day) AS dividPlanDate, max(ex_day) AS dividOperateDate,
               round(sum(l_discount) / count(*) * 10, 6) AS cash_per_share
        FROM (SELECT {_code('(l_suppkey % 50)')} AS code, year(l_shipdate) AS y, l_discount,
                     cast(l_shipdate AS date) AS plan_day,
                     last_day({_day('year(l_shipdate) + CASE WHEN month(l_shipdate) > 10 THEN 1 ELSE 0 END', '1 + (month(l_shipdate) + 1) % 12', '1')}) AS ex_day
              FROM {{lineitem}}) x
        GROUP BY code, y""",
    "v_express": f"""
        SELECT code, last_day({_day('y + CASE WHEN q = 4 THEN 1 ELSE 0 END', '1 + (q * 3) % 12', '1')}) AS performanceExpPubDate,
               {_QUARTER_DATE} AS performanceExpStatDate, round(total, 6) AS revenue, n AS orders
        FROM {{v_quarters}} WHERE n % 2 = 0""",
    "v_forecast": f"""
        SELECT code, {_day('y', 'q * 3', '15')} AS profitForcastExpPubDate, {_QUARTER_DATE} AS profitForcastExpStatDate,
               CASE WHEN f_total > o_total THEN 'up' ELSE 'down' END AS profitForcastType
        FROM {{v_quarters}} WHERE n % 3 = 1""",
    "v_industry": f"""
        SELECT {_code('s_suppkey')} AS code, s_name AS code_name, n_name AS industry, updateDate
        FROM (SELECT s_suppkey, s_name, s_nationkey AS home, {_day('2000', '1', '3')} AS updateDate FROM {{supplier}}
              UNION ALL
              SELECT s_suppkey, s_name, (s_nationkey + 1) % 25, {_day('2001', '1', '8')} FROM {{supplier}}) x
             JOIN {{nation}} ON n_nationkey = home""",
    "v_members": f"""
        SELECT CASE c_custkey % 3 WHEN 0 THEN 'sz50' WHEN 1 THEN 'hs300' ELSE 'zz500' END AS index_name,
               {_day('2000', '1 + c_custkey % 12', '1')} AS updateDate, {_code('c_custkey')} AS code, c_name AS code_name
        FROM {{customer}}""",
    "v_discount_months": """
        SELECT year(l_shipdate) AS y, month(l_shipdate) AS m, sum(l_discount) / count(*) * 10 AS level
        FROM {lineitem} GROUP BY year(l_shipdate), month(l_shipdate)""",
    "v_rates": f"""
        SELECT series, {_day('y', 'm', '5')} AS pubDate, {_day('y', 'm', '20')} AS effectiveDate, round(rate, 6) AS rate
        FROM (SELECT 'deposit_rate' AS series, y, m, level + 1.5 AS rate FROM {{v_discount_months}}
              UNION ALL SELECT 'loan_rate', y, m, level + 4.35 FROM {{v_discount_months}}
              UNION ALL SELECT 'required_reserve_ratio', y, m, level + 12.0 FROM {{v_discount_months}}) x""",
    "v_money": """
        SELECT cast(y AS string) AS statYear, lpad(cast(m AS string), 2, '0') AS statMonth, round(m0, 6) AS m0, round(m2, 6) AS m2
        FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, sum(o_totalprice) AS m2,
                     sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS m0
              FROM {orders} GROUP BY year(o_orderdate), month(o_orderdate)) x""",
    "v_news": f"""
        SELECT doc_id AS original_index,
               cast({_day('2020 + doc_id % 4', '1 + doc_id % 12', '1 + doc_id % 28')} AS string) AS `Date`,
               CASE WHEN doc_id % 53 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS Article_title,
               CASE WHEN doc_id % 47 = 0 THEN NULL ELSE source END AS Stock_symbol,
               CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 61 = 0 THEN ' ' ELSE text END AS Article,
               CASE WHEN doc_id % 59 = 0 THEN NULL ELSE text END AS Textrank_summary,
               CASE WHEN doc_id % 7 = 0 THEN NULL ELSE cast(1 + doc_id % 5 AS double) END AS risk_deepseek
        FROM {{documents}}""",
    "v_labels": """
        SELECT l.doc_id AS row_id, CASE WHEN l.doc_id % 43 = 0 THEN NULL ELSE d.text END AS Lsa_summary,
               CASE WHEN l.doc_id % 17 = 0 THEN NULL ELSE d.source END AS Stock_symbol,
               CASE WHEN l.doc_id % 41 = 0 THEN NULL WHEN l.doc_id % 37 = 0 THEN '0' WHEN l.doc_id % 31 = 0 THEN 'abc'
                    WHEN l.doc_id % 29 = 0 THEN '6' WHEN l.doc_id % 23 = 0 THEN '2.7'
                    ELSE cast(1 + (2 * l.quality + l.toxic + l.doc_id) % 5 AS string) || '.0' END AS label_raw
        FROM {labels} l LEFT JOIN {documents} d ON d.doc_id = l.doc_id""",
    "v_outputs": """
        SELECT row_id, label_raw, CASE row_id % 9
                 WHEN 0 THEN '' WHEN 1 THEN 'score 15 then ' || cast(1 + row_id % 5 AS string) || '.'
                 WHEN 2 THEN '12' WHEN 3 THEN 'System: x Assistant: 3' || chr(10) || 'Assistant: ' || cast(1 + row_id % 6 AS string) || ' x'
                 WHEN 4 THEN 'Assistant: n/a' WHEN 5 THEN 'Assistant: ' || cast(row_id % 8 AS string)
                 ELSE 'Assistant: ' || split_part(coalesce(label_raw, '4'), '.', 1) END AS generated
        FROM {v_labels}""",
    "v_requests": f"""
        SELECT c_custkey AS request_id, CASE c_custkey % 13
                 WHEN 0 THEN '分析' || name WHEN 1 THEN '分析' || name || '(' || code || ')'
                 WHEN 2 THEN '分析（' || code || '）' || name WHEN 3 THEN '请帮我分析一下' || name || '(' || code || ')这只股票的投资价值如何'
                 WHEN 4 THEN '给我分析一下' || name || '的财务状况' WHEN 5 THEN '帮我看看(' || code || ')' || name || '这只股票'
                 WHEN 6 THEN '帮我看看' || name || '这只股票怎么样' WHEN 7 THEN code || ' 这个股票值得买吗？'
                 WHEN 8 THEN name || '的盈利能力怎么样' WHEN 9 THEN '我想了解一下' || name || '的投资价值'
                 WHEN 10 THEN name || '在行业中的地位' WHEN 11 THEN name || '面临的主要风险' ELSE '分析' || code END AS query
        FROM (SELECT c_custkey, {_code('(c_custkey % 1000)')} AS code, replace(r_name, ' ', '') || c_mktsegment AS name
              FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey) x""",
    "v_turns": """
        SELECT 'run' || cast(conv_id AS string) AS execution_id, conv_id, turn, role, text,
               CASE turn % 4 WHEN 0 THEN 'fundamental_agent' WHEN 1 THEN 'technical_agent'
                    WHEN 2 THEN 'value_agent' ELSE 'news_agent' END AS agent_name,
               1700000000.0 + conv_id * 600 + turn * 7 AS started,
               1700000000.0 + conv_id * 600 + turn * 7 + 1 + length(text) % 5 AS ended,
               (conv_id + turn) % 11 <> 0 AS success
        FROM {conversations}""",
    "v_crawl": """
        SELECT doc_id AS pos, source AS query, split_part(text, chr(10), 1) AS title, text AS content,
               cast(2020 + doc_id % 4 AS string) AS published_at, 'site-' || lang AS source,
               'http://news.example.com/' || cast(doc_id AS string) AS url
        FROM {documents}""",
}

_REF = re.compile(r"\{(\w+)\}")


class Tables:
    """Lazy access to the base tables and stand-in views of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in VIEWS:
            text = VIEWS[name]
            return self.spark.sql(text, **{ref: getattr(self, ref) for ref in set(_REF.findall(text))})
        raise AttributeError(name)


def _closure(names: set[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for ref in _REF.findall(VIEWS[name]):
            if ref in VIEWS:
                visit(ref)
        if name not in ordered:
            ordered.append(name)

    for name in VIEWS:
        if name in names:
            visit(name)
    return ordered


def with_views(sql: str) -> str:
    """Prefix check SQL with the CTEs of the stand-in views it mentions."""
    used = {name for name in VIEWS if re.search(rf"\b{name}\b", sql)}
    if not used:
        return sql
    ctes = [
        f"{name} AS ({_REF.sub(lambda m: m.group(1), VIEWS[name]).replace('`', chr(34)).strip()})"
        for name in _closure(used)
    ]
    body = sql.strip()
    recursive = bool(re.match(r"WITH\s+RECURSIVE\b", body, re.I))
    body = re.sub(r"^WITH\s+(RECURSIVE\s+)?", "", body, flags=re.I) if re.match(r"WITH\b", body, re.I) else None
    head = "WITH RECURSIVE " if recursive else "WITH "
    if body is None:
        return head + ",\n".join(ctes) + "\n" + sql.strip()
    return head + ",\n".join(ctes) + ",\n" + body
