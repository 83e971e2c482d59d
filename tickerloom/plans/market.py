"""Queries over prices, instruments, calendars, macro series and indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import codes, dates
from tickerloom.operators import calendar, indicators, klines, project, statements
from tickerloom.plans.registry import query
from tickerloom.plans.shape import final
from tickerloom.sources import market

BARS = """bars AS (
  SELECT code, date, arg_min(price, seq) FILTER (WHERE price IS NOT NULL) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, seq) FILTER (WHERE price IS NOT NULL) AS close, sum(volume)::BIGINT AS volume, sum(amount) AS amount
  FROM v_ticks GROUP BY code, date HAVING max(price) IS NOT NULL)"""


def resampled(label: str) -> str:
    return f"""resampled AS (
  SELECT code, {label} AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
         sum(volume)::BIGINT AS volume, sum(amount) AS amount
  FROM bars GROUP BY ALL)"""


WEEK = "date + CAST((12 - isodow(date)) % 7 AS INTEGER)"
MONTH = "last_day(date)"
OUT = ("code, strftime(date, '%Y-%m-%d') AS date, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, "
       "round(close, 6) AS close, volume, round(amount, 2) AS amount")


def bars_of(t):
    return klines.daily_bars(t.v_ticks)


# ---- bars -------------------------------------------------------------------------------------


@query("scan_klines", f"""WITH {BARS}
SELECT code, strftime(date, '%Y-%m-%d') AS date, round(open, 6) AS open, round(close, 6) AS close, volume
FROM bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND code IN ('600000', '000001', '900049')""")
def scan_klines(t):
    bars = klines.klines(
        bars_of(t), ["600000", "000001", "900049"], "1996-01-01", "1999-12-31",
        fields=["date", "code", "open", "close", "volume", "absent"],
    )
    return final(bars, amount=2)


@query("kline_resample_week", f"WITH {BARS}, {resampled(WEEK)} SELECT {OUT} FROM resampled")
def kline_resample_week(t):
    return final(klines.resample(bars_of(t), klines.WEEKLY), amount=2)


@query("kline_resample_month", f"WITH {BARS}, {resampled(MONTH)} SELECT {OUT} FROM resampled")
def kline_resample_month(t):
    return final(klines.resample(bars_of(t), klines.MONTHLY), amount=2)


@query("kline_from_ticks", """
SELECT code, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS bar_start, arg_min(price, seq) AS open,
       max(price) AS high, min(price) AS low, arg_max(price, seq) AS close, sum(volume)::BIGINT AS volume, round(sum(amount), 2) AS amount
FROM v_ticks_intraday GROUP BY ALL""")
def kline_from_ticks(t):
    return final(klines.intraday_bars(t.v_ticks_intraday, "15"), amount=2)


PRE = "lag(close) OVER (PARTITION BY code ORDER BY date)"


@query("preclose_lag", f"""WITH {BARS} SELECT code, strftime(date, '%Y-%m-%d') AS date, round(close, 6) AS close,
round({PRE}, 6) AS preclose FROM bars""")
def preclose_lag(t):
    return final(klines.with_preclose(bars_of(t)).select("code", "date", "close", "preclose"))


@query("pct_change", f"""WITH {BARS} SELECT code, strftime(date, '%Y-%m-%d') AS date,
round((close / {PRE} - 1) * 100, 6) AS "pctChg" FROM bars""")
def pct_change(t):
    return final(klines.with_preclose(bars_of(t)).select("code", "date", "pctChg"))


@query("kline_full", f"""WITH {BARS}, {resampled(WEEK)}
SELECT {OUT}, round({PRE}, 6) AS preclose, round((close / {PRE} - 1) * 100, 6) AS "pctChg", '3' AS adjustflag FROM resampled""")
def kline_full(t):
    """Weekly bars from ticks with previous close and change: the flagship."""
    return final(klines.klines(bars_of(t), frequency=klines.WEEKLY), amount=2)


@query("prices_adjusted", f"""WITH {BARS}, latest AS (SELECT code, arg_max(factor, "dividOperateDate") AS latest FROM v_factors GROUP BY code)
SELECT b.code, strftime(b.date, '%Y-%m-%d') AS date, round(b.close * coalesce(f.factor, 1), 8) AS backward,
       round(b.close * coalesce(f.factor, 1) / coalesce(latest, 1), 8) AS forward
FROM bars b ASOF LEFT JOIN v_factors f ON b.code = f.code AND b.date >= f."dividOperateDate" LEFT JOIN latest l ON l.code = b.code""")
def prices_adjusted(t):
    bars = bars_of(t).select("code", "date", "close")
    scaled = klines.with_scales(bars, t.v_factors)
    return final(scaled.select("code", "date", (F.col("close") * F.col("backward")).alias("backward"), (F.col("close") * F.col("forward")).alias("forward")), 8)


@query("price_change_pct", f"""WITH {BARS}, span AS (SELECT *, max(date) OVER (PARTITION BY code) AS newest FROM bars)
SELECT code, round(arg_min(close, date), 6) AS start_price, round(arg_max(close, date), 6) AS latest_price,
       round((arg_max(close, date) / arg_min(close, date) - 1) * 100, 6) AS price_change
FROM span WHERE date >= newest - 180 GROUP BY code HAVING count(*) > 1""")
def price_change_pct(t):
    return final(indicators.price_change(indicators.last_days(bars_of(t), 180)))


TAIL = """tail AS (SELECT code, avg(close) AS ma20, arg_max(close, date) AS latest_price
  FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS rn FROM bars) WHERE rn <= 20 GROUP BY code HAVING count(*) = 20)"""


@query("ma20_tail", f"WITH {BARS}, {TAIL} SELECT code, round(ma20, 8) AS ma20, round(latest_price, 6) AS latest_price FROM tail")
def ma20_tail(t):
    return final(indicators.ma_tail(bars_of(t)), ma20=8)


@query("ma20_position", f"""WITH {BARS}, {TAIL} SELECT code, round(ma20, 8) AS ma20, round(latest_price, 6) AS latest_price,
CASE WHEN latest_price > ma20 THEN 'above' ELSE 'below' END AS side,
round(CASE WHEN latest_price > ma20 THEN latest_price / ma20 - 1 ELSE ma20 / latest_price - 1 END * 100, 6) AS distance_pct FROM tail""")
def ma20_position(t):
    return final(indicators.ma_position(indicators.ma_tail(bars_of(t))), ma20=8)


FRAME20 = "OVER (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@query("ma_rolling", f"""WITH {BARS} SELECT code, strftime(date, '%Y-%m-%d') AS date, round(close, 6) AS close,
CASE WHEN count(*) {FRAME20} = 20 THEN round(avg(close) {FRAME20}, 8) END AS ma20 FROM bars""")
def ma_rolling(t):
    return final(indicators.ma_rolling(bars_of(t)).select("code", "date", "close", "ma20"), ma20=8)


FRAME14 = "OVER (PARTITION BY code ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"


@query("rsi14", f"""WITH {BARS}, steps AS (SELECT code, date, close - {PRE} AS step FROM bars),
means AS (SELECT code, date, avg(greatest(step, 0.0)) {FRAME14} AS gain, avg(greatest(-step, 0.0)) {FRAME14} AS loss, count(step) {FRAME14} AS n
  FROM (SELECT code, date, step, CASE WHEN step IS NULL THEN NULL ELSE step END AS s FROM steps) WHERE step IS NOT NULL)
SELECT b.code, strftime(b.date, '%Y-%m-%d') AS date,
       CASE WHEN n = 14 THEN round(CASE WHEN loss = 0 THEN 100.0 ELSE 100 - 100 / (1 + gain / loss) END, 4) END AS rsi
FROM bars b LEFT JOIN means m ON m.code = b.code AND m.date = b.date""")
def rsi14(t):
    return final(indicators.rsi(bars_of(t)).select("code", "date", "rsi"), 4)


def _ema_sql(value: str, span: int, src: str) -> str:
    d = 1 - 2.0 / (span + 1)
    return f"""(SELECT a.code, a.rn, sum(b.{value} * pow({d!r}, a.rn - b.rn)) / sum(pow({d!r}, a.rn - b.rn)) AS e
  FROM {src} a JOIN {src} b ON a.code = b.code AND b.rn <= a.rn GROUP BY a.code, a.rn)"""


@query("macd", f"""WITH {BARS}, seqd AS (SELECT code, date, close, row_number() OVER (PARTITION BY code ORDER BY date) AS rn FROM bars),
difs AS (SELECT s.code, s.date, s.rn, f.e - w.e AS dif FROM seqd s JOIN {_ema_sql('close', 12, 'seqd')} f USING (code, rn) JOIN {_ema_sql('close', 26, 'seqd')} w USING (code, rn))
SELECT d.code, strftime(d.date, '%Y-%m-%d') AS date, round(dif, 4) AS dif, round(g.e, 4) AS dea, round((dif - g.e) * 2, 4) AS macd
FROM difs d JOIN {_ema_sql('dif', 9, 'difs')} g USING (code, rn)""")
def macd(t):
    return final(indicators.macd(bars_of(t).select("code", "date", "close")).select("code", "date", "dif", "dea", "macd"), 4)


@query("support_resistance", f"""WITH {BARS} SELECT code, strftime(date, '%Y-%m-%d') AS date,
round(min(low) {FRAME20}, 6) AS support, round(max(high) {FRAME20}, 6) AS resistance FROM bars""")
def support_resistance(t):
    return final(indicators.support_resistance(bars_of(t)).select("code", "date", "support", "resistance"))


@query("volume_trend", f"""WITH {BARS}, r AS (SELECT code, date, volume / avg(volume) {FRAME20} AS ratio FROM bars)
SELECT code, strftime(date, '%Y-%m-%d') AS date, round(ratio, 6) AS volume_ratio,
CASE WHEN ratio > 1.2 THEN 'rising' WHEN ratio < 0.8 THEN 'falling' ELSE 'flat' END AS volume_trend FROM r""")
def volume_trend(t):
    return final(indicators.volume_trend(bars_of(t)).select("code", "date", "volume_ratio", "volume_trend"))


# ---- instruments, members, macro --------------------------------------------------------------


@query("scan_stock_basic", """SELECT plain_code AS code, "名称" AS code_name, '1' AS "tradeStatus", industry, strftime("ipoDate", '%Y-%m-%d') AS "ipoDate"
FROM v_instruments""")
def scan_stock_basic(t):
    return final(market.stock_basic(t.v_instruments, None, ["code", "code_name", "tradeStatus", "industry", "ipoDate", "outDate"]))


@query("scan_all_stock", """SELECT "代码" AS code, "名称" AS code_name, listed AS "tradeStatus", industry, market
FROM v_instruments WHERE "ipoDate" <= DATE '2005-06-30'""")
def scan_all_stock(t):
    return market.all_stock(t.v_instruments, "2005-06-30").select("code", "code_name", "tradeStatus", "industry", "market")


@query("scan_dividends", """SELECT code, 'report' AS year_type, strftime("dividPlanDate", '%Y-%m-%d') AS "dividPlanDate",
  strftime("dividOperateDate", '%Y-%m-%d') AS "dividOperateDate", cash_per_share FROM v_dividends WHERE year("dividPlanDate") = 1998
UNION ALL SELECT code, 'operate', strftime("dividPlanDate", '%Y-%m-%d'), strftime("dividOperateDate", '%Y-%m-%d'), cash_per_share
FROM v_dividends WHERE year("dividOperateDate") = 1998""")
def scan_dividends(t):
    parts = [
        market.dividends(t.v_dividends, None, 1998, kind).withColumn("year_type", F.lit(kind)) for kind in ("report", "operate")
    ]
    return final(parts[0].unionByName(parts[1]))


@query("scan_adjust_factor", """SELECT code, strftime("dividOperateDate", '%Y-%m-%d') AS "dividOperateDate", factor FROM v_factors
WHERE "dividOperateDate" BETWEEN DATE '1996-04-01' AND DATE '1999-01-01'""")
def scan_adjust_factor(t):
    return final(market.date_between(t.v_factors, "dividOperateDate", "1996-04-01", "1999-01-01"))


@query("scan_express_report", """SELECT code, strftime("performanceExpPubDate", '%Y-%m-%d') AS "performanceExpPubDate", "performanceExpStatDate", round(revenue, 2) AS revenue, orders
FROM v_express WHERE "performanceExpPubDate" BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'""")
def scan_express_report(t):
    return final(market.date_between(t.v_express, "performanceExpPubDate", "1997-01-01", "1998-12-31"), 2)


@query("scan_forecast_report", """SELECT code, strftime("profitForcastExpPubDate", '%Y-%m-%d') AS "profitForcastExpPubDate", "profitForcastExpStatDate", "profitForcastType"
FROM v_forecast WHERE "profitForcastExpPubDate" >= DATE '1997-01-01'""")
def scan_forecast_report(t):
    return final(market.date_between(t.v_forecast, "profitForcastExpPubDate", "1997-01-01", None))


@query("scan_industry", """SELECT code, code_name, industry, strftime("updateDate", '%Y-%m-%d') AS "updateDate" FROM v_industry
WHERE "updateDate" <= DATE '2000-12-31' QUALIFY rank() OVER (PARTITION BY code ORDER BY "updateDate" DESC) = 1""")
def scan_industry(t):
    return final(market.industry(t.v_industry, None, "2000-12-31"))


@query("scan_index_members", """SELECT index_name, code, code_name, strftime("updateDate", '%Y-%m-%d') AS "updateDate" FROM v_members
WHERE "updateDate" <= DATE '2000-07-15' QUALIFY rank() OVER (PARTITION BY index_name ORDER BY "updateDate" DESC) = 1""")
def scan_index_members(t):
    return final(market.snapshot(t.v_members, ["index_name"], "2000-07-15", few_keys=True).select("index_name", "code", "code_name", "updateDate"))


@query("scan_macro_series", """SELECT series, period, value FROM (
  SELECT series, strftime("pubDate", '%Y-%m-%d') AS period, rate AS value FROM v_rates WHERE series = 'deposit_rate' AND "pubDate" >= DATE '1999-01-01'
  UNION ALL SELECT series, strftime("pubDate", '%Y-%m-%d'), rate FROM v_rates WHERE series = 'loan_rate' AND "pubDate" <= DATE '1996-06-30'
  UNION ALL SELECT series, strftime("effectiveDate", '%Y-%m-%d'), rate FROM v_rates WHERE series = 'required_reserve_ratio'
    AND "effectiveDate" BETWEEN DATE '1998-01-10' AND DATE '1998-12-31'
  UNION ALL SELECT 'money_month', "statYear" || '-' || "statMonth", round(m2, 2) FROM v_money WHERE "statYear" || '-' || "statMonth" BETWEEN '1996-03' AND '1997-02'
  UNION ALL SELECT 'money_year', "statYear", round(arg_max(m2, "statMonth"), 2) FROM v_money WHERE "statYear" >= '1997' GROUP BY "statYear")""")
def scan_macro_series(t):
    def shaped(df, name, period, value):
        return df.select(F.lit(name).alias("series"), period.alias("period"), F.round(value, 6).alias("value"))

    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    return project.union_by_name([
        shaped(market.rates(t.v_rates, market.DEPOSIT, "1999-01-01"), market.DEPOSIT, iso("pubDate"), F.col("rate")),
        shaped(market.rates(t.v_rates, market.LOAN, None, "1996-06-30"), market.LOAN, iso("pubDate"), F.col("rate")),
        shaped(market.rates(t.v_rates, market.RESERVE, "1998-01-10", "1998-12-31", "1"), market.RESERVE, iso("effectiveDate"), F.col("rate")),
        shaped(market.money_supply_month(t.v_money, "1996-03", "1997-02"), "money_month", F.concat_ws("-", "statYear", "statMonth"), F.round("m2", 2)),
        shaped(market.money_supply_year(t.v_money, "1997"), "money_year", F.col("statYear"), F.round("m2", 2)),
    ])


@query("industry_peers", """SELECT code, code_name, industry, count(*) OVER (PARTITION BY industry) AS peer_count FROM v_industry WHERE "updateDate" = DATE '2001-01-08'""")
def industry_peers(t):
    return market.peers(market.industry(t.v_industry)).select("code", "code_name", "industry", "peer_count")


@query("industry_count", """SELECT industry, count(*) AS n FROM v_instruments GROUP BY industry""")
def industry_count(t):
    return t.v_instruments.groupBy("industry").agg(F.count("*").alias("n"))


@query("empty_is_nodata", """SELECT r.code, CASE WHEN f.code IS NULL THEN 'unavailable' ELSE 'ok' END AS status,
CASE WHEN f.code IS NULL THEN 'dividend data is not available for this request.' ELSE '' END AS message
FROM (SELECT DISTINCT plain_code AS code FROM v_instruments) r LEFT JOIN (SELECT DISTINCT code FROM v_dividends WHERE year("dividPlanDate") = 1998) f ON f.code = r.code""")
def empty_is_nodata(t):
    requested = t.v_instruments.select(F.col("plain_code").alias("code"))
    return project.with_request_status(requested, market.dividends(t.v_dividends, None, 1998), ["code"], "dividend data")


@query("project_existing", """SELECT "名称", "代码", industry FROM v_instruments""")
def project_existing(t):
    return project.project_existing(t.v_instruments, ["名称", "missing", "代码", "industry"], strict=True)


# ---- calendar and date functions --------------------------------------------------------------

SPAN_SQL = "SELECT min(date) AS lo, max(date) AS hi FROM v_trading_days"


def span(t):
    return t.v_trading_days.agg(F.min("date").alias("start"), F.max("date").alias("end"))


@query("filter_date_range", """SELECT strftime(date, '%Y-%m-%d') AS date FROM v_trading_days WHERE date BETWEEN DATE '2001-06-30' - 45 AND DATE '2001-06-30'""")
def filter_date_range(t):
    return final(calendar.in_date_range(t.v_trading_days, "date", None, "2001-06-30"))


@query("calendar_range", f"""SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y-%m-%d') AS date FROM ({SPAN_SQL})""")
def calendar_range(t):
    return final(calendar.calendar_range(span(t)))


@query("calendar_trading_flag", f"""WITH days AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS date FROM ({SPAN_SQL}))
SELECT strftime(date, '%Y-%m-%d') AS calendar_date, CASE WHEN date IN (SELECT date FROM v_trading_days) THEN 1 ELSE 0 END AS is_trading_day FROM days""")
def calendar_trading_flag(t):
    return calendar.trading_calendar(t.v_trading_days, span(t))


@query("latest_trading_date", """SELECT coalesce(max(strftime(date, '%Y-%m-%d')), '2001-05-17') AS latest_trading_date FROM v_trading_days WHERE date <= DATE '2001-05-17'""")
def latest_trading_date(t):
    return calendar.latest_trading_date(calendar.trading_calendar(t.v_trading_days, span(t)), "2001-05-17")


@query("quarter_end_code", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 IN (1, 2, 3, 4) THEN year(o_orderdate)::VARCHAR ||
CASE o_orderkey % 6 WHEN 1 THEN '0331' WHEN 2 THEN '0630' WHEN 3 THEN '0930' ELSE '1231' END END AS report_date FROM orders""")
def quarter_end_code(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), dates.quarter_end_code(F.year("o_orderdate"), F.col("o_orderkey") % 6).alias("report_date")
    )


@query("strip_date_dashes", """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') AS compact FROM orders""")
def strip_date_dashes(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"), dates.compact_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("compact")
    )


@query("current_quarter", "SELECT o_orderkey AS id, ((month(o_orderdate) - 1) // 3 + 1)::INTEGER AS quarter FROM orders")
def current_quarter(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.quarter("o_orderdate").alias("quarter"))


@query("analysis_timeframe", """WITH d AS (SELECT o_orderkey AS id, o_orderdate::DATE AS day, ['recent', 'quarter', 'half_year', 'year', 'month'][(o_orderkey % 5 + 1)::INT] AS period,
  date_trunc('month', o_orderdate)::DATE AS m FROM orders),
n AS (SELECT *, CASE WHEN period = 'recent' AND day(day) < 15 AND month(day) <> 2 THEN 2 WHEN period = 'quarter' THEN 3 WHEN period = 'half_year' THEN 6 WHEN period = 'year' THEN 12 ELSE 1 END AS b,
  CASE WHEN period = 'recent' THEN 1 WHEN period = 'quarter' THEN 3 WHEN period = 'half_year' THEN 3 WHEN period = 'year' THEN 6 ELSE 1 END AS c FROM d),
s AS (SELECT *, (m - to_months(b::INT))::DATE AS st, (m - to_months(c::INT))::DATE AS mi FROM n)
SELECT id, period, strftime(st, '%Y-%m-%d') AS start, strftime(mi, '%Y-%m-%d') AS middle, strftime(day, '%Y-%m-%d') AS end_date,
  CASE WHEN year(st) <> year(day) THEN year(st) || '年' || month(st) || '月-' || year(day) || '年' || month(day) || '月'
       WHEN month(mi) <> month(st) AND month(mi) <> month(day) THEN year(st) || '年' || month(st) || '月-' || month(mi) || '月-' || month(day) || '月'
       WHEN month(st) <> month(day) THEN year(st) || '年' || month(st) || '月-' || month(day) || '月'
       ELSE year(st) || '年' || month(st) || '月' END || ' (ISO日期范围: ' || strftime(st, '%Y-%m-%d') || ' 至 ' || strftime(day, '%Y-%m-%d') || ')' AS display
FROM s""")
def analysis_timeframe(t):
    period = F.element_at(F.array(*[F.lit(p) for p in dates.PERIODS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    day = F.col("o_orderdate").cast("date")
    frame = t.orders.select(F.col("o_orderkey").alias("id"), day.alias("day"), period.alias("period")).select(
        "id", "period", dates.analysis_timeframe(F.col("day"), F.col("period")).alias("f")
    )
    return final(frame.select("id", "period", "f.start", "f.middle", F.col("f.end").alias("end_date"), "f.display"))


@query("date_parts_cn", """SELECT event_id, strftime(ts, '%Y年%m月%d日') AS current_date_cn, strftime(ts, '%Y-%m-%d') AS current_date_iso,
  ['星期一', '星期二', '星期三', '星期四', '星期五', '星期六', '星期日'][isodow(ts)] AS current_weekday_cn, strftime(ts, '%H:%M:%S') AS current_clock,
  strftime(ts, '%Y年%m月%d日 (%Y-%m-%d) ') || ['星期一', '星期二', '星期三', '星期四', '星期五', '星期六', '星期日'][isodow(ts)] || strftime(ts, ' %H:%M:%S') AS current_time_info FROM events""")
def date_parts_cn(t):
    parts = t.events.select("event_id", dates.date_parts_cn(F.col("ts")).alias("p"))
    return parts.select(
        "event_id", "p.current_date_cn", F.col("p.current_date").alias("current_date_iso"), "p.current_weekday_cn",
        F.col("p.current_time").alias("current_clock"), "p.current_time_info",
    )


# ---- codes ------------------------------------------------------------------------------------

SPELLED = """(SELECT o_orderkey AS id, code AS plain, CASE o_orderkey % 4 WHEN 0 THEN code WHEN 1 THEN 'SH.' || code WHEN 2 THEN ' sz' || code || ' ' ELSE 'bj.' || code END AS raw
  FROM (SELECT o_orderkey, (CASE o_orderkey % 7 WHEN 0 THEN '6' WHEN 1 THEN '0' WHEN 2 THEN '3' WHEN 3 THEN '8' WHEN 4 THEN '4' WHEN 5 THEN '5' ELSE '9' END) || lpad((o_custkey % 100000)::VARCHAR, 5, '0') AS code FROM orders))"""
SINA = """CASE WHEN regexp_matches(v, '^(sh|sz|bj)') THEN v WHEN v[1] IN ('5', '6', '9') THEN 'sh' || v WHEN v[1] IN ('4', '8') THEN 'bj' || v ELSE 'sz' || v END"""


def spelled(t):
    first = F.element_at(F.array(*[F.lit(x) for x in "6038459"]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    plain = F.concat(first, F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0"))
    raw = (
        F.when(F.col("id") % 4 == 0, F.col("plain")).when(F.col("id") % 4 == 1, F.concat(F.lit("SH."), "plain"))
        .when(F.col("id") % 4 == 2, F.concat(F.lit(" sz"), "plain", F.lit(" "))).otherwise(F.concat(F.lit("bj."), "plain"))
    )
    return t.orders.select(F.col("o_orderkey").alias("id"), plain.alias("plain")).withColumn("raw", raw)


@query("exchange_code_sina", f"SELECT id, raw, {SINA} AS sina FROM (SELECT *, trim(replace(lower(raw), '.', '')) AS v FROM {SPELLED})")
def exchange_code_sina(t):
    return spelled(t).select("id", "raw", codes.exchange_code(F.col("raw")).alias("sina"))


@query("exchange_code_plain", f"SELECT id, substr({SINA}, 3) AS bare FROM (SELECT *, trim(replace(lower(raw), '.', '')) AS v FROM {SPELLED})")
def exchange_code_plain(t):
    return spelled(t).select("id", codes.plain_code(F.col("raw")).alias("bare"))


@query("exchange_code_dotted", f"SELECT id, CASE WHEN plain[1] = '6' THEN 'sh.' || plain WHEN plain[1] IN ('0', '3') THEN 'sz.' || plain ELSE plain END AS dotted FROM {SPELLED}")
def exchange_code_dotted(t):
    return spelled(t).select("id", codes.dotted_code(F.col("plain")).alias("dotted"))


# ---- statements and ratios --------------------------------------------------------------------

STATEMENTS = {statements.PROFIT: "v_profit", statements.BALANCE: "v_balance", statements.CASH: "v_cash"}


def statement_tables(t):
    return {kind: getattr(t, view) for kind, view in STATEMENTS.items()}


TARGET = "(y * 10000 + CASE q WHEN 1 THEN 331 WHEN 2 THEN 630 WHEN 3 THEN 930 ELSE 1231 END)::VARCHAR"
#: For the check: the items of each report by statement, written out. Requests hold one quarter that nobody has published.
REPORT_ITEMS = {
    "profit": {"v_profit": ["营业收入", "营业成本", "营业利润", "净利润"]},
    "balance": {"v_balance": ["货币资金", "应收账款", "存货", "流动资产合计", "资产总计", "流动负债合计", "负债合计", "所有者权益合计"]},
    "cash_flow": {"v_cash": ["经营活动产生的现金流量净额", "投资活动产生的现金流量净额", "筹资活动产生的现金流量净额"]},
    "growth": {"v_profit": ["营业收入", "营业利润", "净利润"], "v_balance": ["资产总计", "所有者权益合计"], "v_cash": []},
    "operation": {"v_profit": ["营业收入"], "v_balance": ["应收账款", "存货", "流动资产合计", "资产总计"], "v_cash": []},
    "dupont": {"v_profit": ["营业收入", "净利润"], "v_balance": ["资产总计", "所有者权益合计"], "v_cash": []},
}
UNPUBLISHED = 2030


def report_sql() -> str:
    names = {view: kind for kind, view in STATEMENTS.items()}
    parts = []
    for report, tables in REPORT_ITEMS.items():
        for view, items in tables.items():
            picked = "".join(f', round("{i}", 6) AS "{i}"' for i in items)
            which = "" if report in statements.TWO_PERIODS else " WHERE b = 0"
            parts.append(
                f"""SELECT '{report}' AS report, w.code, request_year, q, y AS report_year, '{names[view]}' AS statement, "报告日" AS report_date{picked}
FROM (SELECT *, {TARGET} AS target FROM asked{which}) w ASOF JOIN {view} p ON w.code = p.code AND w.target >= p."报告日" """
            )
    return (
        f"""WITH r AS (SELECT code, y, q FROM v_statement_requests UNION SELECT code, {UNPUBLISHED}, 1 FROM v_statement_requests),
asked AS (SELECT code, y AS request_year, q, y - b AS y, b FROM r, (SELECT unnest([0, 1]) AS b))
"""
        + "\nUNION ALL BY NAME ".join(parts)
    )


@query("scan_statement", report_sql())
def scan_statement(t):
    """All six reports for every requested quarter, those not yet published as of the newest before, stacked."""
    asked = t.v_statement_requests
    later = asked.select("code", F.lit(UNPUBLISHED).cast("long").alias("y"), F.lit(1).cast("long").alias("q")).distinct()
    requests = asked.unionByName(later)
    made = []
    for kind in statements.KEYWORDS:
        found = statements.statement_report(kind, statement_tables(t), requests)
        if kind in statements.TWO_PERIODS:
            found = found.withColumnRenamed(statements.REPORT_TYPE, "statement")
        else:
            found = found.withColumnsRenamed({"y": "request_year"}).withColumns(
                {"report_year": F.col("request_year"), "statement": F.lit(statements.STATEMENT_OF[kind])}
            )
        made.append(found.withColumn("report", F.lit(kind)).withColumnRenamed(statements.REPORT_DATE, "report_date").drop("币种", "类型"))
    return final(project.union_by_name(made))


@query("project_keyword_columns", """SELECT code, "报告日", "币种", "营业收入", "营业成本", "营业利润", "净利润" FROM
(SELECT code, "报告日", "币种", round("营业收入", 6) AS "营业收入", round("营业成本", 6) AS "营业成本", round("营业利润", 6) AS "营业利润", round("净利润", 6) AS "净利润" FROM v_profit)""")
def project_keyword_columns(t):
    return final(project.project_keyword_columns(t.v_profit, statements.KEYWORDS["profit"], keep=["code"]))


@query("asof_statement", f"""WITH r AS (SELECT code, y, q, {TARGET} AS target FROM v_statement_requests)
SELECT r.code, r.y, r.q, r.target, p."报告日" AS report_date, round(p."净利润", 6) AS net_income
FROM r ASOF JOIN v_profit p ON r.code = p.code AND r.target >= p."报告日" """)
def asof_statement(t):
    requests = statements.with_target(t.v_statement_requests)
    found = statements.asof_statement(t.v_profit, requests)
    return final(found.select("code", "y", "q", "target", F.col("报告日").alias("report_date"), F.col("净利润").alias("net_income")))


@query("first_eligible", f"""WITH r AS (SELECT code, y, q, {TARGET} AS target FROM v_statement_requests)
SELECT r.code, r.target, max(b."报告日") AS report_date FROM r JOIN v_balance b ON r.code = b.code AND b."报告日" <= r.target GROUP BY r.code, r.target""")
def first_eligible(t):
    requests = statements.with_target(t.v_statement_requests)
    return statements.asof_statement(t.v_balance, requests).select("code", "target", F.col("报告日").alias("report_date"))


TWO_PERIOD = f"""w AS (SELECT code, y AS request_year, q, y - b AS ry FROM v_statement_requests, (SELECT unnest([0, 1]) AS b)),
w2 AS (SELECT *, {TARGET.replace('y *', 'ry *')} AS target FROM w)"""


@query("two_period_reports", f"""WITH {TWO_PERIOD}
SELECT w2.code, request_year, q, ry AS report_year, '利润表' AS "报表", "报告日", round("净利润", 6) AS "净利润", NULL::DOUBLE AS "资产总计", NULL::VARCHAR AS "类型"
FROM w2 ASOF JOIN v_profit p ON w2.code = p.code AND w2.target >= p."报告日"
UNION ALL SELECT w2.code, request_year, q, ry, '资产负债表', "报告日", NULL, round("资产总计", 6), NULL FROM w2 ASOF JOIN v_balance p ON w2.code = p.code AND w2.target >= p."报告日"
UNION ALL SELECT w2.code, request_year, q, ry, '现金流量表', "报告日", NULL, NULL, "类型" FROM w2 ASOF JOIN v_cash p ON w2.code = p.code AND w2.target >= p."报告日" """)
def two_period_reports(t):
    stacked = statements.two_period_reports(statement_tables(t), t.v_statement_requests)
    return final(stacked.select("code", "request_year", "q", "report_year", "报表", "报告日", "净利润", "资产总计", "类型"))


@query("union_by_name", """SELECT code, "报告日", "币种", round("净利润", 6) AS "净利润", "股数", NULL::VARCHAR AS "类型", NULL::DOUBLE AS "筹资活动产生的现金流量净额" FROM v_profit
UNION ALL BY NAME SELECT code, "报告日", "币种", "类型", round("筹资活动产生的现金流量净额", 6) AS "筹资活动产生的现金流量净额" FROM v_cash""")
def union_by_name(t):
    return final(project.union_by_name([
        t.v_profit.select("code", "报告日", "币种", "净利润", "股数"),
        t.v_cash.select("code", "报告日", "币种", "类型", "筹资活动产生的现金流量净额"),
    ]))


JOINED = 'FROM v_profit p JOIN v_balance b ON p.code = b.code AND p."报告日" = b."报告日"'


@query("profitability_ratios", f"""SELECT p.code, p."报告日" AS report_date, round(("营业收入" - "营业成本") / "营业收入" * 100, 6) AS gross_margin,
round("净利润" / "营业收入" * 100, 6) AS net_margin, round("净利润" / nullif("所有者权益合计", 0) * 100, 6) AS roe {JOINED}""")
def profitability_ratios(t):
    return final(statements.profitability(t.v_profit, t.v_balance))


@query("turnover_ratios", f"""SELECT p.code, p."报告日" AS report_date, round("营业收入" / nullif("应收账款", 0), 6) AS receivable_turnover,
round("营业成本" / nullif("存货", 0), 6) AS inventory_turnover, round("营业收入" / nullif("资产总计", 0), 6) AS asset_turnover {JOINED}""")
def turnover_ratios(t):
    return final(statements.turnover(t.v_profit, t.v_balance))


@query("leverage_ratios", """SELECT code, "报告日" AS report_date, round("负债合计" / nullif("资产总计", 0) * 100, 6) AS debt_ratio,
round("流动资产合计" / nullif("流动负债合计", 0), 6) AS current_ratio FROM v_balance""")
def leverage_ratios(t):
    return final(statements.leverage(t.v_balance))


@query("growth_yoy", """SELECT a.code, a."报告日" AS report_date, round((a."营业收入" / b."营业收入" - 1) * 100, 4) AS revenue_growth,
round((a."净利润" / nullif(b."净利润", 0) - 1) * 100, 4) AS income_growth
FROM v_profit a JOIN v_profit b ON a.code = b.code AND a."报告日"::INT = b."报告日"::INT + 10000""")
def growth_yoy(t):
    return final(statements.growth_yoy(t.v_profit, {"revenue_growth": "营业收入", "income_growth": "净利润"}), 4)


PE = """eps AS (SELECT code, strptime("报告日", '%Y%m%d')::DATE AS rd, "净利润" / nullif("股数", 0) AS eps FROM v_profit),
pe AS (SELECT b.code, b.date, b.close, b.close / e.eps AS pe FROM bars b ASOF JOIN eps e ON b.code = e.code AND b.date >= e.rd WHERE e.eps > 0)"""


def multiples(t):
    return statements.price_multiple(bars_of(t), t.v_profit)


@query("valuation_percentile", f"""WITH {BARS}, {PE} SELECT code, strftime(date, '%Y-%m-%d') AS date, round(pe, 10) AS pe,
round(percent_rank() OVER (PARTITION BY code ORDER BY pe) * 100, 6) AS percentile FROM pe""")
def valuation_percentile(t):
    return final(statements.percentile_in_history(multiples(t).select("code", "date", "pe"), "pe"), pe=10)


@query("valuation_vs_industry", f"""WITH {BARS}, {PE}, last AS (SELECT code, arg_max(pe, date) AS pe FROM pe GROUP BY code),
tagged AS (SELECT l.code, i.industry, pe FROM last l JOIN v_industry i ON i.code = l.code AND i."updateDate" = DATE '2001-01-08')
SELECT code, industry, round(pe, 10) AS pe, round(avg(pe) OVER (PARTITION BY industry), 10) AS industry_mean, count(*) OVER (PARTITION BY industry) AS peers,
round(pe - avg(pe) OVER (PARTITION BY industry), 10) AS gap FROM tagged""")
def valuation_vs_industry(t):
    latest = multiples(t).groupBy("code").agg(F.max_by("pe", "date").alias("pe"))
    return final(statements.against_industry(latest, market.industry(t.v_industry), "pe"), 10)


@query("dividend_yield", f"""WITH {BARS}, last AS (SELECT code, max(date) AS last_date, arg_max(close, date) AS last_close FROM bars GROUP BY code),
paid AS (SELECT l.code, sum(cash_per_share) AS cash FROM last l JOIN v_dividends d ON d.code = l.code AND d."dividOperateDate" <= l.last_date
  AND d."dividOperateDate" > l.last_date - INTERVAL 12 MONTH GROUP BY l.code)
SELECT l.code, round(last_close, 6) AS last_close, round(coalesce(cash, 0), 6) AS cash, round(coalesce(cash, 0) / last_close * 100, 6) AS dividend_yield
FROM last l LEFT JOIN paid p ON p.code = l.code""")
def dividend_yield(t):
    return final(statements.dividend_yield(t.v_dividends, bars_of(t)))
