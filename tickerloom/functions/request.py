"""Company and code from a free-text request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Request patterns. In PAIRS the code is in brackets next to the company, given as
# (pattern, company group, code group); COMPANY and CODE are tried in order; STOP_WORDS are removed
# in order.
PAIRS = [
    (r"请帮我分析一下\s*([^（(]+?)\s*[（(](\d{5,6})[)）]", 1, 2),
    (r"分析一下\s*([^（(]+?)\s*[（(](\d{5,6})[)）]", 1, 2),
    (r"分析\s*([^（(]+?)\s*[（(](\d{5,6})[)）]", 1, 2),
    (r"分析\s*[（(](\d{5,6})[)）]\s*([^）)]+)", 2, 1),
    (r"帮我看看\s*[（(](\d{5,6})[)）]\s*([^）)]+?)(?:\s*这只|\s*这个)?\s*股票", 2, 1),
    (r"我想了解一下\s*([^（(]+?)\s*[（(](\d{5,6})[)）]", 1, 2),
    (r"帮我看看\s*([^（(]+?)\s*[（(](\d{5,6})[)）]", 1, 2),
    (r"^([^（(]+?)\s*[（(](\d{5,6})[)）]", 1, 2),
]
COMPANY = [
    r"分析一下\s*([^0-9（）()\s]+?)(?:\s*的|\s|$)",
    r"分析\s*([^0-9（）()\s]+)",
    r"([^0-9（）()\s]+)\s*(?:这只|这个|的)?\s*股票",
    r"了解一下\s*([^0-9（）()\s]+?)(?:\s*的|\s|$)",
    r"([^0-9（）()\s]+?)\s*的\s*(?:财务表现|盈利能力|现金流状况|资产负债情况|技术面|股价走势|技术指标|技术面表现|估值水平|市盈率|市净率|估值|投资风险|风险因素|风险评估|投资价值|股票|基本面情况|基本面|财务状况)",
    r"([^0-9（）()\s]+?)\s*在\s*[^0-9（）()\s]*\s*中",
    r"([^0-9（）()\s]+?)\s*面临",
]
CODE = [
    r"\b(\d{5,6})\b",
    r"(\d{5,6})\s*(?:这个|这只)?\s*股票\s*值得买",
    r"(\d{5,6})\s*这个\s*股票\s*最近表现",
]
STOP_WORDS = [
    "的", "这个", "这只", "一下", "看看", "了解", "分析", "帮我", "我想", "给我", "财务状况", "投资价值", "基本面情况", "这只股票", "这个股票",
]
LEAST_COMPANY_CHARACTERS = 2


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _group(query: Column, pattern: str, group: int) -> Column:
    """A capture group; null when the pattern does not match (no pattern captures an empty string)."""
    found = F.regexp_extract(query, "(?U)" + pattern, group)
    return F.when(found != "", found)


def stock_request(query: Column) -> Column:
    """Struct of company and code, each null when absent."""
    paired = [
        (_strip(_group(query, p, company)), _group(query, p, code)) for p, company, code in PAIRS
    ]
    company = F.coalesce(*[_group(query, p, 1) for p in COMPANY])
    for word in STOP_WORDS:
        company = _strip(F.replace(company, F.lit(word), F.lit("")))
    company = F.when(F.length(company) >= LEAST_COMPANY_CHARACTERS, company)
    code = F.coalesce(*[_group(query, p, 1) for p in CODE])
    pair = F.coalesce(
        *[F.when(c.isNotNull(), F.struct(name.alias("company"), c.alias("code"))) for name, c in paired],
        F.struct(company.alias("company"), code.alias("code")),
    )
    return pair
