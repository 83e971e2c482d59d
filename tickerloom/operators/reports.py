"""Per-company report tables built from the analysis branches."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Section names and their error titles, defaults of a missing section or identity, field labels.
SECTIONS = {"fundamental": "Fundamental", "technical": "Technical", "value": "Value", "news": "News"}
NOT_AVAILABLE = "Not available"
UNKNOWN_COMPANY = "Unknown Company"
FIELD_LABELS = {
    "code": "股票代码",
    "code_name": "股票名称",
    "industry": "所属行业",
    "ipoDate": "上市日期",
    "roe": "ROE(净资产收益率)",
    "net_margin": "销售净利率",
    "equity_growth": "净资产同比增长",
    "asset_growth": "总资产同比增长",
    "income_growth": "净利润同比增长",
    "current_ratio": "流动比率",
    "debt_ratio": "资产负债率",
    "latest_price": "最新收盘价",
    "price_change": "6个月价格变动",
    "ma20": "20日均价",
    "distance_pct": "20日均线偏离",
    "peer_count": "同行业股票数量",
}


def fan_in(branches: Mapping[str, DataFrame]) -> DataFrame:
    """Branch results per code, each ``<section>_analysis`` and ``<section>_analysis_error``; a code in any branch stays.

    Every branch holds one row per code, so the outer joins stay one row per code.
    """
    named = [
        df.select("code", F.col("analysis").alias(f"{name}_analysis"), F.col("error").alias(f"{name}_analysis_error"))
        for name, df in branches.items()
    ]
    return reduce(lambda a, b: a.join(b, "code", "full_outer"), named)


def report_sections(joined: DataFrame) -> DataFrame:
    """Availability (no error and a text), texts with their default, and the error list."""
    flags = [
        (F.col(f"{s}_analysis").isNotNull() & F.col(f"{s}_analysis_error").isNull()).alias(f"has_{s}") for s in SECTIONS
    ]
    texts = [F.coalesce(f"{s}_analysis", F.lit(NOT_AVAILABLE)).alias(s) for s in SECTIONS]
    errors = F.array_compact(
        F.array(*[F.concat(F.lit(f"{title} Analysis Error: "), F.col(f"{s}_analysis_error")) for s, title in SECTIONS.items()])
    )
    return joined.select("code", *flags, *texts, F.array_join(errors, ". ").alias("errors"))


def report_fields(parts: DataFrame) -> DataFrame:
    """Field/value rows of a report; absent columns and null values are skipped."""
    present = [c for c in FIELD_LABELS if c in parts.columns]
    text = [
        F.struct(
            F.lit(FIELD_LABELS[c]).alias("field"),
            (F.format_string("%.2f", F.col(c)) if dict(parts.dtypes)[c] == "double" else F.col(c).cast("string")).alias("value"),
            F.col(c).isNotNull().alias("known"),
        )
        for c in present
    ]
    return parts.select("code", F.inline(F.filter(F.array(*text), lambda x: x["known"]))).select("code", "field", "value")
