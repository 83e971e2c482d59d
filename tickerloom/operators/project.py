"""Projections over columns that may or may not exist, and key-driven status rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns a statement keeps first and default field lists.
STATEMENT_FIXED = ["报告日", "类型", "币种", "更新日期"]
KLINE_PREFERRED = [
    "date", "code", "open", "high", "low", "close", "preclose", "volume", "amount", "turnover", "pctChg", "adjustflag",
]
BASIC_DEFAULT = ["code", "tradeStatus", "code_name"]
#: Ends the message of a request without data.
UNAVAILABLE = " is not available for this request."


def project_existing(
    df: DataFrame, fields: Sequence[str] | None, default: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """The requested columns that exist, in the requested order; the default list when none is given."""
    wanted = list(fields) if fields else list(default if default is not None else df.columns)
    if not all(isinstance(name, str) for name in wanted):
        raise ValueError("field names must be strings")
    existing = [name for name in wanted if name in df.columns]
    if strict and not existing:
        raise ValueError(f"none of the fields {wanted} exist")
    return df.select(*[F.col(f"`{name}`") for name in existing])


def project_keyword_columns(df: DataFrame, keywords: Sequence[str], keep: Sequence[str] = (), most: int | None = None) -> DataFrame:
    """Fixed columns, then the columns whose name holds a keyword, the first ``most`` of them if given; all if none does.

    ``keep`` names key columns of the table form that stay in front.
    """
    fixed = [c for c in STATEMENT_FIXED if c in df.columns]
    matched = [c for c in df.columns if c not in fixed and c not in keep and any(k in c for k in keywords)]
    chosen = fixed + matched[:most]
    columns = list(keep) + chosen if chosen else df.columns
    return df.select(*[F.col(f"`{c}`") for c in columns])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames with differing columns; missing ones become null, first-seen order is kept."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def with_request_status(requested: DataFrame, found: DataFrame, keys: Sequence[str], feature: str) -> DataFrame:
    """Every requested key with ``ok`` or ``unavailable`` and the message that replaces missing data."""
    marked = found.select(*keys).distinct().withColumn("_found", F.lit(True))
    missing = F.col("_found").isNull()
    return requested.select(*keys).distinct().join(marked, list(keys), "left").select(
        *keys,
        F.when(missing, "unavailable").otherwise("ok").alias("status"),
        F.when(missing, feature + UNAVAILABLE).otherwise("").alias("message"),
    )
