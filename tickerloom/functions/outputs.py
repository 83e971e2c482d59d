"""Scores parsed from generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The answer marker and the texts of the five scores.
ANSWER_MARKER = "Assistant:"
SENTIMENT_TEXTS = ["负面", "轻微负面", "中性", "正面", "极正面"]
RISK_TEXTS = ["极低风险", "低风险", "中等风险", "高风险", "极高风险"]
SENTIMENT_FAILED = "无法分析情感"
RISK_FAILED = "无法分析风险"


def first_score(text: Column) -> Column:
    """The first digit 1..5 without a digit next to it, else null."""
    found = F.regexp_extract(text, r"(?<!\d)([1-5])(?!\d)", 1)
    return F.when(found != "", found).cast("int")


def tail_score(text: Column) -> Column:
    """The first word after the last answer marker, if it is an integer in 1..5."""
    tail = F.element_at(F.split(text, ANSWER_MARKER), -1)
    number = F.regexp_extract(tail, r"^\s*(\S+)", 1).try_cast("int")
    return F.when(number.between(1, 5), number)


def score_text(score: Column, texts: list[str]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in texts]), score - 1)


def score_with_text(score: Column, texts: list[str], failed: str) -> Column:
    """``score (text)``, or the failure text when there is no score."""
    named = F.concat(score.cast("string"), F.lit(" ("), score_text(score, texts), F.lit(")"))
    return F.coalesce(named, F.lit(failed))
