"""Prompt texts for scoring news."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# System texts and the three worked examples of the older conversation form.
SYSTEM = {
    "sentiment": (
        "You are a financial news sentiment analyst. Given one summarized news item about a stock, return exactly "
        "one integer score from 1 to 5: 1=negative, 2=somewhat negative, 3=neutral, 4=somewhat positive, 5=positive. "
        "Return only the score."
    ),
    "risk": (
        "You are a financial risk analyst. Given one summarized news item about a stock, return exactly one integer "
        "risk score from 1 to 5: 1=very low risk, 2=low risk, 3=moderate risk, 4=high risk, 5=very high risk. "
        "Return only the score."
    ),
}
LEGACY_SYSTEM = {
    "sentiment": (
        "Forget all your previous instructions. You are a financial expert with stock recommendation experience. "
        "Based on a specific stock, score for range from 1 to 5, where 1 is negative, 2 is somewhat negative, "
        "3 is neutral, 4 is somewhat positive, 5 is positive. 1 summarized news will be passed in each time, "
        "you will give score in format as shown below in the response from assistant."
    ),
    "risk": (
        "Forget all your previous instructions. You are a financial expert specializing in risk assessment for stock "
        "recommendations. Based on a specific stock, provide a risk score from 1 to 5, where: 1 indicates very low "
        "risk, 2 indicates low risk, 3 indicates moderate risk (default if the news lacks any clear indication of "
        "risk), 4 indicates high risk, and 5 indicates very high risk. 1 summarized news will be passed in each time. "
        "Provide the score in the format shown below in the response from the assistant."
    ),
}
LEGACY_EXAMPLES = {
    "sentiment": [
        ("Apple (AAPL) increase 22%", 5),
        ("Apple (AAPL) price decreased 30%", 1),
        ("Apple (AAPL) announced iPhone 15", 4),
    ],
    "risk": [
        ("Apple (AAPL) increases 22%", 3),
        ("Apple (AAPL) price decreased 30%", 4),
        ("Apple (AAPL) announced iPhone 15", 3),
    ],
}


def user_content(symbol: Column, summary: Column) -> Column:
    return F.concat(F.lit("Stock symbol: "), symbol, F.lit("\nSummarized news: "), summary)


def messages(task: str, symbol: Column, summary: Column) -> Column:
    """System and user message. The chat template of a tokenizer is applied outside."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(SYSTEM[task]).alias("content")),
        F.struct(F.lit("user").alias("role"), user_content(symbol, summary).alias("content")),
    )


def legacy_head(task: str) -> str:
    shown = "".join(f"User: News to Stock Symbol -- AAPL: {news}\nAssistant: {score}\n\n" for news, score in LEGACY_EXAMPLES[task])
    return f"System: {LEGACY_SYSTEM[task]}\n\n{shown}"


def legacy_conversation(task: str, symbol: Column, summary: Column, score: Column | None = None) -> Column:
    """The worked-example conversation; it ends at the answer marker when no score is given."""
    asked = F.concat(F.lit(legacy_head(task) + "User: News to Stock Symbol -- "), symbol, F.lit(": "), summary, F.lit("\nAssistant:"))
    return asked if score is None else F.concat(asked, F.lit(" "), score.cast("string"))
