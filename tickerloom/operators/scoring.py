"""Batch scoring of news with a user-supplied model, and the softmax over its candidate logits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.text import let
from tickerloom.session import bound_batches

# Candidate scores and the digits kept of a probability.
SCORES = [1, 2, 3, 4, 5]
PROBABILITY_DIGITS = 4

# A model maps (symbols, summaries) to one list of five logits per row.
Model = Callable[[pd.Series, pd.Series], "list[list[float]]"]


def softmax_score(logits: Column) -> Column:
    """Struct of the best score and the rounded probability of each score."""
    keys = F.array(*[F.lit(str(s)) for s in SCORES])

    def probabilities(weights: Column) -> Column:
        total = F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w)
        return let(total, lambda z: F.transform(weights, lambda w: F.round(w / z, PROBABILITY_DIGITS)))

    weights = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    best = F.array_position(logits, F.array_max(logits)).cast("int")
    return F.struct(
        F.element_at(F.array(*[F.lit(s) for s in SCORES]), best).alias("score"),
        F.map_from_arrays(keys, let(weights, probabilities)).alias("probabilities"),
    )


def logits_udf(load_sentiment: Callable[[], Model], load_risk: Callable[[], Model]):
    """One Arrow function for both models, so texts travel once; each loads once per Python worker."""

    @F.pandas_udf(T.StructType().add("sentiment", T.ArrayType(T.DoubleType())).add("risk", T.ArrayType(T.DoubleType())))
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sentiment, risk = load_sentiment(), load_risk()
        for symbols, summaries in batches:
            yield pd.DataFrame({"sentiment": sentiment(symbols, summaries), "risk": risk(symbols, summaries)})

    return run


def score_news(items: DataFrame, load_sentiment: Callable[[], Model], load_risk: Callable[[], Model]) -> DataFrame:
    """Sentiment and risk structs per item with ``stock_symbol`` and ``summary``; each row is scored once."""
    logits = bound_batches(items).withColumn("_logits", logits_udf(load_sentiment, load_risk)(F.col("stock_symbol"), F.col("summary")))
    return logits.select(
        *items.columns, softmax_score(F.col("_logits.sentiment")).alias("sentiment"), softmax_score(F.col("_logits.risk")).alias("risk")
    )
