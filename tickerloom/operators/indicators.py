"""Indicators over bars. All windows are per code over bars, which the calendar bounds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _by_date():
    return W.partitionBy("code").orderBy("date")


def _trailing(n: int):
    return _by_date().rowsBetween(-(n - 1), 0)


def _full(value: Column, n: int) -> Column:
    """``value`` once ``n`` bars are in the frame, else null."""
    return F.when(F.count(F.lit(1)).over(_trailing(n)) == n, value)


def price_change(bars: DataFrame) -> DataFrame:
    """First and last close per code and the change in percent; one-bar series are left out."""
    return (
        bars.groupBy("code")
        .agg(F.min_by("close", "date").alias("start_price"), F.max_by("close", "date").alias("latest_price"), F.count("*").alias("n"))
        .where("n > 1")
        .select("code", "start_price", "latest_price", ((F.col("latest_price") / F.col("start_price") - 1) * 100).alias("price_change"))
    )


def last_days(bars: DataFrame, days: int = 180) -> DataFrame:
    """Bars of the last ``days`` days up to each code's newest bar."""
    newest = bars.groupBy("code").agg(F.max("date").alias("_newest"))
    return bars.join(newest, "code").where(F.col("date") >= F.date_sub("_newest", days)).drop("_newest")


def ma_tail(bars: DataFrame, n: int = 20) -> DataFrame:
    """Mean of the last ``n`` closes per code, for codes with at least ``n`` bars."""
    newest_first = W.partitionBy("code").orderBy(F.desc("date"))
    return (
        bars.select("code", "date", "close", F.row_number().over(newest_first).alias("_rn"))
        .where(F.col("_rn") <= n)
        .groupBy("code")
        .agg(F.avg("close").alias("ma20"), F.max_by("close", "date").alias("latest_price"), F.count("*").alias("_n"))
        .where(F.col("_n") == n)
        .drop("_n")
    )


def ma_position(averages: DataFrame) -> DataFrame:
    """Whether the price is above or below its average, and by how many percent."""
    above = F.col("latest_price") > F.col("ma20")
    return averages.select(
        "code",
        "latest_price",
        "ma20",
        F.when(above, "above").otherwise("below").alias("side"),
        F.when(above, (F.col("latest_price") / F.col("ma20") - 1) * 100)
        .otherwise((F.col("ma20") / F.col("latest_price") - 1) * 100)
        .alias("distance_pct"),
    )


def ma_rolling(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.withColumn("ma20", _full(F.avg("close").over(_trailing(n)), n))


def rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    """Relative strength index in its simple-mean form; 100 when the frame holds no loss."""
    step = F.col("close") - F.lag("close").over(_by_date())
    moved = bars.withColumn("_step", step)
    gain = F.avg(F.greatest("_step", F.lit(0.0))).over(_trailing(n))
    loss = F.avg(F.greatest(-F.col("_step"), F.lit(0.0))).over(_trailing(n))
    enough = F.count("_step").over(_trailing(n)) == n
    value = F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.col("_gain") / F.col("_loss")))
    return (
        moved.withColumn("_gain", gain)
        .withColumn("_loss", loss)
        .withColumn("_enough", enough)
        .withColumn("rsi", F.when(F.col("_enough"), value))
        .drop("_step", "_gain", "_loss", "_enough")
    )


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Difference of two exponential means, its signal line and the histogram (twice the gap).

    The means run over all bars of a code, weights normalised; one pass per code in date order. Bars of a code are
    bounded by the calendar.
    """
    schema = T.StructType([*bars.schema.fields, *(T.StructField(n, T.DoubleType()) for n in ("dif", "dea", "macd"))])

    def lines(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("date")
        mean = lambda values, span: values.ewm(span=span, adjust=True, ignore_na=True).mean()
        dif = mean(group["close"].astype(float), fast) - mean(group["close"].astype(float), slow)
        dea = mean(dif, signal)
        return group.assign(dif=dif, dea=dea, macd=(dif - dea) * 2)

    return bars.groupBy("code").applyInPandas(lines, schema)


def support_resistance(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.withColumn("support", F.min("low").over(_trailing(n))).withColumn(
        "resistance", F.max("high").over(_trailing(n))
    )


def volume_trend(bars: DataFrame, n: int = 20) -> DataFrame:
    """Volume over its trailing mean, with a label at 20 percent either way."""
    ratio = F.col("volume") / F.avg("volume").over(_trailing(n))
    return bars.withColumn("volume_ratio", ratio).withColumn(
        "volume_trend",
        F.when(F.col("volume_ratio") > 1.2, "rising").when(F.col("volume_ratio") < 0.8, "falling").otherwise("flat"),
    )
