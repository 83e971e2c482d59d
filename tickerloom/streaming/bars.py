"""Bars over a stream of ticks: the batch aggregates under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.klines import INTRADAY_MINUTES, tick_aggregates


def streaming_bars(ticks: DataFrame, frequency: str = "15", lateness: str = "10 minutes") -> DataFrame:
    """Intraday bars of a streaming tick table; state is one row per open bar and code.

    A bar is emitted (append mode) once the watermark passes its end, and then dropped from state.
    """
    width = f"{INTRADAY_MINUTES[frequency]} minutes"
    return (
        ticks.withWatermark("ts", lateness)
        .groupBy("code", F.window("ts", width).alias("bar"))
        .agg(*tick_aggregates())
        .where("open IS NOT NULL")
        .select("code", F.col("bar.start").alias("bar_start"), "open", "high", "low", "close", "volume", "amount")
    )
