"""Price bars: from ticks, resampled, with previous close and change, adjusted.

Ticks are reduced to one bar per code and interval by a partially aggregated ``GROUP BY``, so a
code that holds a third of the ticks costs no more than its number of bars in the shuffle. The
windows that follow run over bars, whose number per code is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions.dates import friday_on_or_after
from tickerloom.operators.project import KLINE_PREFERRED, project_existing

# Adjustment flags, bar frequencies.
ADJUST_FORWARD, ADJUST_BACKWARD, ADJUST_NONE = "1", "2", "3"
DAILY, WEEKLY, MONTHLY = "d", "w", "m"
INTRADAY_MINUTES = {"5": 5, "15": 15, "30": 30, "60": 60}


def tick_aggregates(price: str = "price", order: str = "seq") -> list[Column]:
    """OHLC, volume and amount. ``order`` is a fixed-width sequence so the hash aggregate is kept."""
    traded = F.when(F.col(price).isNotNull(), F.col(order))
    return [
        F.min_by(price, traded).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, traded).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("amount").alias("amount"),
    ]


def daily_bars(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("code", "date").agg(*tick_aggregates()).where("open IS NOT NULL")


def intraday_bars(ticks: DataFrame, frequency: str) -> DataFrame:
    width = f"{INTRADAY_MINUTES[frequency]} minutes"
    return (
        ticks.groupBy("code", F.window("ts", width).alias("bar"))
        .agg(*tick_aggregates())
        .where("open IS NOT NULL")
        .select("code", F.col("bar.start").alias("bar_start"), "open", "high", "low", "close", "volume", "amount")
    )


def resample(bars: DataFrame, frequency: str) -> DataFrame:
    """Weekly (label: Friday on or after) or monthly (label: month end) bars; incomplete bars are dropped."""
    label = {WEEKLY: friday_on_or_after(F.col("date")), MONTHLY: F.last_day("date")}[frequency]

    def dated(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.col("date"))

    known = {
        "open": F.min_by("open", dated("open")),
        "high": F.max("high"),
        "low": F.min("low"),
        "close": F.max_by("close", dated("close")),
        "volume": F.coalesce(F.sum("volume"), F.lit(0)),
        "amount": F.coalesce(F.sum("amount"), F.lit(0.0)),
    }
    present = [name for name in known if name in bars.columns]
    return (
        bars.groupBy("code", label.alias("date"))
        .agg(*[known[name].alias(name) for name in present])
        .dropna(subset=present)
    )


def with_preclose(bars: DataFrame) -> DataFrame:
    previous = F.lag("close").over(W.partitionBy("code").orderBy("date"))
    return bars.withColumn("preclose", previous).withColumn(
        "pctChg", (F.col("close") / F.col("preclose") - 1) * 100
    )


def with_scales(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """``bars`` with ``backward``, the factor in force on the bar date, and ``forward``, that over the latest factor.

    The factor is carried along the code's date order with one window over bars and factor rows, so
    no bar x factor pairs are formed. Bars before the first factor use 1.
    """
    stacked = bars.withColumn("_bar", F.lit(1)).unionByName(
        factors.select("code", F.col("dividOperateDate").alias("date"), F.col("factor").alias("_factor"), F.lit(0).alias("_bar")),
        allowMissingColumns=True,
    )
    ordered = W.partitionBy("code").orderBy("date", "_bar")
    carried = F.last("_factor", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0))
    latest = F.last("_factor", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    in_force = F.coalesce("_carried", F.lit(1.0))
    scales = [in_force.alias("backward"), (in_force / F.coalesce("_latest", F.lit(1.0))).alias("forward")]
    return stacked.withColumn("_carried", carried).withColumn("_latest", latest).where("_bar = 1").select(*bars.columns, *scales)


def adjust(bars: DataFrame, factors: DataFrame, flag: str) -> DataFrame:
    """Prices times the factor in force on the bar date; the forward form divides by the latest factor."""
    if flag == ADJUST_NONE:
        return bars
    prices = [c for c in ("open", "high", "low", "close") if c in bars.columns]
    scale = F.col("forward" if flag == ADJUST_FORWARD else "backward")
    return with_scales(bars, factors).select(*[(F.col(c) * scale).alias(c) if c in prices else F.col(c) for c in bars.columns])


def klines(
    bars: DataFrame,
    codes: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    frequency: str = DAILY,
    adjust_flag: str = ADJUST_NONE,
    factors: DataFrame | None = None,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """The K-line contract over daily bars: range, adjustment, resampling, previous close, projection."""
    if frequency not in (DAILY, WEEKLY, MONTHLY):
        raise ValueError("frequency must be d, w or m")
    if adjust_flag not in (ADJUST_FORWARD, ADJUST_BACKWARD, ADJUST_NONE):
        raise ValueError("adjust_flag must be 1, 2 or 3")
    chosen = bars
    if codes is not None:
        chosen = chosen.where(F.col("code").isin(list(codes)))
    if start is not None:
        chosen = chosen.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        chosen = chosen.where(F.col("date") <= F.lit(end).cast("date"))
    if adjust_flag != ADJUST_NONE:
        if factors is None:
            raise ValueError("adjusted prices need the factor table")
        chosen = adjust(chosen, factors, adjust_flag)
    if frequency != DAILY:
        chosen = resample(chosen, frequency)
    full = (
        with_preclose(chosen)
        .withColumn("adjustflag", F.lit(adjust_flag))
        .withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    )
    return project_existing(full, fields, KLINE_PREFERRED)
