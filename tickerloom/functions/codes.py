"""Instrument codes and exchanges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exchange_code(code: Column) -> Column:
    """``sh``/``sz``/``bj`` + digits, from any spelling of the code."""
    value = F.trim(F.replace(F.lower(code), F.lit("."), F.lit("")))
    return (
        F.when(value.rlike("^(sh|sz|bj)"), value)
        .when(value.rlike("^[569]"), F.concat(F.lit("sh"), value))
        .when(value.rlike("^[48]"), F.concat(F.lit("bj"), value))
        .otherwise(F.concat(F.lit("sz"), value))
    )


def plain_code(code: Column) -> Column:
    return F.substring(exchange_code(code), 3, 1 << 20)


def dotted_code(code: Column) -> Column:
    """``sh.``/``sz.`` prefix by first digit; anything else is left alone."""
    return (
        F.when(code.rlike("^6"), F.concat(F.lit("sh."), code))
        .when(code.rlike("^[03]"), F.concat(F.lit("sz."), code))
        .otherwise(code)
    )
