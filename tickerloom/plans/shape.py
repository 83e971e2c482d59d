"""Small helpers that give query results a stable, comparable form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column, so that the order of summation does not show."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), special.get(f.name, digits)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def iso_dates(df: DataFrame) -> DataFrame:
    """Dates as ``YYYY-MM-DD`` text, timestamps with seconds."""
    formats = {T.DateType: "yyyy-MM-dd", T.TimestampType: "yyyy-MM-dd HH:mm:ss", T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss"}
    return df.select(
        *[
            F.date_format(F.col(f"`{f.name}`"), formats[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in formats
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def final(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    return rounded(iso_dates(df), digits, **special)
