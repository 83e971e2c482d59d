"""Exact global positions without one task seeing all rows.

Rows are ordered by an md5 hex string. Its first digits split every group into evenly filled
buckets; bucket counts are aggregated first and summed up, and each row adds its position inside
its own bucket. However large a label is, no task sorts more than one bucket of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_DIGITS = 4


def seeded(seed: int | Column, row_id: str) -> Column:
    """The random order key of a row: md5 of ``seed:id``, stable under any partitioning."""
    seed_text = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.md5(F.concat(seed_text, F.lit(":"), F.col(row_id).cast("string")))


def with_rank(
    df: DataFrame, order: Column, row_id: str, name: str, keys: Sequence[str] = (), at_most: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row by (``order``, ``row_id``) within ``keys``.

    ``keys`` must have few values (score labels here): the offsets hold at most 65,536 rows per key,
    which bounds their broadcast. With ``at_most`` only the first positions are returned, and rows of
    later buckets leave before the shuffle.
    """
    placed = df.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    group = [*keys, "_bucket"]
    before = F.coalesce(
        F.sum("_n").over(
            W.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    offsets = placed.groupBy(*group).agg(F.count("*").alias("_n")).withColumn("_before", before).drop("_n")
    if at_most is not None:
        offsets = offsets.where(F.col("_before") < at_most)
    inside = F.row_number().over(W.partitionBy(*group).orderBy("_order", row_id))
    ranked = (
        placed.join(F.broadcast(offsets), group)
        .withColumn(name, F.col("_before") + inside)
        .drop("_order", "_bucket", "_before")
    )
    return ranked if at_most is None else ranked.where(F.col(name) <= at_most)
