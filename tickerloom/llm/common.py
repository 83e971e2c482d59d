"""Helpers shared by the operators: row keys, ranks without a global sort, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.session import bound_batches, materialize  # noqa: F401 (the operators take both from here)

RANK_BUCKETS = 1024


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches, so that only few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def released(rows: Iterator) -> Iterator:
    """The same rows; after the last one, freed memory goes back to the system.

    A Python worker serves one task after another, and else keeps what the largest of them took while others need memory.
    """
    yield from rows
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, group: list[str], order: Column, tie: Column, rank: str, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Add ``rank``: the row's place from 0 within ``group``, gapless, without sorting a whole group in one task.

    ``order`` is an integer in ``[0, buckets)``; rows follow it, and ``tie`` within one bucket. Bucket sizes are
    summed first (at most ``buckets`` rows per group), then every bucket is numbered on its own. ``df`` is read
    twice, so it should be a stored table.
    """
    marked = df.withColumn("_bucket", order.cast("int"))
    sizes = marked.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(tie)
    placed = marked.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        placed.join(starts, [*group, "_bucket"])
        .withColumn(rank, (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_bucket", "_place", "_start")
    )


def spread_join(many: DataFrame, one: DataFrame, on: list[str], count: str, row: Column, parts: int = 256, how: str = "inner") -> DataFrame:
    """Join of ``many`` with a stored ``one`` (inner or left), which has one row per key and in ``count`` how many rows of ``many`` have it.

    A key with more than one of ``parts`` shares of all these rows is dealt over salts in proportion, by a hash of ``row``, and its row
    of ``one`` is repeated for them. There are fewer than ``parts`` such keys, so their list is broadcast. ``count`` is dropped.
    """
    total = one.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    hot = F.broadcast(one.where(F.col(count) * parts > F.lit(total)).select(*on, F.ceil(F.col(count) * parts / F.lit(max(1, total))).cast("int").alias("_salts")))
    salt = F.pmod(F.xxhash64(row), F.coalesce("_salts", F.lit(1))).cast("int")
    left = many.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    right = one.drop(count).join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


SEGMENT_BITS = 15


def bit_segments(hashes: DataFrame, bits: int) -> dict[int, bytes]:
    """A table of ``2 ** bits`` bits with those set that the 64-bit hashes of the one column name, in segments that have any.

    At most ``2 ** (bits - 15)`` segments of 4 KB reach the driver, whatever the number of rows; with 26 bits that is 8 MB.
    """

    def segment(rows: pa.Table) -> pa.Table:
        place = rows.column("_place").to_numpy()
        seen = np.zeros(1 << SEGMENT_BITS, np.uint8)
        seen[place & ((1 << SEGMENT_BITS) - 1)] = 1
        return pa.table({"segment": pa.array([int(place[0]) >> SEGMENT_BITS], pa.int32()), "bits": pa.array([np.packbits(seen, bitorder="little").tobytes()])})

    place = F.shiftrightunsigned(hashes.columns[0], 64 - bits).cast("int")
    places = hashes.select(place.alias("_place")).distinct().withColumn("_segment", F.shiftright("_place", SEGMENT_BITS))
    rows = places.groupBy("_segment").applyInArrow(segment, "segment int, bits binary").collect()
    return {r.segment: bytes(r.bits) for r in rows}


class BitTable:
    """The table of ``bit_segments`` in a task."""

    def __init__(self, segments: dict[int, bytes], bits: int):
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << (max(bits, SEGMENT_BITS) - 3), np.uint8)
        for s, part in segments.items():
            at = s << (SEGMENT_BITS - 3)
            self.table[at : at + len(part)] = np.frombuffer(part, np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the bit of each hash is set: always for those in the table, by chance for others."""
        place = hashes.astype(np.uint64, copy=False) >> self.shift
        return ((self.table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def hash_bucket(column: Column, buckets: int = RANK_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the smallest node reachable.

    Alternates the large-star and small-star steps: each points a node's neighbours at the smallest of them.
    Every round is two aggregates with map-side combine and two joins on the node, its edges are written to the
    shared folder, and rounds end when the edges no longer change. Edges never reach the driver.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, mark = _stored(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("_m").alias("v")).unionByName(
            joined.where("v <> _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        )
        now, after = _stored(small.distinct())
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    kept = materialize(edges, "edges")
    row = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return kept, tuple(row)
