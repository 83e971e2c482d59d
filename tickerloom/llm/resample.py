"""Importance resampling towards a target: hashed word counts, exact weights by bit planes, Gumbel top-k.

Runs of words are hashed into buckets; a bucket's gain is the rounded-down log ratio of its smoothed shares in target and
source. A document's weight is the mean gain of its features. The sum is taken by bits: bit i of its bucket counts is one plane of
as many bits as there are buckets, bit j of the gains (two's complement, whose top bit counts negatively) another, and the sum is that of
``2 ** (i + j)`` times the number of bits in both. All of it is integer arithmetic, so the order of rows and tasks has no effect.

Only the gains (one number per bucket) and the counts per score reach the driver or one task; neither grows with the rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import bound_batches, small_batches
from tickerloom.session import materialize

BUCKETS = 10_000
SCALE = 1000
SEED = 2024
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
PERCENT = 10
_PIECE = 1 << 20
_KNOWN_WORDS = 1 << 17
_SALTS = 64

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z and turns every byte outside of words into a blank.
TABLE = bytes(b if b in _WORD else 0x20 for b in bytes(range(256)).lower())


class Buckets(dict):
    """The bucket of a feature, remembered for a bounded number of them."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(text: bytes, grams: int) -> Iterator[tuple[int, list[bytes]]]:
    """``(number of words, features)`` per piece of a text; a run of words lies in the piece where it ends."""
    raw, at, before = text.translate(TABLE), 0, []
    while at < len(raw):
        end = raw.find(b" ", at + _PIECE)
        end = len(raw) if end < 0 else end
        words = raw[at:end].split()
        found = list(words)
        line = before + words
        for n in range(2, grams + 1):
            first = max(0, len(before) - n + 1)
            found += [b" ".join(line[i : i + n]) for i in range(first, len(line) - n + 1)]
        before = line[-(grams - 1) :] if grams > 1 else []
        yield len(words), found
        at = end


def _bucket_counts(batches, buckets: int, grams: int):
    """Counts per bucket of one partition."""
    total, known = np.zeros(buckets, np.int64), Buckets(buckets)
    for batch in small_batches(batches):
        for text in batch.column(0).to_pylist():
            for _, found in features((text or "").encode(), grams):
                total += np.bincount(np.fromiter(map(known.__getitem__, found), np.int64, len(found)), minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, grams: int = 1) -> np.ndarray:
    """Features per bucket over all rows: at most ``buckets`` numbers."""
    bare = bound_batches(docs).select(F.col(text).alias("_text"))
    rows = bare.mapInArrow(lambda b: _bucket_counts(b, buckets, grams), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded-down, scaled log ratio of the buckets' smoothed shares in target and source."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = ((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of zeros and ones as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    wide = np.zeros((len(bits), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Bit planes of signed gains, and what a bit of each plane is worth."""
    width = max(int(gain.max(initial=0)).bit_length(), int((-gain - 1).max(initial=0)).bit_length())
    worth = [1 << j for j in range(width)] + [-(1 << width)]
    return _packed(np.stack([(gain >> j) & 1 for j in range(width + 1)]).astype(np.uint8)), worth


def plane_sums(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, rows: int, buckets: int, planes: np.ndarray, worth: list[int]) -> np.ndarray:
    """Sum of gains per document from its distinct buckets and their counts."""
    total = np.zeros(rows, np.int64)
    for i in range(int(count.max(initial=0)).bit_length()):
        has = ((count >> i) & 1).astype(bool)
        docs, place = np.unique(row[has], return_inverse=True)
        bits = np.zeros((len(docs), buckets), np.uint8)
        bits[place, bucket[has]] = 1
        plane = _packed(bits)
        for gain_plane, value in zip(planes, worth):
            total[docs] += np.bitwise_count(plane & gain_plane).sum(axis=1, dtype=np.int64) * (value << i)
    return total


def _weighed(batches, gain: np.ndarray, grams: int):
    """Per document: words, features and the rounded-down mean gain of its features."""
    known, (planes, worth) = Buckets(len(gain)), gain_planes(gain)
    for batch in small_batches(batches):
        words, keys, counts = np.zeros(batch.num_rows, np.int64), [], []
        for d, text in enumerate(batch.column(1).to_pylist()):
            dense = np.zeros(0, np.int64)
            for n, found in features((text or "").encode(), grams):
                words[d] += n
                seen = np.bincount(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
                dense, seen = (dense, seen) if len(dense) >= len(seen) else (seen, dense)
                dense[: len(seen)] += seen
            used = np.flatnonzero(dense)
            keys.append(used)
            counts.append(dense[used])
        row = np.repeat(np.arange(batch.num_rows), list(map(len, keys)))
        count = np.concatenate([np.zeros(0, np.int64), *counts])
        total = plane_sums(row, np.concatenate([np.zeros(0, np.int64), *keys]), count, batch.num_rows, len(gain), planes, worth)
        size = np.bincount(row, count, batch.num_rows).astype(np.int64)
        weight = np.where(size > 0, total // np.maximum(size, 1), 0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(size), pa.array(weight)], ["_key", "_words", "_features", "_weight"])


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, grams: int = 1, seed: int = SEED,
) -> DataFrame:
    """``(key, n_words, n_features, weight, score, rank)``, all long but the key, for every row of ``docs``.

    Of the rows with ``least_words`` words ``percent`` in a hundred (rounded down) are drawn: those with the highest ``score``, which is the
    weight plus Gumbel noise from a hash of ``seed`` and the key; ``rank`` counts them from 1 and is null elsewhere. Ties go to the smaller key,
    a null key before all others (its hash is that of no key); rows with equal key and score are ranked in any order. A null text has no words and weight 0. Equal
    keys are rows of their own. An empty target smooths to equal shares; an empty table of documents gives no rows. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, text, buckets, grams), bucket_counts(target, target_text, buckets, grams))
    bare = bound_batches(docs).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = T.StructType().add("_key", docs.schema[key].dataType).add("_words", "long").add("_features", "long").add("_weight", "long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_key").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((draw + 0.5) / F.lit(4294967296.0))))
    weighed = bare.mapInArrow(lambda b: _weighed(b, gain, grams), schema)
    # the salt parts rows of one key; it is stored, so a recomputed task has the same
    scored = materialize(weighed.withColumns({"_score": F.col("_weight") + noise, "_salt": F.monotonically_increasing_id() % _SALTS}), "scored")

    able = scored.where(F.col("_words") >= least_words)
    # scores are whole numbers between the least gain less 3,100 and the greatest plus 22,200: some 50,000 rows at most
    every = Window.orderBy(F.desc("_score")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = able.groupBy("_score").agg(F.count(F.lit(1)).alias("_n"))
    starts = materialize(sizes.select("_score", F.coalesce(F.sum("_n").over(every), F.lit(0)).alias("_start"), "_n"), "starts")
    drawn = percent * starts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0] // 100
    placed = scored.join(F.broadcast(starts.drop("_n")), "_score", "left")
    near = (F.col("_words") >= least_words) & (F.col("_start") < drawn)
    first = placed.where(near)
    same = ["_score", "_key", "_salt"]
    before = Window.partitionBy("_score").orderBy("_key", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = first.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).select(*same, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = first.withColumn("_place", F.row_number().over(Window.partitionBy(*same).orderBy("_weight")))
    both = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in same]
    ranked = inside.alias("a").join(cells.alias("b"), both).select("a.*", (F.col("_start") + F.col("_before") + F.col("_place")).alias("_rank"))
    ranked = ranked.withColumn("_rank", F.when(F.col("_rank") <= drawn, F.col("_rank")))
    rest = placed.where(~F.coalesce(near, F.lit(False))).withColumn("_rank", F.lit(None).cast("long"))
    return ranked.drop("_place").unionByName(rest).select(
        F.col("_key").alias(key), F.col("_words").alias("n_words"), F.col("_features").alias("n_features"), F.col("_weight").alias("weight"), F.col("_score").alias("score"),
        F.col("_rank").alias("rank"),
    )
