"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

Everything is built-in column functions. Word hashes are combined into shingle hashes, one per shingle. The top
bits of a hash name its bin, so sorting the hashes, with one sentinel per bin, leaves each bin's minimum at its first
place. An empty bin copies from another one: the first that is filled in a sequence of bins drawn from the empty
bin's number alone, so that documents with the same empty bins copy alike. Of every minimum the lowest ``BITS`` bits
are kept, packed into longs. Unequal minima agree in those by chance with 2^-BITS, which the likeness corrects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
BINS = 256
BITS = 4
#: Bins tried at random before the empty bin takes the filled one of least hash.
TRIES = 24
_BIN_BITS = 8
_VALUE_BITS = 63 - _BIN_BITS
_PER_LONG = 64 // BITS
_SPACE = r"[\x20\x09-\x0D]+"
BUCKETS = 256


def _drawn(bin_: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(bin_, F.lit(turn)), F.lit(BINS)).cast("int")


def with_fingerprint(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """``df`` plus ``out array<long>``: the packed fingerprint of the shingles of ``words`` words of column ``text``.

    Texts of fewer words have one shingle of all their words. A text without words, or null, has null. Columns are
    added step by step, so that each array is computed once.
    """
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    step = df.withColumn("_w", F.transform(F.filter(F.split(lowered, _SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)))
    n = F.size("_w")
    many = F.transform(
        F.sequence(F.lit(1), n - (words - 1)), lambda i: F.xxhash64(*[F.element_at("_w", (i + k).cast("int")) for k in range(words)])
    )
    one = F.array(F.aggregate("_w", F.lit(0).cast("long"), lambda h, w: F.xxhash64(h, w)))
    hashes = F.when(n >= words, many).when(n > 0, one)
    low = (1 << _VALUE_BITS) - 1
    sentinels = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("long"), _VALUE_BITS) + F.lit(low))
    positive = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 1))
    step = step.withColumn("_s", F.sort_array(F.concat(positive, sentinels)))
    # the first of each bin; both arguments use the sorted array, so it is not computed in place
    shifted = F.concat(F.array(F.lit(-1).cast("long")), F.slice("_s", 1, F.size("_s") - 1))
    firsts = F.array_compact(
        F.zip_with("_s", shifted, lambda x, y: F.when((y < 0) | (F.shiftright(x, _VALUE_BITS) != F.shiftright(y, _VALUE_BITS)), x.bitwiseAND(F.lit(low))))
    )
    step = step.withColumn("_m", firsts)
    filled = lambda b: F.element_at("_m", b + 1)
    found = lambda b: F.when(filled(b) != low, filled(b))
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    rest = F.filter(bins, lambda b: filled(b) != low)
    step = step.withColumn("_f", F.when(F.size("_m") == BINS, rest))
    fallback = lambda b: filled(F.array_min(F.transform("_f", lambda j: F.struct(F.xxhash64(b, j).alias("h"), j.alias("j"))))["j"])
    # what is copied is hashed with its new place, so that copies of one minimum don't agree by chance together
    copied = lambda b: F.xxhash64(F.coalesce(*[found(_drawn(b, t)) for t in range(TRIES)], fallback(b)), b)
    dense = F.transform(bins, lambda b: F.coalesce(found(b), copied(b)))
    step = step.withColumn("_d", F.when(F.size("_f") > 0, dense))
    packed = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)),
        lambda k: F.aggregate(
            F.slice("_d", k * _PER_LONG + 1, _PER_LONG), F.lit(0).cast("long"), lambda acc, v: F.shiftleft(acc, BITS) + v.bitwiseAND(F.lit((1 << BITS) - 1))
        ),
    )
    return step.withColumn(out, F.when(F.col("_d").isNotNull(), packed)).drop("_w", "_s", "_m", "_f", "_d")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, from 0 to 1; two without words are alike, one alone is not.

    Equal groups of ``BITS`` bits are counted on the packed longs, and chance agreement is taken out.
    """
    ones = int("0" * (BITS - 1) + "1", 2)
    for _ in range(_PER_LONG - 1):
        ones = (ones << BITS) | 1
    ones -= 1 << 64 if ones >> 63 else 0

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift in (1, 2):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(ones)))

    agree = (BINS - F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, v: s + v)) / float(BINS)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(estimate)


def hex_string(fingerprint: Column) -> Column:
    """The packed longs as lowercase hex; of a text without words, all zeros."""
    digits = F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.hex(v), 16, "0")), "")
    return F.coalesce(F.lower(digits), F.lit("0" * (BINS * BITS // 4)))


def with_guests(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` (``key``, ``text``) dealt to ``_bucket`` by ranges of descending key, for a look at the following row.

    Bounds are approximate quantiles of the keys, at most ``buckets`` numbers; null keys come last. Every bucket also
    gets, with ``_guest`` 1, the first row of the bucket that follows it; the last bucket that of the first.
    """
    bounds = rows.where("key is not null").agg(F.percentile_approx("key", [i / buckets for i in range(1, buckets)], 10_000)).first()[0]
    bounds = sorted(set(bounds or []))
    inside = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("key"))) if bounds else F.lit(0)
    dealt = rows.withColumn("_bucket", F.when(F.col("key").isNull(), 0).otherwise(inside + 1).cast("int"))
    tops = dealt.groupBy("_bucket").agg(F.max("key").alias("_top"))
    used = sorted((r[0] for r in tops.select("_bucket").collect()), reverse=True)  # at most ``buckets`` + 1 numbers
    before = {b: used[i - 1] for i, b in enumerate(used)}  # of the first bucket: the last one
    to = F.element_at(F.array(*[F.lit(before.get(b, 0)) for b in range(max(used, default=0) + 1)]), F.col("_bucket") + 1)
    at_top = dealt.join(F.broadcast(tops.withColumnRenamed("_bucket", "_b")), (F.col("_bucket") == F.col("_b")) & F.col("key").eqNullSafe(F.col("_top")))
    heads = at_top.groupBy("_bucket").agg(F.min("text").alias("text"), F.max("key").alias("key"))
    guests = heads.select("key", "text", to.alias("_bucket"), F.lit(1).alias("_guest"))
    return dealt.withColumn("_guest", F.lit(0)).unionByName(guests)


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_chars``, ``edited_sha256``, both fingerprints, and their likenesses.

    The edited text ends in the beginning of the next document: its last third of code points is replaced by as
    many of the next one's first, or all. Null texts count as empty, null keys come last, rows of equal keys are ordered
    by text; a single row is its own next one. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = with_fingerprint(with_guests(rows), "text", "fp")
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col("key").desc_nulls_last(), "text")
    following = F.lead(F.struct("text", "fp")).over(order)
    chained = own.withColumn("_next", following).where("_guest = 0")
    chained = chained.select("key", "text", "fp", F.col("_next.text").alias("next_text"), F.col("_next.fp").alias("next_fp"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    chained = chained.select("key", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    both = with_fingerprint(chained, "edited", "edited_fp")
    return both.select(
        F.col("key").alias(key), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), hex_string(F.col("fp")).alias("fingerprint"),
        hex_string(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
