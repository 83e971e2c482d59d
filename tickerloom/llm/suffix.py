"""Removal of long repeated byte strings with a partitioned suffix array.

Every byte covered by a ``length``-byte string that also starts elsewhere goes. Sorting all suffixes would shuffle
the text many times over, so only suffixes that can matter are sorted, and none that matters is left out:

1. *Sync points.* Of the hashes of all 32-byte grams in a ``length``-byte string the smallest marks a sync point. It
   depends on the string alone, so equal strings hold sync points at equal places. About one byte in 85 is one.
2. *Grams seen twice.* Only sync points whose gram occurs at least twice in the table stay. Equal texts count as one
   text with a multiplicity; a text that occurs twice goes whole.
3. *Suffix array.* The suffixes from those points are range-partitioned by their leading bytes with sampled
   splitters and sorted in each partition by multikey quicksort over 8-byte tokens, and so are the reversed
   prefixes that end there. Common-prefix lengths of neighbours then give, for each offset of a string around the
   point, which strings are equal: equal on the right side and equal on the left side.
4. *Across boundaries.* A string can have its only copy in another partition only if every suffix from it to an end of
   its partition begins alike. One digest of each such string is shuffled and compared.

A gram that a third of all rows share is spread over partitions by what follows it, and points whose surroundings are equal
on both sides by a hash of text and place; they meet as strings at the ends of their partitions do (4.). No pairs
are formed, and a task returns at most one interval per sync point. Texts without a repeated gram, and later those that lose nothing,
are told by bit tables of fixed size and not shuffled.
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import BitTable, bit_segments, bound_batches, released, shuffle_partitions, small_batches, spread_join
from tickerloom.session import discard, materialize

LENGTH = 200
GRAM = 32
#: Suffixes that one partition should hold.
BUCKET = 40_000
#: Bytes of a text that are hashed at once, and points that leave a task at once.
BLOCK = 1 << 16
POINTS_AT_ONCE = 4096
#: Bits of the tables by which texts that a join can't need are left out of its shuffle: 8 MB each.
TABLE_BITS = 26
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM``-byte gram, by doubling."""
    h, span = _BYTE[data], 1
    with np.errstate(over="ignore"):
        while span < GRAM:
            h = h[:-span] * np.uint64((0xD6E8FEB86659FD93 * (2 * span + 1)) & (2**64 - 1)) + h[span:]
            h ^= h >> np.uint64(29)
            span *= 2
        h = h * _ODD
    return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, window: int, pick) -> np.ndarray:
    span = 1
    while 2 * span <= window:
        values, span = pick(values[:-span], values[span:]), 2 * span
    return pick(values[: len(values) - (window - span)], values[window - span :]) if window > span else values


def sync_points(text: bytes, length: int = LENGTH, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, gram hashes)`` of the grams that are smallest in some ``length``-byte string of ``text``.

    The text is read in blocks, each with the surroundings that decide on its points, so memory follows the points.
    """
    window, last = length - GRAM + 1, len(text) - GRAM  # the last place of a gram
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    edge = np.zeros(window - 1, np.uint64)  # below every hash
    for start in range(0, last + 1 if len(text) >= length else 0, block):
        end = min(start + block, last + 1)
        low, high = max(0, start - window + 1), min(last + 1, end + window - 1)
        h = gram_hashes(np.frombuffer(text, np.uint8, high - low + GRAM - 1, low))
        least = _sliding(h, window, np.minimum)
        best = _sliding(np.concatenate([edge, least, edge]), window, np.maximum)
        at = np.nonzero(best[start - low : end - low] == h[start - low : end - low])[0] + (start - low)
        places.append(at + low)
        hashes.append(h[at])
    return np.concatenate(places), np.concatenate(hashes)


def contexts(text: bytes, grams: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """``(position, other positions, left, right)`` per distinct surrounding of the sync points whose gram is in ``grams``.

    ``left`` is reversed. Places of one text that look alike over the whole reach are one row, so text that repeats
    itself costs no more than text that does not.
    """
    at, h = sync_points(text, length)
    at = at[np.isin(h, grams)]
    reach = length - GRAM
    places: dict[tuple[bytes, bytes], list[int]] = {}
    for p in at.tolist():
        places.setdefault((text[max(0, p - reach) : p][::-1], text[p : p + length]), []).append(p)
    for (left, right), found in places.items():
        yield found[0], struct.pack(f"<{len(found) - 1}i", *found[1:]), left, right


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of equally long byte rows: multikey quicksort over their big-endian 8-byte tokens.

    All runs that are equal so far are split by the next token together; rows that stand alone are done.
    """
    n, width = rows.shape
    tokens = np.zeros((n, -(-width // 8) * 8), np.uint8)
    tokens[:, :width] = rows
    tokens = tokens.view(">u8").astype(np.uint64)
    order, run, active = np.arange(n), np.zeros(n, np.int64), np.arange(n)
    for depth in range(tokens.shape[1]):
        if not len(active):
            break
        token = tokens[order[active], depth]
        inner = np.lexsort((token, run[active]))
        order[active] = order[active][inner]
        token, of = token[inner], run[active]
        new = np.ones(len(active), bool)
        new[1:] = (of[1:] != of[:-1]) | (token[1:] != token[:-1])
        starts = np.nonzero(new)[0]
        run[active] = active[starts[np.cumsum(new) - 1]]  # a run is named by its first place
        size = np.diff(np.append(starts, len(active)))
        active = active[np.repeat(size > 1, size)]
    return order


def _matrix(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column as rows of ``width`` bytes, short ones padded with zeros, and their lengths."""
    n = len(values)
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, np.int32, n + 1, values.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
    lengths = np.diff(at)
    out = np.zeros((n, width), np.uint8)
    if at[-1] > at[0]:
        out[np.arange(width) < lengths[:, None]] = np.frombuffer(data, np.uint8, at[-1] - at[0], at[0])
    return out, lengths


def _common(rows: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common-prefix length of each row, in order, with the one before it."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = rows[order[1:]] != rows[order[:-1]]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[1:] = np.minimum(first, np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    return out


def _best(common: np.ndarray, order: np.ndarray) -> np.ndarray:
    best = np.maximum(common, np.append(common[1:], 0))
    out = np.empty_like(best)
    out[order] = best
    return out


def repeats(lmat: np.ndarray, llen: np.ndarray, rmat: np.ndarray, rlen: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Smallest and largest matched offset per row (-1 if none), and ``(offset, rows)`` of the strings at the ends.

    Offset d stands for the string from d bytes before the point. Two rows match there if they agree on
    ``length - d`` bytes to the right and on d bytes to the left. A string is at an end if all suffixes between it and the
    first or last one begin like it, so that a suffix of the next partition may, too; equal ones count once.
    """
    n, reach = len(rmat), length - GRAM
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    rorder, lorder = multikey_order(rmat), multikey_order(lmat)
    rcommon, lcommon = _common(rmat, rlen, rorder), _common(lmat, llen, lorder)
    rbest, lbest = _best(rcommon, rorder), _best(lcommon, lorder)
    rplace, lplace = np.empty(n, np.int64), np.empty(n, np.int64)
    rplace[rorder], lplace[lorder] = np.arange(n), np.arange(n)
    ends = []
    for d in range(reach + 1):
        breaks = np.nonzero(rcommon[1:] < length - d)[0] + 1
        at_end = np.concatenate([rorder[: breaks[0]], rorder[breaks[-1] :]]) if len(breaks) else rorder
        at_end = at_end[(rlen[at_end] >= length - d) & (llen[at_end] >= d)]
        run = np.cumsum(lcommon < d)[lplace[at_end]] * 2 + (rplace[at_end] >= breaks[-1] if len(breaks) else 0)
        if len(at_end):
            ends.append((d, at_end[np.unique(run, return_index=True)[1]]))
        rows = np.nonzero((rbest >= length - d) & (lbest >= d))[0] if d else np.nonzero(rbest >= length)[0]
        if len(rows) < 2:
            continue
        key = np.cumsum(rcommon < length - d)[rplace[rows]] * n + np.cumsum(lcommon < d)[lplace[rows]]
        inner = np.argsort(key)
        same = key[inner][1:] == key[inner][:-1]
        met = np.zeros(len(rows), bool)
        met[1:] |= same
        met[:-1] |= same
        hit = rows[inner[met]]
        high[hit] = d
        low[hit] = np.where(low[hit] < 0, d, low[hit])
    return low, high, ends


def _grams(batches, length):
    for batch in small_batches(batches):
        out = []
        for text in batch.column(3).to_pylist():
            h, n = np.unique(sync_points(text.encode(), length)[1], return_counts=True)
            out.append(np.concatenate([h, h[n > 1]]).view(np.int64))
        flat = np.concatenate(out) if out else np.zeros(0, np.int64)
        ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["_tid", "_n", "_id", "_grams"])


_POINT = "_tid long, _n int, _at int, _more binary, _left binary, _right binary"
_DIGEST = np.dtype([("h", "<u8"), ("h2", "<u8"), ("tid", "<i8"), ("n", "<i4"), ("at", "<i4"), ("d", "<i4")])
_SPAN = "_tid long, _n int, _from int, _to int"


def _points(batches, length):
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())

    def rows():
        for batch in small_batches(batches, 16):
            for tid, n, text, some in zip(*(c.to_pylist() for c in batch.columns)):
                known = np.array(some, np.int64).view(np.uint64)
                for row in contexts(text.encode(), known, length):
                    yield (tid, n, *row)

    left = rows()
    while out := list(itertools.islice(left, POINTS_AT_ONCE)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["_tid", "_n", "_at", "_more", "_left", "_right"])


def _sorted_bucket(batches, length: int, parts: int):
    """One range partition: spans of matched strings, and digests of the strings at its ends, by part."""
    given = [b for b in batches if b.num_rows]
    if not given:
        return
    rows = pa.Table.from_batches(given)
    places = np.rec.fromarrays([rows.column(c).to_numpy() for c in ("_tid", "_n", "_at")])
    once = np.unique(places, return_index=True)[1]
    if len(once) < len(places):
        rows = rows.take(pa.array(np.sort(once)))
    tid, n, at = (rows.column(c).to_numpy() for c in ("_tid", "_n", "_at"))
    lmat, llen = _matrix(rows.column("_left").combine_chunks(), length - GRAM)
    rmat, rlen = _matrix(rows.column("_right").combine_chunks(), length)
    more = rows.column("_more").combine_chunks()
    del rows, given, places
    low, high, ends = repeats(lmat, llen, rmat, rlen, length)
    first, last = np.maximum(length - rlen, 0), np.minimum(llen, length - GRAM)  # offsets that fit into the text
    others = np.diff(np.frombuffer(more.buffers()[1], np.int32, len(more) + 1, more.offset * 4)) // 4
    again = (others > 0) & (first <= last)
    low[again], high[again] = first[again], last[again]

    own = np.nonzero(low >= 0)[0]
    of = np.concatenate([own, np.repeat(np.nonzero(again)[0], others[again])])
    place = np.concatenate([at[own], np.frombuffer(b"".join(more.filter(pa.array(again)).to_pylist()), "<i4")])
    cols = np.column_stack([tid[of], n[of], place - high[of], place - low[of] + length]).astype(np.int64)

    digests = np.empty(sum(len(some) for _, some in ends), _DIGEST)
    done = 0
    for d, some in ends:
        block = digests[done : done + len(some)]
        done += len(some)
        whole = np.concatenate([lmat[some, :d][:, ::-1], rmat[some, : length - d]], axis=1)
        # the offset is part of it, as one string is open at several points of its own text
        both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(row, d) for row in whole), ">u8").reshape(-1, 2)
        block["h2"], block["h"], block["d"] = both[:, 0], both[:, 1], d
        block["tid"], block["n"], block["at"] = tid[some], n[some], at[some]
    del lmat, rmat, ends
    part = (digests["h"] % np.uint64(parts)).astype(np.int64)
    digests = digests[np.argsort(part, kind="stable")]
    used, sizes = np.unique(part, return_counts=True)
    edges = np.cumsum([0, *sizes])
    blobs = [digests[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
    none = lambda k: pa.nulls(k, pa.int64())
    ints = [pa.concat_arrays([pa.array(np.ascontiguousarray(cols[:, j])), none(len(used))]).cast(t) for j, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))]
    yield pa.RecordBatch.from_arrays(
        [*ints, pa.array([None] * len(cols) + used.tolist(), pa.int32()), pa.array([None] * len(cols) + blobs, pa.binary())],
        ["_tid", "_n", "_from", "_to", "_part", "_open"],
    )


def _across(rows: pa.Table, length: int) -> pa.Table:
    """Strings that stand at the ends of at least two partitions. Only hashes are sorted, the rest is read where they met."""
    blobs = [np.frombuffer(b.as_buffer(), _DIGEST) for b in rows.column("_open")]
    h, h2 = (np.concatenate([b[name] for b in blobs]) for name in ("h", "h2"))
    order = np.lexsort((h2, h))
    same = np.ones(len(order) - 1, bool)
    for hashes in (h, h2):
        same &= hashes[order[1:]] == hashes[order[:-1]]
    met = np.sort(order[np.append(same, False) | np.insert(same, 0, False)])
    del h, h2, order
    first = np.cumsum([0, *map(len, blobs)])
    cuts = np.searchsorted(met, first)
    found = np.concatenate([b[met[lo:hi] - at] for b, at, lo, hi in zip(blobs, first, cuts[:-1], cuts[1:])])
    spans = np.unique(np.rec.fromarrays([found["tid"], found["n"], found["at"] - found["d"]], names="tid,n,start"))
    columns = [pa.array(np.ascontiguousarray(c)) for c in (spans["tid"], spans["n"], spans["start"], spans["start"] + np.int32(length))]
    return pa.table(columns, ["_tid", "_n", "_from", "_to"])


def _may_hold(segments: dict[int, bytes], bits: int):
    """A column that tells whether a text's key may be in a bit table; no text whose key is in it is left out."""

    def held(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = BitTable(segments, bits)
        for some in keys:
            yield pd.Series(table.holds(some.to_numpy().view(np.uint64)))

    return F.pandas_udf(held, T.BooleanType())


def spans(docs: DataFrame, key: str, text: str, length: int = LENGTH, bucket: int = BUCKET, bits: int = TABLE_BITS) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its text key, and per distinct text that loses bytes its intervals (or that it goes whole).

    Texts are told apart by two hashes of 64 and 32 bits (``_tid``, ``_n``).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({"_tid": F.xxhash64(body), "_n": F.hash(body), "_id": F.coalesce(F.col(key).cast("long"), F.lit(0)), "_body": body})
    bare = keyed.select("_tid", "_n", "_id", "_body")
    long_ = bare.where(F.octet_length("_body") >= length)
    grams = long_.mapInArrow(lambda b: released(_grams(b, length)), "_tid long, _n int, _id long, _grams array<long>")
    texts = materialize(
        grams.groupBy("_tid", "_n").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_copies"), F.first("_grams").alias("_grams")), "texts"
    )
    each = texts.select("_tid", "_n", F.when(F.col("_copies") > 1, 2).otherwise(1).alias("_w"), F.explode("_grams").alias("_g"))
    twice = materialize(each.groupBy("_g").agg(F.sum("_w").alias("_seen")).where("_seen > 1"), "grams")
    wanted = spread_join(each.select("_tid", "_n", "_g"), twice, ["_g"], "_seen", F.struct("_tid", "_n"))
    wanted = wanted.groupBy("_tid", "_n").agg(F.collect_set("_g").alias("_grams")).join(texts.select("_tid", "_n", "_id"), ["_tid", "_n"])
    wanted = materialize(wanted, "wanted")
    may = _may_hold(bit_segments(wanted.select("_tid"), bits), bits)
    chosen = bare.where(may("_tid")).join(wanted, ["_tid", "_n", "_id"]).select("_tid", "_n", "_body", "_grams")
    points = materialize(chosen.mapInArrow(lambda b: released(_points(b, length)), _POINT), "suffixes")

    n = points.count()
    parts = max(shuffle_partitions(docs), -(-n // bucket))
    # suffixes that are equal meet in one partition or at the ends of neighbours, however what follows them in the order parts them
    dealt = points.repartitionByRange(parts, "_right", "_left", F.xxhash64("_tid", "_n", "_at"))
    found = materialize(dealt.mapInArrow(lambda b: released(_sorted_bucket(b, length, parts)), f"{_SPAN}, _part int, _open binary"), "spans")
    discard(points)
    met = found.where("_part is not null").select("_part", "_open").groupBy("_part").applyInArrow(lambda r: _across(r, length), _SPAN)
    rows = found.where("_part is null").select("_tid", "_n", "_from", "_to").unionByName(met)
    per = rows.groupBy("_tid", "_n").agg(F.collect_set(F.struct("_from", "_to")).alias("_spans"))
    whole = texts.select("_tid", "_n", (F.col("_copies") > 1).alias("_whole"))
    return keyed, materialize(whole.join(per, ["_tid", "_n"], "left").where("_whole or _spans is not null"), "gone")


def merged_spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union; runs that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, bucket: int = BUCKET, bits: int = TABLE_BITS) -> DataFrame:
    """``docs`` plus ``_kept binary``, ``_n_removed long`` and ``_n_spans long``.

    Null texts count as empty; texts shorter than ``length`` bytes are kept. Strings never cross rows. Repeated rows and
    equal keys are told apart by their texts alone. An empty table gives no rows; all columns of ``docs`` stay.
    """
    keyed, gone = spans(bound_batches(docs), key, text, length, bucket, bits)
    may = _may_hold(bit_segments(gone.select("_tid"), bits), bits)
    flagged = keyed.drop("_id").withColumn("_may", may("_tid"))
    names, extra = docs.columns, T.StructType().add("_kept", "binary").add("_n_removed", "long").add("_n_spans", "long")
    joined = flagged.where("_may").join(gone, ["_tid", "_n"], "left").select(*names, "_body", "_whole", "_spans")

    def cut(batches):
        at = len(names)
        for batch in small_batches(batches, 64):
            kept, removed, runs = [], [], []
            for body, whole, found in zip(*(batch.column(i).to_pylist() for i in (at, at + 1, at + 2))):
                data = body.encode()
                out = [(0, len(data))] if whole else merged_spans([(s["_from"], s["_to"]) for s in found or ()])
                bounds = [0, *(x for run in out for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
                removed.append(len(data) - len(kept[-1]))
                runs.append(len(out))
            new = [pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *new], [*names, *extra.names])

    schema = T.StructType([*docs.schema.fields, *extra.fields])
    as_is = flagged.where("not _may").select(*names, F.encode("_body", "UTF-8").alias("_kept"), F.lit(0).cast("long").alias("_n_removed"), F.lit(0).cast("long").alias("_n_spans"))
    return joined.mapInArrow(lambda b: released(cut(b)), schema).union(as_is)
