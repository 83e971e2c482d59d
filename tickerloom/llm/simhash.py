"""SimHash fingerprints, and exact linking of fingerprints within a Hamming radius by tiles.

A fingerprint is 64 majority votes over the hashes of a text's word shingles. Distinct fingerprints are laid
into tiles by the population counts of their four 16-bit words, and compared tile against tile with numpy's
exclusive-or and bit counts. Two fingerprints differ in at least as many bits as their word counts differ in sum,
so a fingerprint visits only tiles within the radius, and inside a tile only the stretch of total counts within it.
No link is lost, and no pair is written: every tile returns one edge per member, to the smallest it is joined with.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import bound_batches, connected_components, small_batches
from tickerloom.session import materialize

SEED = 42
WORDS = 3
RADIUS = 3
SEGMENTS = 4
SEGMENT_BITS = 16
#: Fingerprints of one tile that are compared by one task, and visitors for each of them.
BLOCK = 4096
VISITORS = 8 * BLOCK
#: Cells of one numpy comparison.
CELLS = 1 << 21
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of ``text``: shingles of ``words`` words with repeats; no word (or null): zero."""
    tokens = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not tokens:
        return 0
    if len(tokens) < words:
        tokens, words = [b" ".join(tokens)], 1
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)))) if words > 1 else iter(tokens)
    votes, n = np.zeros(64, np.int64), 0
    while len(part := np.fromiter((digest(s, SEED) for s in itertools.islice(shingles, _HASHES_AT_ONCE)), np.uint64)):
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a (signed) long, for use beside other columns."""

    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(compute, T.LongType())(text)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``(key, fp)`` for every row, whole texts, null and empty ones included (zero)."""

    def compute(batches):
        for batch in small_batches(batches):
            got = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], ["key", "fp"])

    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("fp", T.LongType())])
    return bound_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(compute, schema)


def _word_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, SEGMENTS)).astype(np.int16)


class Tiling:
    """Which tiles a fingerprint lies in or visits. ``sizes`` holds the fingerprints per tile: at most 9^4 entries."""

    def __init__(self, sizes: dict[int, int], radius: int, block: int = BLOCK, visitors: int = VISITORS):
        self.radius, self.width = radius, 2
        self.side = SEGMENT_BITS // self.width + 1
        reach = math.ceil(radius / self.width)
        self.steps = np.array(list(itertools.product(range(-reach, reach + 1), repeat=SEGMENTS)), np.int16)
        self.scale = np.array([self.side**i for i in range(SEGMENTS)][::-1], np.int64)
        counts = np.zeros(self.side**SEGMENTS, np.int64)
        for tile, n in sizes.items():
            counts[tile] = n
        cube = counts.reshape((self.side,) * SEGMENTS)
        near = sum(  # an upper bound of visitors, own rows included
            np.pad(cube, reach)[tuple(slice(reach + s, reach + s + self.side) for s in step)]
            for step in self.steps if sum(max(0, (abs(int(s)) - 1) * self.width + 1) * (s != 0) for s in step) <= radius
        ).reshape(-1)
        self.own_cuts = np.maximum(1, -(-counts // block))
        self.visit_cuts = np.maximum(1, -(-near // visitors))

    def tile(self, fps: np.ndarray) -> np.ndarray:
        return (_word_counts(fps) // self.width) @ self.scale

    def visits(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and tiles: every tile that holds a count vector within the radius, the own one first in order."""
        counts = _word_counts(fps)
        box = counts // self.width
        up = (box[:, None, :] + self.steps) * self.width - counts[:, None, :]
        down = counts[:, None, :] - ((box[:, None, :] + self.steps + 1) * self.width - 1)
        cost = np.where(self.steps > 0, up, np.where(self.steps < 0, down, 0)).sum(axis=2)
        there = box[:, None, :] + self.steps
        inside = ((there >= 0) & (there < self.side)).all(axis=2)
        tiles = there.astype(np.int64) @ self.scale
        row, step = np.nonzero((cost <= self.radius) & inside & (tiles >= (box.astype(np.int64) @ self.scale)[:, None]))
        return row, tiles[row, step]


def _lot(fps: np.ndarray, salt: int) -> np.ndarray:
    mixed = (fps ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64)


def dealt(fps: np.ndarray, tiling: Tiling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(group, fp, own)``: a tile's own fingerprints in blocks of bounded size, its visitors in bounded parts."""
    groups, rows, owns = [], [], []

    def add(row, tile, own_cut, visit_cut, own):
        groups.append((tile << 40) | (own_cut << 20) | visit_cut)
        rows.append(row)
        owns.append(np.full(len(row), own))

    home = tiling.tile(fps)
    mine = _lot(fps, 0x51ED) % tiling.own_cuts[home]
    everyone = np.arange(len(fps))
    for cut in range(int(tiling.visit_cuts[home].max(initial=0))):
        of = everyone[cut < tiling.visit_cuts[home]]
        add(of, home[of], mine[of], np.full(len(of), cut), True)
    row, tile = tiling.visits(fps)
    part = _lot(fps[row], 0xA27B) % tiling.visit_cuts[tile]
    for cut in range(int(tiling.own_cuts[tile].max(initial=0))):
        of = np.nonzero(cut < tiling.own_cuts[tile])[0]
        add(row[of], tile[of], np.full(len(of), cut), part[of], False)
    return np.concatenate(groups), fps[np.concatenate(rows)], np.concatenate(owns)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give both ends of every link the smallest label; labels are positions and point at roots."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def tile_edges(own: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """One edge per fingerprint that is within ``radius`` of another, to the smallest of its local group."""
    nodes = np.unique(np.concatenate([own, visitors]))
    order = np.argsort(np.bitwise_count(nodes), kind="stable")
    total = np.bitwise_count(nodes)[order].astype(np.int64)
    place = np.empty(len(nodes), np.int64)
    place[order] = np.arange(len(nodes))
    ordered, label = nodes[order], np.arange(len(nodes))
    own = order[np.sort(place[np.searchsorted(nodes, np.unique(own))])]  # by population count
    step = max(1, CELLS // max(1, len(nodes)))
    for at in range(0, len(own), step):
        mine = own[at : at + step]
        ones = np.bitwise_count(nodes[mine]).astype(np.int64)
        lo, hi = np.searchsorted(total, ones[0] - radius, "left"), np.searchsorted(total, ones[-1] + radius, "right")
        close = np.bitwise_count(nodes[mine][:, None] ^ ordered[lo:hi][None, :]) <= radius
        i, j = np.nonzero(close)
        _join(label, mine[i], order[lo + j])
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK, visitors: int = VISITORS) -> DataFrame:
    """Edges ``(a, b)`` whose closure joins exactly the distinct ``fp`` that differ in at most ``radius`` bits.

    ``fps`` has a long column ``fp`` and is read twice.
    """
    distinct = materialize(fps.select("fp").distinct(), "distinct-fps")
    counts = [F.bit_count(F.shiftrightunsigned("fp", SEGMENT_BITS * i).bitwiseAND(F.lit(0xFFFF))) for i in range(SEGMENTS)]
    side = SEGMENT_BITS // 2 + 1
    tile = sum((F.floor(c / 2) * (side ** (SEGMENTS - 1 - i)) for i, c in enumerate(counts)), F.lit(0))
    sizes = {int(r[0]): r[1] for r in distinct.groupBy(tile.alias("tile")).count().collect()}  # at most 9^4 rows
    tiling = Tiling(sizes, radius, block, visitors)

    def deal(batches):
        for batch in small_batches(batches, 2048):
            got = dealt(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), tiling)
            yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1].view(np.int64)), pa.array(got[2])], ["g", "fp", "own"])

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        values, own = rows["fp"].to_numpy().view(np.uint64), rows["own"].to_numpy(bool)
        a, b = tile_edges(values[own], values[~own], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.mapInArrow(deal, "g long, fp long, own boolean").groupBy("g").applyInPandas(compare, "a long, b long")


def components(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK, visitors: int = VISITORS) -> DataFrame:
    """``(fp, root)`` for every distinct ``fp`` that has a neighbour within ``radius``."""
    joined = connected_components(links(fps, radius, block, visitors))
    return joined.select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id, n_documents)`` for every row of ``docs``.

    ``component_id`` is the smallest key reachable over fingerprints that differ in at most ``radius`` bits. Null and
    empty texts have fingerprint zero and are linked like others. Repeated rows and equal keys come back once
    each. A row with a null key gets its group's smallest key, or null when the group has none. An empty table gives
    no rows; columns other than ``key`` and ``text`` are ignored.
    """
    fps = materialize(fingerprints(docs, key, text), "fingerprints")
    per = fps.groupBy("fp").agg(F.min("key").alias("_least"), F.count(F.lit(1)).alias("_n"))
    rooted = per.join(components(fps, radius), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = rooted.groupBy("root").agg(F.min("_least").alias("component_id"), F.sum("_n").alias("n_documents"))
    of = rooted.select("fp", "root").join(groups, "root").select("fp", "component_id", "n_documents")
    return fps.join(of, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_documents"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every near-duplicate group: smallest key first, nulls last, then smallest text."""
    # fingerprints are computed once for the links and once more beside the rows, which costs less than a copy of all texts
    fps = materialize(fingerprints(docs, key, text).select("fp"), "fingerprints")
    roots = components(fps, radius).select(F.col("fp").alias("_tl_fp"), F.col("root").alias("_tl_root"))
    marked = docs.withColumn("_tl_fp", fingerprint_column(F.col(text)))
    grouped = marked.join(roots, "_tl_fp", "left").withColumn("_tl_root", F.coalesce("_tl_root", "_tl_fp"))
    first = Window.partitionBy("_tl_root").orderBy(F.col(key).asc_nulls_last(), F.col(text).asc_nulls_last())
    return grouped.withColumn("_tl_row", F.row_number().over(first)).where("_tl_row = 1").select(*docs.columns)
