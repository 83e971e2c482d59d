"""Benchmark decontamination by winnowing: which words of a document lie in a window of an item.

A window is ``window`` consecutive words of an item; an item with fewer words is one window. Of the hashes of the
``k``-word grams of a window the smallest is its fingerprint. It depends on the window's words alone, so a document that holds the
window has the fingerprint as well: every shared span of ``window`` words is found. Short items have grams of their own length.

1. *Fingerprints* of items are distinct rows. They also become a bit table of fixed size, whatever the number of items, with
   which the tasks that read documents leave out windows that no item can have. A full table would let all pass, at more shuffling.
2. *Join* of training and test fingerprints, on distinct pairs of fingerprint and window, so copies of a passage count once.
3. *Extension*: the windows around a hit are compared by a 128-bit digest of their words; their places are merged to spans of words.

Windows and sets of windows that many documents share are spread over tasks (``spread_join``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import BitTable, bit_segments, bound_batches, small_batches, spread_join
from tickerloom.session import materialize

WINDOW = 10
#: Bits of the fingerprint table: 8 MB.
TABLE_BITS = 26
_PIECE = 1 << 20

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_LOWERED = bytes(range(256)).lower()
#: Lower-cases A-Z and turns every byte outside of words into zero.
TABLE = bytes(b if b in _WORD else 0 for b in _LOWERED)

_BYTE = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_STEP, _PIECE), _powers(_BACK, _PIECE)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some texts: their bytes, places, hashes, and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\0".join(texts).translate(TABLE)
        data = np.frombuffer(self.raw, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = data != 0
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[::2], edges[1::2]
        bases = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.edges = np.searchsorted(self.starts, bases)
        self.hashes = self._hashes(data)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.edges))

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit hash per word by prefix sums over pieces that end between words."""
        out, at, n = np.zeros(len(self.starts), np.uint64), 0, len(self.starts)
        while at < n:
            low = self.starts[at]
            end = max(at + 1, int(np.searchsorted(self.ends, low + _PIECE, "right")))
            piece = data[low : self.ends[end - 1]]
            up, down = (_UP, _DOWN) if len(piece) <= _PIECE else (_powers(_STEP, len(piece)), _powers(_BACK, len(piece)))
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
            first = self.starts[at:end] - low
            out[at:end] = (sums[self.ends[at:end] - low] - sums[first]) * down[first]
            at = end
        return _mixed(out)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each place, and whether they lie in one text."""
        size = max(0, len(self.hashes) - n + 1)
        h = self.hashes[:size] + np.uint64(n)
        for j in range(1, n):
            h = _mixed(h * np.uint64(_STEP) + self.hashes[j : j + size])
        return h, self.text[:size] == self.text[n - 1 : n - 1 + size]

    def minima(self, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest ``k``-gram hash of the window from each place, and whether it lies in one text."""
        grams, _ = self.runs(k)
        size = max(0, len(self.hashes) - window + 1)
        least = grams[:size].copy()
        for j in range(1, window - k + 1):
            np.minimum(least, grams[j : j + size], out=least)
        return least, self.text[:size] == self.text[window - 1 : window - 1 + size]

    def digest(self, at: int, n: int) -> bytes:
        return xxhash.xxh3_128_digest(b" ".join([self.raw[a:b] for a, b in zip(self.starts[at : at + n].tolist(), self.ends[at : at + n].tolist())]))


def _windows(words: Words, window: int, short: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(words in a window, its fingerprints, whether it lies in one text)`` from each place."""
    yield window, *words.minima(window, (window + 1) // 2)
    for n in short:
        yield n, *words.runs(n)


_WINDOWS = "_fp long, _win binary, _n int"


def _item_windows(batches, window: int):
    """Distinct windows of each item."""
    for batch in small_batches(batches):
        names, texts = batch.column(0).to_pylist(), [(t or "").encode() for t in batch.column(1).to_pylist()]
        words = Words(texts)
        size = np.diff(words.edges)
        rows = set()
        for n, fp, whole in _windows(words, window, sorted({int(s) for s in size if 0 < s < window})):
            for at in np.flatnonzero(whole).tolist():
                if n == window or size[words.text[at]] == n:
                    rows.add((names[words.text[at]], int(fp[at].view(np.int64)), words.digest(at, n), n))
        cols = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.binary(), pa.int32()))], ["_item", "_fp", "_win", "_n"])


_CANDIDATES = pa.list_(pa.struct([("_fp", pa.int64()), ("_win", pa.binary()), ("_n", pa.int32()), ("_at", pa.binary())]))


def _marked(batches, window: int, short: list[int], segments: dict[int, bytes], bits: int):
    """Per document: its number of words and the windows whose fingerprint an item may have."""
    table = BitTable(segments, bits)
    for batch in small_batches(batches):
        words = Words([(t or "").encode() for t in batch.column(1).to_pylist()])
        found: list[dict[tuple[int, bytes, int], list[int]]] = [{} for _ in range(batch.num_rows)]
        for n, fp, whole in _windows(words, window, short):
            for at in np.flatnonzero(whole & table.holds(fp)).tolist():
                d = int(words.text[at])
                found[d].setdefault((int(fp[at].view(np.int64)), words.digest(at, n), n), []).append(at - int(words.edges[d]))
        rows = [[{"_fp": f, "_win": w, "_n": n, "_at": np.array(p, "<i4").tobytes()} for (f, w, n), p in of.items()] for of in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(words.edges), pa.int64()), pa.array(rows, _CANDIDATES)], [batch.schema.names[0], "_words", "_windows"]
        )


def _merged(batches):
    """Spans of hit words per document, and the set of its windows under a digest."""
    for batch in batches:
        spans, sets, keys = [], [], []
        for places, wins in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            first = np.concatenate([np.frombuffer(p["_at"], "<i4") for p in places])
            last = np.concatenate([np.full(len(p["_at"]) // 4, p["_n"]) for p in places]) + first
            order = np.argsort(first, kind="stable")
            first, last = first[order], np.maximum.accumulate(last[order])
            new = np.flatnonzero(np.append(True, first[1:] > last[:-1]))
            spans.append([{"from": int(a), "to": int(b)} for a, b in zip(first[new], last[np.append(new[1:], len(first)) - 1])])
            sets.append(sorted(wins))
            keys.append(xxhash.xxh3_128_digest(b"".join(sets[-1])))
        span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, span), pa.array(sets, pa.list_(pa.binary())), pa.array(keys, pa.binary())], ["_row", "_spans", "_wins", "_set"]
        )


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, bits: int = TABLE_BITS) -> DataFrame:
    """``(key, n_words long, spans, items)`` for every row of ``docs``.

    ``spans`` are the runs of words (from, to) inside windows of items, in order, without overlap; ``items`` the names of the items
    with a window in the text, as distinct strings in byte order. A null text has no words; an item without words has no windows and one
    without a name counts as the empty one. Rows of an item with one name are one item. Repeated rows and null or equal keys
    are rows of their own. An empty table on either side gives rows without hits, or none. Other columns are ignored.
    """
    named = bound_batches(items).select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("_item"), F.col(item_text).alias("_text"))
    tests = materialize(named.mapInArrow(lambda b: _item_windows(b, window), f"_item string, {_WINDOWS}").distinct(), "item-windows")
    short = sorted(r[0] for r in tests.select("_n").where(F.col("_n") < window).distinct().collect())  # at most window - 1
    segments = bit_segments(tests.select("_fp"), bits)

    kind = T.StructType().add("_key", docs.schema[key].dataType).add("_words", "long")
    kind = T.StructType([*kind.fields, *T._parse_datatype_string(f"_windows array<struct<{_WINDOWS.replace(' ', ':').replace(',:', ',')},_at:binary>>").fields])
    bare = bound_batches(docs).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    read = bare.mapInArrow(lambda b: _marked(b, window, short, segments, bits), kind)
    marked = materialize(read.withColumn("_row", F.monotonically_increasing_id()), "marked")  # the numbers are stored

    places = marked.select("_row", F.inline("_windows"))
    trained = places.groupBy("_fp", "_win", "_n").agg(F.count(F.lit(1)).alias("_docs"))
    met = materialize(trained.join(tests.select("_fp", "_win", "_n").distinct(), ["_fp", "_win", "_n"]).select("_win", "_docs"), "met")
    hits = spread_join(places.select("_row", "_win", "_n", "_at"), met, ["_win"], "_docs", F.col("_row"))
    per = hits.groupBy("_row").agg(F.collect_list(F.struct("_n", "_at")).alias("_places"), F.collect_set("_win").alias("_wins"))
    runs = per.mapInArrow(_merged, "_row long, _spans array<struct<from:int,to:int>>, _wins array<binary>, _set binary")
    found = materialize(runs, "hits")

    sets = found.groupBy("_set").agg(F.first("_wins").alias("_wins"), F.count(F.lit(1)).alias("_docs"))
    of = sets.select("_set", "_docs", F.explode("_wins").alias("_win")).join(tests.select("_win", "_item").distinct(), "_win")
    names = of.groupBy("_set", "_docs").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    spans = spread_join(found.select("_row", "_spans", "_set"), materialize(names, "sets"), ["_set"], "_docs", F.col("_row"))
    return marked.join(spans.select("_row", "_spans", "_items"), "_row", "left").select(
        F.col("_key").alias(key),
        F.col("_words").alias("n_words"),
        F.coalesce("_spans", F.array().cast("array<struct<from:int,to:int>>")).alias("spans"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
    )
