"""Best-fit decreasing packing of token pieces into windows of fixed length.

Documents are tokenized where they lie. Overlong ones are first cut into full windows, so a document gives full
pieces and at most one shorter rest. Pieces of one length are interchangeable: best-fit decreasing needs only how
many there are of each length, at most ``window`` numbers at any input size. ``plan`` walks them from long to short
and asks a segment tree over remaining capacities for the tightest open window; whole runs of equal windows are
filled at once. Its answer, runs of piece ranks against runs of windows, is joined back to the ranked pieces.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from collections import deque

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm import bpe
from tickerloom.llm.common import bound_batches, hash_bucket, ranked, small_batches
from tickerloom.session import materialize

WINDOW = 1024
END = 0
#: The vocabulary's special token: fixed value of the tokenizer file.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
RANK_BUCKETS = 256


_LONG_SPACE = re.compile(r"\s{256}")


def _little(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class Encoder:
    """Ids as little-endian 32-bit integers, equal to those of the ``tokenizers`` file of the same vocabulary."""

    def __init__(self, ranks_path: str):
        self.core = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks_path), special_tokens={})

    def __call__(self, text: str) -> bytes:
        return struct.pack("<I", SPECIAL_ID).join(map(self._plain, text.split(SPECIAL)))

    def _plain(self, text: str) -> bytes:
        if _LONG_SPACE.search(text):  # the library's pattern matcher overflows its stack there
            return b"".join(_little(self.core._core_bpe.encode_single_piece(t.encode())) for t in bpe.pretokens(text))
        return _little(self.core.encode_ordinary(text))


def token_pieces(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens)``: every document's ids and ``end``, cut at multiples of ``window``."""
    kind = docs.schema[key].dataType
    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]

    def cut(batches):
        encode, last = Encoder(ranks_path), struct.pack("<I", end)
        for batch in small_batches(batches):
            row, out = [], []
            for at, body in enumerate(batch.column(1).to_pylist()):
                ids = encode(body or "") + last
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    row.append(at)
                    out.append((start, len(part) // 4, zlib.crc32(part), total))
            cols = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(np.ascontiguousarray(cols[:, i])) for i in range(4))],
                ["key", *(f.name for f in longs)],
            )

    return bound_batches(docs).select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(cut, T.StructType([T.StructField("key", kind), *longs]))


class Tightest:
    """A segment tree over remaining capacities 0..size: the smallest one, from a bound up, that has open windows."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = capacity + self.leaves
        while at:
            self.open[at] += n
            at >>= 1

    def from_bound(self, bound: int) -> int | None:
        at = bound + self.leaves
        if self.open[at]:
            return bound
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at + (not self.open[2 * at])
                return at - self.leaves
            at >>= 1
        return None


def plan(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over ``{length: pieces}``.

    Returns runs ``(length, first rank, pieces, first window, offset)`` and the number of windows: piece
    ``first rank + i`` of that length goes to window ``first window + i`` at ``offset``. The work depends on
    ``window`` alone, as equal windows are kept as runs of numbers.
    """
    tree, runs_of = Tightest(window), [deque() for _ in range(window + 1)]
    runs, windows = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.from_bound(length)
            if capacity is None:
                capacity, first = window, windows
                each = capacity // length
                n = max(1, left // each)
                windows += n
            else:
                first, there = runs_of[capacity].popleft()
                each = capacity // length
                n = min(there, max(1, left // each))
                tree.add(capacity, -n)
                if there > n:
                    runs_of[capacity].appendleft((first + n, there - n))
            # a window that has just taken a piece is the tightest for the next one: it takes as many as fit
            each = min(each, left // n)
            for layer in range(each):
                runs.append((length, rank, n, first, window - capacity + layer * length))
                rank += n
            left -= each * n
            rest = capacity - each * length
            if rest:
                runs_of[rest].append((first, n))
                tree.add(rest, n)
    return runs, windows


def packed(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (with ``key``, ``start`` and ``length``) plus ``sequence_id`` and ``offset``. Reads ``pieces`` twice."""
    pieces = materialize(pieces, "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    runs, _ = plan(counts, window)
    by_length: dict[int, np.ndarray] = {
        length: np.array([r[1:] for r in runs if r[0] == length], np.int64) for length in counts
    }
    placed = ranked(pieces, ["length"], hash_bucket(F.struct("key", "start"), RANK_BUCKETS), F.struct("key", "start", "ids_crc32"), "_rank", RANK_BUCKETS)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = pieces.columns

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "_rank"))
            out = np.empty((2, len(rank)), np.int64)
            for value in np.unique(length):
                of, table = np.nonzero(length == value)[0], by_length[int(value)]
                run = np.searchsorted(table[:, 0], rank[of], "right") - 1
                out[0, of] = table[run, 2] + rank[of] - table[run, 0]
                out[1, of] = table[run, 3]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out[0]), pa.array(out[1])], [f.name for f in schema])

    return placed.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is one piece that holds only ``end``. Repeated rows and null or equal keys are packed as rows of
    their own. An empty table gives no rows; other columns are ignored. Full windows come first in ``sequence_id``.
    """
    return packed(token_pieces(docs, ranks_path, key, text, window, end), window).withColumnRenamed("key", key)
