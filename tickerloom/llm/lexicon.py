"""Chunk dictionaries: look every distinct word of a corpus up once, without moving its occurrences.

Texts are cut into words where they lie. A *chunk*, some megabytes of texts that one task reads in a row, becomes a
list of its distinct words and, per document, the numbers of its words in that list. The table of chunks is written
to the shared folder. Only distinct words travel: each to the part its hash names, where equal words of all chunks
meet, and what was found out there back to the chunk, where the numbers stand by position. A word costs the same
however often a chunk repeats it, so frequent words make no part large.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import bound_batches, shuffle_partitions, small_batches
from tickerloom.session import scratch_path

CHUNK_BYTES = 12 << 20
BLOCK_WORDS = 1 << 18
LEVEL = 3


def squeeze(array: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(array).tobytes(), LEVEL)


def unsqueeze(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def pack_words(words: list[bytes]) -> bytes:
    """A list of byte strings in one: count, lengths, contents."""
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.compress(np.array([len(words)], "<u4").tobytes() + lengths.tobytes() + b"".join(words), LEVEL)


def unpack_words(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64).tolist()
    body = raw[4 + 4 * n :]
    return [body[a:b] for a, b in zip([0, *ends], ends)]


def flat(lists: pa.ChunkedArray) -> pa.Array:
    """The elements of a list column."""
    kind = lists.type.value_type
    return pa.concat_arrays([pa.array([], kind), *(c.flatten() for c in lists.chunks)])


class Numbers(dict):
    """Words in order of first sight; a missing word gets the next number, as four bytes."""

    def __missing__(self, word) -> bytes:
        got = self[word] = len(self).to_bytes(4, "little")
        return got


#: (chunk, part, keys, flags, lengths, body, counts): words of a part (part >= 0), or a block of documents (part < 0).
def chunk_schema(key: T.DataType) -> T.StructType:
    return (
        T.StructType().add("chunk", "long").add("part", "integer").add("keys", T.ArrayType(key)).add("flags", T.ArrayType(T.BooleanType()))
        .add("lengths", T.ArrayType(T.LongType())).add("body", "binary").add("counts", "binary")
    )


def chunks(docs: DataFrame, key: Column, flag: Column, text: Column, cutter: Callable, chunk_bytes: int = CHUNK_BYTES, parts: int | None = None) -> DataFrame:
    """The stored table of chunks. ``cutter(numbers)`` returns a function from text to the numbers of its words.

    ``numbers`` maps a word (``bytes``) to its number as four bytes. ``counts`` holds how often each word occurs in the
    chunk's documents whose ``flag`` is false. Null texts are empty. The table is bucketed by chunk.
    """
    parts = parts or shuffle_partitions(docs)
    table = bound_batches(docs).select(key.alias("key"), flag.alias("flag"), text.alias("text"))
    kind = table.schema["key"].dataType

    def cut(batches):
        task = TaskContext.get().partitionId()
        numbers, state = Numbers(), {"made": 0, "bytes": 0}
        number = cutter(numbers)
        keys, flags, seqs = [], [], []
        for batch in small_batches(batches):
            for at, text_ in enumerate(batch.column(2).to_pylist()):
                keys.append(batch.column(0).slice(at, 1))
                flags.append(batch.column(1)[at].as_py())
                seqs.append(number(text_ or ""))
                state["bytes"] += len(text_ or "")
                if state["bytes"] >= chunk_bytes:
                    yield from _flushed((task << 32) | state["made"], numbers, keys, flags, seqs, parts)
                    numbers, keys, flags, seqs = Numbers(), [], [], []
                    number = cutter(numbers)
                    state.update(made=state["made"] + 1, bytes=0)
        if keys:
            yield from _flushed((task << 32) | state["made"], numbers, keys, flags, seqs, parts)

    return _bucketed(table.mapInArrow(cut, chunk_schema(kind)), "chunk", parts)


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` stored in the shared folder in buckets of ``key``, so that grouping by ``key`` does not shuffle it.

    The catalogue entry goes at once; the returned frame reads the files.
    """
    spark, name = df.sparkSession, f"tl_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch_path(spark, key)).saveAsTable(name)
    stored = spark.table(name)
    stored.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {name}")
    return stored


def _row(chunk, part, keys, flags, lengths, body, counts, kind) -> pa.RecordBatch:
    one = pa.array([0, len(keys)], pa.int32()) if keys is not None else None
    listed = pa.ListArray.from_arrays(one, keys) if keys is not None else pa.nulls(1, pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), listed, pa.array([flags], pa.list_(pa.bool_())),
            pa.array([lengths], pa.list_(pa.int64())), pa.array([body], pa.binary()), pa.array([counts], pa.binary()),
        ],
        ["chunk", "part", "keys", "flags", "lengths", "body", "counts"],
    )


def _flushed(chunk: int, numbers: Numbers, keys, flags, seqs, parts: int) -> Iterator[pa.RecordBatch]:
    words = list(numbers)
    part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = order[np.argsort(part[order], kind="stable")]
    renumbered = np.empty(len(words), "<u4")
    renumbered[order] = np.arange(len(words))
    counts = np.zeros(len(words), "<u4")
    kind = keys[0].type
    first, number = 0, -1
    while first < len(seqs):
        last, size = first, 0
        while last < len(seqs) and (size == 0 or size + len(seqs[last]) // 4 <= BLOCK_WORDS):
            size += len(seqs[last]) // 4
            last += 1
        body = renumbered[np.frombuffer(b"".join(seqs[first:last]), "<u4")]
        lengths = [len(s) // 4 for s in seqs[first:last]]
        counted = np.repeat(~np.array(flags[first:last], bool), lengths)
        counts += np.bincount(body[counted], minlength=len(words)).astype("<u4")
        yield _row(chunk, number, pa.concat_arrays(keys[first:last]), flags[first:last], lengths, squeeze(body), None, kind)
        first, number = last, number - 1
    ordered = part[order]
    for p in np.unique(ordered).tolist():
        a, b = np.searchsorted(ordered, [p, p + 1])
        yield _row(chunk, p, None, None, None, pack_words([words[i] for i in order[a:b]]), squeeze(counts[a:b]), kind)


def words_of(table: DataFrame) -> DataFrame:
    return table.where("part >= 0").select("chunk", "part", "body", "counts")


def blocks_of(table: DataFrame) -> DataFrame:
    return table.where("part < 0").select("chunk", "part", "keys", "flags", "lengths", "body")
