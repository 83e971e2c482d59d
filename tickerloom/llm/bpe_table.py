"""Byte-level BPE by a global table of distinct words.

Pre-tokens are exploded to numbers by position (see ``lexicon``), distinct ones are shuffled to the part of their hash,
each is encoded once there by merging its bytes, the ids are joined back to the chunks, and each document is
reassembled by position. Decoding joins ids with the token-byte table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm import bpe, lexicon
from tickerloom.llm.common import shuffle_partitions, small_batches


#: Pieces a task remembers beside its chunk's dictionary.
CACHED = 150_000


def _pretoken_numbers(numbers: lexicon.Numbers):
    return bpe.Pieces(lambda token: numbers[token.encode()], keep=CACHED).encode


def _encoded_parts(batches, ranks_path: str):
    """Ids of a part's words, every distinct word once; the dictionary holds one part of all words."""
    ranks, known = bpe.read_ranks(ranks_path), {}
    for batch in batches:
        for chunk, part, body in zip(*(batch.column(n).to_pylist() for n in ("chunk", "part", "body"))):
            ids = []
            for word in lexicon.unpack_words(body):
                got = known.get(word)
                if got is None:
                    got = known[word] = bpe.merged(word, ranks).tobytes()
                ids.append(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([part], pa.int32()), pa.array([lexicon.pack_words(ids)], pa.binary())], ["chunk", "part", "ids"]
            )


def _reassembled(ids: pa.Table, blocks: pa.Table) -> pa.Table:
    table = [w for body in ids.sort_by("part").column("ids").to_pylist() for w in lexicon.unpack_words(body)]
    out = []
    for lengths, body in zip(blocks.column("lengths").to_pylist(), blocks.column("body").to_pylist()):
        found = list(map(table.__getitem__, lexicon.unsqueeze(body, "<u4").tolist()))
        ends = np.cumsum(lengths).tolist()
        out.extend(b"".join(found[a:b]) for a, b in zip([0, *ends], ends))
    return pa.table({"key": lexicon.flat(blocks.column("keys")), "ids": pa.array(out, pa.binary())})


def encode(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", chunk_bytes: int = lexicon.CHUNK_BYTES) -> DataFrame:
    """``(key, ids binary)``: the whole text's ids as little-endian unsigned 32-bit integers, without special tokens.

    Null and empty texts have no ids; rows with equal or null keys stay rows of their own; an empty table gives no
    rows. Other columns are ignored. ``ranks_path`` is a rank file present on every node.
    """
    table = lexicon.chunks(docs, F.col(key), F.lit(False), F.col(text), _pretoken_numbers, chunk_bytes)
    parts = lexicon.words_of(table).select("chunk", "part", "body").repartition(shuffle_partitions(docs), "part")
    ids = parts.mapInArrow(lambda b: _encoded_parts(b, ranks_path), "chunk long, part int, ids binary")
    schema = T.StructType().add("key", docs.schema[key].dataType).add("ids", "binary")
    blocks = lexicon.blocks_of(table).select("chunk", "keys", "lengths", "body")
    return ids.groupBy("chunk").cogroup(blocks.groupBy("chunk")).applyInArrow(_reassembled, schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` plus ``out binary``: the bytes of each row's ids. Null ids give null; an unknown id is an error."""
    names = encoded.columns

    def join(batches):
        token = {rank: word for word, rank in bpe.read_ranks(ranks_path).items()}.__getitem__
        for batch in small_batches(batches, 64):
            bodies = [None if b is None else b"".join(map(token, np.frombuffer(b, "<u4").tolist())) for b in batch.column(names.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bodies, pa.binary())], [*names, out])

    return encoded.mapInArrow(join, T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())]))
