"""Source divergence audit: how the terms of each source of a language differ from the language and its other sources.

One pass over the texts: a translate table lower-cases letters and blanks all else, ``split`` gives the terms and a ``Counter`` per
document their frequencies; a task adds them up per (language, source, term) in a bounded table before anything is shuffled.
Only terms that occur are rows. Shares are smoothed and rounded to billionths in whole numbers, so all sums are exact.

Two sources of a language are compared over all its terms. Terms are dealt to buckets of bounded size; in each, numpy adds up the
differences of all pairs of sources over blocks of terms, and the buckets' sums are added by Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import bound_batches, shuffle_partitions, small_batches
from tickerloom.session import materialize

LEAST_DOCUMENTS = 30
TOP = 50
SMOOTHING = 5
SCALE = 1_000_000_000
_HELD_TERMS = 1 << 17
#: Rows (a term of a source) that one bucket of terms should hold, and numbers of one block.
BUCKET = 100_000
_BLOCK = 1 << 20
_PIECE = 1 << 20

_WORD = {*range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z and turns every byte outside of terms into a blank.
TABLE = bytes(b if b in _WORD else 0x20 for b in bytes(range(256)).lower())


def term_counts(text: bytes) -> Counter:
    """Frequencies of the terms of one text; a long one is split piece by piece."""
    raw, at, out = text.translate(TABLE), 0, Counter()
    while at < len(raw):
        end = raw.find(b" ", at + _PIECE)
        end = len(raw) if end < 0 else end
        out.update(raw[at:end].split())
        at = end
    return out


def _counted(batches):
    """Occurrences and documents per language, source and term, added up in a table that is handed on when full.

    A row without a term stands for every language and source that occurs.
    """
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            terms = list(times)
            size = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()), pa.array([None, *(t.decode() for t in terms)], pa.string()),
                    pa.array([0, *times.values()], pa.int64()), pa.array([0, *(docs[t] for t in terms)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "d"],
            )

    size = 0
    for batch in small_batches(batches):
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(times)
            own = term_counts(text.encode())
            times.update(own)
            docs.update(own.keys())
            size += len(times)
            if size > _HELD_TERMS:
                yield from rows()
                held.clear()
                size = 0
    yield from rows()


def _share(count: Column, total: Column, kinds: Column) -> Column:
    """``1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * kinds))`` in whole numbers."""
    part = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(11,0)")
    return F.call_function("div", part, (total + SMOOTHING * kinds).cast("decimal(20,0)")) + 1


def _pair_sums(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Sum of differences for each pair of a language's sources over one bucket of its terms."""
    groups = groups.sort_by("no")
    numbers, plain = groups.column("no").to_numpy(), groups.column("plain").to_numpy()
    size = len(numbers)
    if size < 2 or not cells.num_rows:
        return pa.table({"lang": pa.array([], pa.string()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "value": pa.array([], pa.int64())})
    term = np.unique(cells.column("term").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    order = np.argsort(term, kind="stable")
    term = term[order]
    source = np.searchsorted(numbers, cells.column("no").to_numpy())[order]
    share = cells.column("p").to_numpy()[order]
    total = np.zeros((size, size), np.int64)
    height = max(1, _BLOCK // size)
    for low in range(0, int(term[-1]) + 1, height):
        of = slice(*np.searchsorted(term, [low, low + height]))
        block = np.repeat(plain[:, None], min(height, int(term[-1]) + 1 - low), axis=1)
        block[source[of], term[of] - low] = share[of]
        for a in range(size - 1):
            total[a, a + 1 :] += np.abs(block[a + 1 :] - block[a]).sum(axis=1)
    a, b = np.triu_indices(size, 1)
    lang = pa.array([cells.column("lang")[0].as_py()], pa.string())
    return pa.table({"lang": lang.take(pa.array(np.zeros(len(a), np.int32))), "a": pa.array(numbers[a], pa.int32()), "b": pa.array(numbers[b], pa.int32()), "value": pa.array(total[a, b])})


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP, bucket: int = BUCKET
) -> DataFrame:
    """``(lang, source, part, item, value long, rank int)``.

    Terms of a language are those in ``least`` of its documents. Part ``pair``: item is another source of the language, value the
    sum over all its terms of the difference of shares. Part ``term``: item is one of the source's ``top`` terms whose share exceeds the
    language's most, value by how much. Ranks count from 1, largest value first, ties by item in byte order. Null languages, sources
    and texts count as empty; repeated rows count again. A language without terms gives pairs of value 0; a source that is alone in its
    language has no pairs. An empty table gives no rows. Other columns are ignored.
    """
    bare = bound_batches(docs).select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "_text"))))
    found = bare.mapInArrow(_counted, "lang string, source string, term string, n long, d long")
    cells = materialize(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")), "cells")

    of_term = Window.partitionBy("lang", "term")
    known = cells.where("term is not null").withColumns({"n_lang": F.sum("n").over(of_term), "d_lang": F.sum("d").over(of_term)})
    kept = materialize(known.where(F.col("d_lang") >= least).select("lang", "source", "term", "n", "n_lang"), "kept")
    terms = kept.groupBy("lang", "term").agg(F.first("n_lang").alias("n"))
    langs = terms.groupBy("lang").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_own"))
    groups = cells.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_own", "n_all", "v")}
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source"))
    groups = groups.withColumns(zero).withColumn("no", number)
    groups = materialize(groups.withColumn("plain", F.when(F.col("v") > 0, _share(F.lit(0), F.col("n_own"), F.col("v"))).otherwise(F.lit(0))), "groups")

    shares = materialize(
        kept.join(groups, ["lang", "source"]).select(
            "lang", "source", "no", "term", _share(F.col("n"), F.col("n_own"), F.col("v")).alias("p"), _share(F.col("n_lang"), F.col("n_all"), F.col("v")).alias("q")
        ),
        "shares",
    )
    parts = max(shuffle_partitions(docs), -(-shares.count() // bucket))
    dealt = shares.select("lang", "no", "term", "p", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"))
    everywhere = groups.select("lang", "no", "plain", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    sums = dealt.groupBy("lang", "part").cogroup(everywhere.groupBy("lang", "part")).applyInArrow(_pair_sums, "lang string, a int, b int, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    names = groups.select("lang", "no", "source")
    sources = names.select("lang", F.col("no").alias("a"), "source").join(names.select("lang", F.col("no").alias("b"), F.col("source").alias("item")), "lang").where("a <> b")
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = sources.join(both, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    best = over.withColumn("rank", place).where(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(best)
