"""Approximate nearest neighbours by adaptive dimension scans within probed lists.

Vectors are put into lists around centroids fitted on a bounded sample. A query probes its nearest lists; how many is
set on the sample, so that at least ``TARGET`` of true neighbours lie in probed lists. Within a list vectors are
rotated by a random orthogonal matrix and kept in column blocks. After each block a candidate's partial distance is
tested: rotated coordinates are alike, so a part of d of D dimensions that exceeds the best k-th distance times
d/D by the factor (1 + EPSILON/sqrt(d))^2 makes it a neighbour only with tiny probability, and it is abandoned.
What survives is measured in full on the original vectors in double precision.

A list is dealt in blocks of bounded size and queries in blocks as well; a task holds one block of each, so a list
that holds a third of all vectors only has more blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.common import small_batches
from tickerloom.session import materialize

K = 10
COLUMNS = 16
EPSILON = 2.1
#: Bounds of the fit: sampled vectors, lists, queries of the sample that set the number of probes.
SAMPLE = 20_000
MOST_LISTS = 1024
PROBE_QUERIES = 400
TARGET = 0.985
#: Rows and queries of one task.
BLOCK = 8192
QUERY_BLOCK = 1024
_SCAN = 1024
#: Rows measured whole before the first bound is known; steps double from there.
_FIRST = 64


def distances(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - q) ** 2).sum(axis=1))


def rotation(size: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None, :]


def fit(sample: np.ndarray, lists: int, k: int = K, target: float = TARGET, seed: int = 5) -> tuple[np.ndarray, int]:
    """Centroids by Lloyd's rounds, and the number of lists to probe."""
    different = np.unique(sample, axis=0)
    lists = max(1, min(lists, len(different)))
    centroids = different[np.random.default_rng(seed).permutation(len(different))[:lists]].astype(float)
    for _ in range(8):
        near = _squares(sample, centroids).argmin(1)
        for i in np.unique(near):
            centroids[i] = sample[near == i].mean(0)
    near = _squares(sample, centroids).argmin(1)
    queries = sample[:PROBE_QUERIES]
    order = _squares(queries, centroids).argsort(1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None, :], 1)
    apart = _squares(queries, sample)
    apart[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    best = apart.argsort(1)[:, : min(k, max(1, len(sample) - 1))]
    needed = np.take_along_axis(place, near[best], 1).ravel()
    return centroids, int(np.quantile(needed, target, method="higher")) + 1


class Block:
    """Vectors of one block of a list, rotated, by column blocks."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.abandoned = 0
        self.size = vectors.shape[1]
        self.turn = rotation(self.size)
        turned = self.vectors @ self.turn
        self.cuts = [(a, min(a + COLUMNS, self.size)) for a in range(0, self.size, COLUMNS)]
        self.columns = [np.ascontiguousarray(turned[:, a:b]) for a, b in self.cuts]

    def nearest(self, own: int, query: np.ndarray, k: int = K, bound: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, distances)`` of up to ``k`` rows found, ties to the smaller id.

        ``bound`` is a squared distance known to hold ``k`` rows elsewhere. ``abandoned`` counts the rows left before their last columns.
        """
        q = query @ self.turn
        found_rows, found = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, _FIRST
        while at < len(self.ids):
            rows = np.arange(at, min(at + step, len(self.ids)))
            at, step = at + step, min(2 * step, _SCAN)
            rows = rows[self.ids[rows] != own]
            part = np.zeros(len(rows))
            for (a, b), block in zip(self.cuts, self.columns):
                part += ((block[rows] - q[a:b]) ** 2).sum(axis=1)
                if bound < math.inf:
                    limit = bound * (1 + 1e-9) + 1e-12
                    if b < self.size:
                        limit *= b / self.size * (1 + EPSILON / math.sqrt(b)) ** 2
                    keep = part <= limit
                    if b < self.size:
                        self.abandoned += len(keep) - int(keep.sum())
                    rows, part = rows[keep], part[keep]
                if not len(rows):
                    break
            if len(rows):
                found_rows = np.concatenate([found_rows, rows])
                found = np.concatenate([found, distances(query, self.vectors[rows])])
                best = np.lexsort((self.ids[found_rows], found))[:k]
                found_rows, found = found_rows[best], found[best]
                if len(found) == k:
                    bound = min(bound, found[-1] ** 2)
        return self.ids[found_rows], found


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks]
    return np.concatenate(flat).astype(float).reshape(-1, size) if flat else np.zeros((0, size))


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Rows with a key and a finite non-zero vector of the commonest length (the shorter of equals), and that length."""
    good = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    v = F.col("v")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = good.where(finite & F.exists(v, lambda x: x != 0))
    top = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = top["n"] if top else 0
    return good.where(F.size("v") == size), size


def search(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = K, lists: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: up to ``k`` nearest other rows found for every row where ``is_query(key)``.

    ``score`` is the Euclidean distance in double precision, ``rank`` counts from 1, ties go to the smaller id. Rows with
    a null key, and null or zero vectors or ones with null or non-finite parts, take no part, nor do vectors of
    another length than the commonest. A row with the query's own key is not its candidate. Repeated vectors are
    neighbours at distance 0. Rows that repeat the key of a query are one query, by the least of their vectors, and each a candidate of
    others. Without rows or queries the result is empty.
    """
    good, size = usable(vectors, key, vector)
    total = good.count()
    sample_rows = good.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    sample = _matrix(sample_rows.column("v"), size) if total else np.zeros((0, 1))
    if len(sample):
        centroids, probes = fit(sample, lists or max(1, min(MOST_LISTS, round(math.sqrt(total) / 2))), k)
    else:
        centroids, probes = np.zeros((1, 1)), 1

    def assign(batches):
        for batch in small_batches(batches, 4096):
            near = _squares(_matrix(batch.column(1), size), centroids).argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), *batch.columns], ["list", "id", "v"])

    kind = good.schema["v"].dataType.simpleString()
    index = materialize(good.mapInArrow(assign, f"list int, id long, v {kind}"), "index")
    sizes = {r[0]: r[1] for r in index.groupBy("list").count().collect()}  # at most MOST_LISTS rows
    held = np.array([sizes.get(i, 0) for i in range(len(centroids))])
    cuts = np.maximum(1, -(-held // BLOCK))
    queries = index.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    parts = max(1, -(-queries.count() // QUERY_BLOCK))

    def probe(batches):
        for batch in small_batches(batches, 1024):
            ids = batch.column(0).to_numpy()
            near = _squares(_matrix(batch.column(1), size), centroids).argsort(1)
            # more lists are probed where the usual number holds too few rows for k neighbours
            needed = np.maximum(probes, (np.cumsum(held[near], axis=1) <= k + 1).sum(axis=1) + 1)
            row, tile, first = [], [], []
            for i, of in enumerate(near.tolist()):
                part = int(ids[i]) * 2654435761 % 2**32 % parts
                for at in of[: needed[i]]:
                    for cut in range(cuts[at]):
                        row.append(i)
                        first.append(at == of[0])
                        tile.append((at << 40) | (cut << 20) | part)
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), *taken.columns, pa.array(first, pa.bool_())], ["tile", "id", "v", "first"])

    asked = queries.select("id", "v").mapInArrow(probe, f"tile long, id long, v {kind}, first boolean")
    # the cut of a row is drawn by its hash; each block of queries meets every block of the list
    cut_of = F.create_map(*[x for i in np.nonzero(cuts > 1)[0].tolist() for x in (F.lit(i), F.lit(int(cuts[i])))]) if (cuts > 1).any() else None
    n_cuts = F.coalesce(cut_of[F.col("list")], F.lit(1)) if cut_of is not None else F.lit(1)
    cut = F.pmod(F.xxhash64("id"), n_cuts)
    tile = F.shiftleft(F.col("list").cast("long"), 40) + F.shiftleft(cut.cast("long"), 20) + F.col("part")
    stored = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(tile.alias("tile"), "id", "v")

    def scan(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and asked.num_rows:
            block = Block(rows.column("id").to_numpy(), _matrix(rows.column("v"), size))
            for own, query, bound in zip(asked.column("id").to_pylist(), _matrix(asked.column("v"), size), asked.column("bound").to_pylist()):
                ids, found = block.nearest(own, query, k, math.inf if bound is None else bound)
                out.append((np.full(len(ids), own), ids, found))
        own, ids, found = (np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3))
        return pa.table({"query_id": pa.array(own.astype(np.int64)), "vec_id": pa.array(ids.astype(np.int64)), "score": pa.array(found.astype(float))})

    def scanned(some: DataFrame) -> DataFrame:
        return stored.groupBy("tile").cogroup(some.groupBy("tile")).applyInArrow(scan, "query_id long, vec_id long, score double")

    # the nearest list comes first; its k-th distance is where candidates of the other lists are abandoned
    near = materialize(scanned(asked.where("first").select("tile", "id", "v", F.lit(None).cast("double").alias("bound"))), "near")
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    kth = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") == k).select(F.col("query_id").alias("id"), (F.col("score") ** 2).alias("bound"))
    far = scanned(asked.where("not first").join(kth, "id", "left").select("tile", "id", "v", "bound"))
    found = near.unionByName(far)
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
