"""A toxicity classifier learned from confirmed toxic texts and unlabelled ones (non-negative PU learning).

Positive examples are texts confirmed as toxic; unlabelled ones are drawn from all texts, whatever their label. With the
class prior ``p`` the risk on negatives is estimated as ``R_u(-) - p R_p(-)`` and kept from going below zero
(then the step runs uphill on it), after the published non-negative estimator. The model is linear over the
words and their beginnings, fitted in numpy on a bounded sample; every whole text is scored on the executors.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm.common import bound_batches, small_batches
from tickerloom.session import materialize

#: Bounds of the fitting sample: texts of each kind, by hash order.
POSITIVES = 3000
UNLABELLED = 9000
FOLDS = 5
MIN_TEXTS = 4
#: Standard errors by which a word must be commoner in positives to have a weight.
SURPRISE = 5.0
STEMS = (4, 6)
STEPS = 600
STEP_SIZE = 0.2
PENALTY = 1e-5
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> tuple[dict[str, int], float]:
    """Distinct lower-case letter runs of a whole text with their beginnings, which word forms share (``lett~``).

    A run counts 1, a beginning the number of distinct runs that have it. The second value scales them: the
    inverse root of the number of runs, so that one word weighs more in a short text.
    """
    whole = set(_WORD.findall((text or "").lower()))
    found = dict.fromkeys(whole, 1)
    for size in STEMS:
        for word in whole:
            if len(word) > size:
                stem = word[:size] + "~"
                found[stem] = found.get(stem, 0) + 1
    return found, 1 / math.sqrt(len(whole)) if whole else 0.0


def learnable(key: Column, folds: int = FOLDS) -> Column:
    """Rows whose labels may be used. A null key counts as crc32 of the empty string."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds != 0


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        get = self.weights.get
        found, scale = features(text)
        z = self.bias + scale * math.fsum(w * n for w, n in ((get(f), n) for f, n in found.items()) if w)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


Cells = tuple[np.ndarray, np.ndarray, np.ndarray]


def fit(names: list[str], positive: Cells, n_positive: int, unlabelled: Cells, n_unlabelled: int, prior: float) -> Model:
    """Non-negative PU learning with the logistic loss over scaled feature counts.

    Cells are (text, feature, value). Without examples of either kind every score is low; the bias starts at the prior.
    """
    if not n_positive or not n_unlabelled:
        return Model({}, -4.0)
    (rows_p, cols_p, x_p), (rows_u, cols_u, x_u) = positive, unlabelled
    p, u = n_positive, n_unlabelled
    w, b = np.zeros(len(names)), math.log(prior / (1 - prior))
    moment, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, STEPS + 1):
        zp = b + np.bincount(rows_p, w[cols_p] * x_p, p)
        zu = b + np.bincount(rows_u, w[cols_u] * x_u, u)
        up, uu = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        grad_pos, grad_neg = prior * (up - 1) / p, (uu / u, -prior * up / p)
        if negative >= 0:
            on_p, on_u = grad_pos + grad_neg[1], grad_neg[0]
        else:  # the estimate has gone below zero: undo the overfit on it
            on_p, on_u = -grad_neg[1], -grad_neg[0]
        on_w = np.bincount(cols_p, on_p[rows_p] * x_p, len(w)) + np.bincount(cols_u, on_u[rows_u] * x_u, len(w)) + PENALTY * w
        grad = np.append(on_w, on_p.sum() + on_u.sum())
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        move = STEP_SIZE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model({name: float(v) for name, v in zip(names, w) if v}, float(b))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fit on at most ``POSITIVES`` toxic and ``UNLABELLED`` unlabelled documents of the rows whose labels may be used.

    The samples are the first keys by hash (a top-k of keys alone); copies count once. The prior is the share of toxic
    among all usable labels, null labels count as unlabelled. A feature has a weight if at least ``MIN_TEXTS`` positives
    have it and it is clearly commoner there than in unlabelled texts. Counting is done on the executors; the driver
    gets the chosen features and, for the sampled texts, their values.
    """
    usable = labels.select(F.col("doc_id").alias("_k"), F.col("toxic").alias("_t")).where("_k is not null").where(learnable(F.col("_k")))
    total, toxic = usable.where("_t is not null").agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("_t") == 1).cast("long")), F.lit(0))).first()
    prior = min(0.5, max(1e-3, toxic / total)) if total else 0.05
    order = F.xxhash64("_k")
    texts = bound_batches(docs).select(F.col(key).alias("_k"), F.col(text).alias("_x")).where(learnable(F.col("_k")))
    confirmed = usable.where("_t = 1").select("_k").distinct()
    picked = confirmed.join(texts.select("_k").distinct(), "_k", "left_semi").orderBy(order, "_k").limit(POSITIVES)
    # unlabelled texts are drawn from all, toxic ones included, as the prior speaks of all
    others = texts.select("_k").distinct().orderBy(order, "_k").limit(UNLABELLED)
    keys = picked.withColumn("_p", F.lit(True)).unionByName(others.withColumn("_p", F.lit(False)))
    sample = materialize(_featured(texts.join(keys, "_k")).dropDuplicates(["_p", "_k"]).dropDuplicates(["_p", "_d"]), "sample")

    sizes = {r[0]: r[1] for r in sample.groupBy("_p").count().collect()}
    p, u = sizes.get(True, 0), sizes.get(False, 0)
    if not p or not u:
        return fit([], _EMPTY, p, _EMPTY, u, prior)
    seen = sample.select("_p", F.explode("_f").alias("f")).groupBy("f").agg(
        F.sum(F.col("_p").cast("int")).alias("a"), F.sum((~F.col("_p")).cast("int")).alias("b")
    )
    both = F.least((F.col("a") + F.col("b") + 1) / (p + u), F.lit(1 - 1e-9))
    surprise = (F.col("a") / p - F.col("b") / u) / F.sqrt(both * (1 - both) * (1 / p + 1 / u))
    names = sorted(r[0] for r in seen.where(F.col("a") >= MIN_TEXTS).where(surprise >= SURPRISE).select("f").collect())
    number = {name: i for i, name in enumerate(names)}

    def cells(batches):
        for batch in small_batches(batches):
            out = []
            for features_, counts, scale in zip(*(c.to_pylist() for c in batch.columns)):
                found = [(number[f], n * scale) for f, n in zip(features_, counts) if f in number]
                out.append(([i for i, _ in found], [v for _, v in found]))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.list_(pa.int32())), pa.array([o[1] for o in out], pa.list_(pa.float64()))], ["i", "v"])

    def matrix(kind: str) -> Cells:
        rows = sample.where(kind).select("_f", "_n", "_s").mapInArrow(cells, "i array<int>, v array<double>").toArrow()
        index, values = rows.column("i").to_pylist(), rows.column("v").to_pylist()
        texts_ = np.repeat(np.arange(len(index)), [len(i) for i in index])
        return texts_, np.array([x for i in index for x in i], np.int64), np.array([x for v in values for x in v], float)

    return fit(names, matrix("_p"), p, matrix("not _p"), u, prior)


_EMPTY = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _featured(texts: DataFrame) -> DataFrame:
    """``(_k, _p, _d, _f, _n, _s)``: key, kind, a digest of the features, the features, their counts and scale."""

    def count(batches):
        for batch in small_batches(batches):
            found = [features(t) for t in batch.column(2).to_pylist()]
            digests = [hashlib.md5("\n".join(sorted(f)).encode()).digest() for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2], pa.array(digests, pa.binary()), pa.array([list(f) for f, _ in found], pa.list_(pa.string())),
                    pa.array([list(f.values()) for f, _ in found], pa.list_(pa.int32())), pa.array([s for _, s in found], pa.float64()),
                ],
                ["_k", "_p", "_d", "_f", "_n", "_s"],
            )

    chosen = texts.select("_k", "_p", "_x")
    more = T.StructType().add("_d", "binary").add("_f", T.ArrayType(T.StringType())).add("_n", T.ArrayType(T.IntegerType())).add("_s", "double")
    return chosen.mapInArrow(count, T.StructType([*chosen.schema.fields[:2], *more.fields]))


def score_column(model: Model, text: Column) -> Column:
    def compute(texts):
        import pandas as pd

        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return F.pandas_udf(compute, T.DoubleType())(text)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts get the score of a text without words. Repeated rows are scored each; a null key is not
    held out unless crc32 of the empty string says so. Empty tables give no rows or, without labels, low scores.
    """
    model = train(docs, labels, key, text)
    scored = docs.select(F.col(key), (~learnable(F.col(key))).alias("held_out"), score_column(model, F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
