import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tickerloom.functions import signatures
from tickerloom.functions import text as tx
from tickerloom.operators import dedup
from tickerloom.plans import corpus
from tickerloom.session import materialize
from tickerloom.sources.standins import Tables


def plain(shingles, permutations):
    return [min(hashlib.md5((s + str(k)).encode()).hexdigest() for s in shingles) if shingles else "0" * 32 for k in range(permutations)]


def test_equal_to_the_library(monkeypatch):
    rng = random.Random(1)
    texts = [["".join(rng.choice("abé 中") for _ in range(rng.randint(0, 80))) for _ in range(rng.randint(0, 60))] for _ in range(30)]
    texts += [[], [""], ["x" * 5000], ["y" * n for n in range(70)]]
    for lanes in (7, 64, 1 << 13):
        monkeypatch.setattr(signatures, "LANES", lanes)
        assert list(signatures.signatures(texts, 128)) == [plain(t, 128) for t in texts]
    assert list(signatures.signatures(texts[:3], 1002)) == [plain(t, 1002) for t in texts[:3]]


def test_column(spark):
    rows = [(0, ["a b c", "b c d"]), (1, []), (2, None)]
    frame = spark.createDataFrame(rows, "i int, g array<string>")
    got = [r.s for r in frame.orderBy("i").select(tx.minhash(F.col("g"), 5).alias("s")).collect()]
    assert got == [plain(rows[0][1], 5), plain([], 5), None]


def test_each_signature_is_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def cut(text):
        @F.pandas_udf("array<string>")
        def count(texts: pd.Series) -> pd.Series:
            calls.add(len(texts))
            return texts.str.split()

        return count(text)

    items = spark.createDataFrame([(i, f"doc number {i} of some words", "t") for i in range(20)], "original_index long, doc string, title string")
    store = dedup.SignatureStore(dedup.among(items), cut)
    ids = lambda *r: spark.range(*r).withColumnRenamed("id", "original_index")
    for wanted, seen in ((ids(0, 8), 8), (ids(4, 12), 12), (ids(0, 12), 12), (ids(11, 13), 13)):
        got = store.of(wanted).collect()
        assert len(got) == wanted.count() and calls.value == seen
    assert next(r for r in got if r.original_index == 12).sig == plain(["doc number 12", "number 12 of", "12 of some", "of some words"], 128)


def test_shared_shingles_are_hashed_once(monkeypatch):
    seen = []

    class Counted(signatures.Digests):
        def __init__(self, shingles, permutations):
            seen.extend(shingles)
            super().__init__(shingles, permutations)

    monkeypatch.setattr(signatures, "Digests", Counted)
    texts = [["a b c", "b c d", "x" * 60], [], ["b c d", "x" * 60], ["a b c"]]
    assert list(signatures.signatures(texts, 16)) == [plain(t, 16) for t in texts]
    assert len(seen) == len(set(seen)) == 3


def test_equal_first_words_are_told_apart_by_the_rest():
    class Found:
        def salted(self, salt):
            return np.array([7, 7, 9, 7], np.uint32)

        def whole(self, salt, lanes):
            return np.array([[7, 5], [7, 3], [9, 0], [6, 9]], np.uint64)[lanes]

    starts, sizes = np.array([0, 3]), np.array([3, 2])
    got = signatures._least(Found(), 0, np.array([0, 1, 2, 3, 2]), starts, sizes)
    assert got.tolist() == [[7, 3], [6, 9]]


def test_packed_signatures_hold_the_same_digests(spark):
    texts = ["", "one", "one two", "a b c d e", "a b c d f", "股票市场 分析 报告 abc", "x" * 90 + " y z z y", "a b c a b c a b c", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1)
    rows = frame.select("i", tx.packed_minhash(F.col("t")).alias("sig"), F.explode(F.array(tx.shingles(F.col("t")))).alias("g"))
    rows = rows.select("i", "sig", "g", tx.packed_grams(F.col("g")).alias("own"), tx.unpacked(F.col("sig")).alias("hex")).orderBy("i").collect()
    for r, text in zip(rows, texts):
        if text is None:
            assert r.sig is None
            continue
        assert r.g == tx.word_shingles(text)
        assert r.hex == plain(r.g, 128) and r.sig == r.own == bytes.fromhex("".join(r.hex))
    pairs = spark.createDataFrame([(a.i, b.i, a.sig, b.sig, a.hex, b.hex) for a in rows for b in rows], "a long, b long, x binary, y binary, p array<string>, q array<string>")
    got = pairs.select(tx.equal_places(F.col("x"), F.col("y")).alias("n"), "x", "y", tx.equal_positions(F.col("p"), F.col("q")).alias("m")).collect()
    assert all(r.n is None if r.x is None or r.y is None else r.n == r.m for r in got) and any(0 < (r.n or 0) < 128 for r in got)


@pytest.mark.parametrize("name", ["content_overlap", "minhash_jaccard"])
def test_pairs_move_packed_signatures_and_no_texts(spark, sf_dir, monkeypatch, name):
    stored = {}
    monkeypatch.setattr(corpus, "materialize", lambda df, label: stored.setdefault(label, materialize(df, label)))
    getattr(corpus, name)(Tables(spark, sf_dir))
    assert {label: dict(df.dtypes) for label, df in stored.items()} == {"minhash": {"original_index": "bigint", "title2": "string", "sig": "binary"}}
