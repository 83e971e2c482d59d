import hashlib
import random
import time

import plain_dedup
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tickerloom.functions import text as tx
from tickerloom.operators import dedup, news

NEWS = "original_index long, Article string, Textrank_summary string, Article_title string, Stock_symbol string, risk_deepseek double, Date string"


def test_words_of_a_batch_are_hashed_once(monkeypatch):
    seen, md5 = [], hashlib.md5
    monkeypatch.setattr(tx.hashlib, "md5", lambda data: seen.append(data) or md5(data))
    lists = [["a", "b", "b"], None, [], ["b", "c"], ["x", "y", "y"] * 20_000]
    got = tx.simhashes(pa.array([["left", "out"], *lists])[1:]).to_pylist()
    assert sorted(seen) == [b"a", b"b", b"c", b"x", b"y"]

    def plain(words):
        hashes = [int.from_bytes(md5(w.encode()).digest()[8:], "big") for w in words]
        value = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
        return value - (1 << 64) if value >> 63 else value

    assert got == [None if w is None else plain(w) for w in lists]


def test_long_titles_are_matched_by_hash(spark):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(" ".join(words), " ".join(words[30_000:] + [f"v{i}" for i in range(30_000)]))]
    counts = spark.createDataFrame(rows, "a string, b string").select(tx.term_counts(F.col("a")).alias("a"), tx.term_counts(F.col("b")).alias("b")).cache()
    counts.count()
    began = time.monotonic()
    got = counts.select(tx.tfidf_cosine(F.col("a"), F.col("b")).alias("c")).first().c
    assert got == pytest.approx(1 / (1 + tx.SINGLE_IDF**2), rel=1e-12)
    assert time.monotonic() - began < 8  # looked up one by one it takes minutes


def test_similar_titles_near_and_far(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 6))) for _ in range(40)]
    pairs = [("a", "a"), ("a b", ""), ("x y", "y x")]
    for _ in range(150):
        a = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 8, 60]))]
        b = list(a)
        for _ in range(rng.choice([0, 1, 2, 5, 20])):
            b[rng.randrange(len(b))] = rng.choice(vocabulary)
        pairs.append((" ".join(a), " ".join(b)))
    nodes = spark.createDataFrame([(2 * i + side, p[side]) for i, p in enumerate(pairs) for side in (0, 1)], "original_index long, title2 string")
    ids = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(len(pairs))], "a long, b long")
    got = {r.a // 2 for r in dedup.similar_titles(ids, nodes.withColumn("counts", tx.term_counts(F.col("title2")))).collect()}
    assert got == {i for i, (a, b) in enumerate(pairs) if a == b or (plain_dedup.edit(a, b) + plain_dedup.cosine(a, b)) / 2 > 0.8}


def test_titles_alone_leave_texts_unread(spark, monkeypatch):
    rng = random.Random(3)
    some = lambda: rng.choice([None, "", " ", "\u2014", "\u2014 \u2014", "a", "\u00e1", "a\u0301 b", "a\u0301", "\ufb01", "ab c", "".join(rng.choice("ab1 .\u4e2d\n\x85\u2014\u0301") for _ in range(5))])
    rows = [(i if i % 50 else None, some(), some(), some(), some(), None, None) for i in range(600)]
    table = spark.createDataFrame([*rows, (-1, "text " * 5000, None, "title here", None, None, None)], NEWS)
    listed = lambda df: sorted((r.original_index or 0, r.title2, sorted(r.counts.items())) for r in df.select("original_index", "title2", "counts").collect())
    full = listed(dedup.compared(news.news_items(table)))

    read, normalize = spark.sparkContext.accumulator(0), news.normalize

    def counted(text):
        @F.pandas_udf("string")
        def count(values):
            read.add(int(values.str.len().fillna(0).sum()))
            return values

        return normalize(count(text))

    monkeypatch.setattr(news, "normalize", counted)
    assert listed(dedup.compared_titles(news.titled_items(table))) == full
    assert 0 < read.value < 25_000


def test_simhash_of_a_text_is_that_of_its_words(spark):
    texts = ["", "one", "a b, c! 3.5 股票市场分析 x", "w " * 600 + "v", None, "up " * 255, "q r " * 40000]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = frame.select(tx.text_simhash(F.col("t")).alias("a"), tx.simhash(tx.words(F.col("t"))).alias("b"), tx.text_simhash(F.col("t"), tx.segmenter_words).alias("c"), tx.simhash(tx.segmenter_words(F.col("t"))).alias("d")).collect()
    assert all(r.a == r.b and r.c == r.d for r in got) and got[0].a == 0 and got[4].a is None
    plan = frame.select(tx.text_simhash(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # words are cut where they are hashed


def test_items_are_spread_with_the_one_text_that_is_used(spark):
    schema = "original_index long, Date string, Article_title string, Stock_symbol string, Article string, Textrank_summary string, risk_deepseek double"
    rows = spark.createDataFrame([(i, None, f"t {i}", "S", None if i % 3 else "an article", "a summary", None) for i in range(60)], schema).coalesce(1)
    spread = news.news_items(rows, spread=True)
    assert spread.rdd.getNumPartitions() > 1
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, news.news_items(rows).collect()))
