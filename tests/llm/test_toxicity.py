import random
import zlib

from tickerloom.llm import toxicity


def rows(n=500, seed=2):
    rng = random.Random(seed)
    clean = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(150)]
    bad = ["vilexa", "vilexo", "vilexu", "grumk", "zlurb"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        words = [rng.choice(clean) for _ in range(rng.randint(5, 60))]
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_contract(spark, frame):
    docs, labels = rows()
    docs += [(None, None), (1000, ""), (1001, "\n"), (4, docs[4][1]), (1002, "x " * 50_000)]
    table = spark.createDataFrame([*labels, (7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(frame(docs), table).collect()
    assert len(got) == len(docs)
    right = 0
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 500]
    for r in held:
        right += r.predicted == int(r.doc_id % 6 == 0)
    assert right / len(held) > 0.97
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)


def test_held_out_labels_are_not_read(spark, frame):
    docs, labels = rows(200)
    turned = [(k, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, t in labels]
    score = lambda l: sorted((r.doc_id, r.score) for r in toxicity.score_documents(frame(docs), spark.createDataFrame(l, "doc_id long, toxic int")).collect())
    assert score(labels) == score(turned)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(frame([]), none).count() == 0
    assert [r.predicted for r in toxicity.score_documents(frame([(1, "a")]), none).collect()] == [0]
