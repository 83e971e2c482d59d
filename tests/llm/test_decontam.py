import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tickerloom.llm import decontam
from tickerloom.llm.decontam import Words

PATTERN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, key string, _win binary"


def words(text):
    return PATTERN.findall(re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))


def brute(docs, items, window=10):
    wins = {}
    for name, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[at : at + window]), set()).add("" if name is None else str(name))
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in wins:
                    names |= wins[tuple(w[at : at + n])]
                    hit |= set(range(at, at + n))
        out.append((key, len(w), sorted(hit), sorted(names, key=str.encode)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(k, t, "x", b"") for k, t in rows], ITEMS)


def result(found):
    return sorted(((r[0], r.n_words, [x for a, b in r.spans for x in range(a, b)], r["items"]) for r in found.collect()), key=repr)


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["The", "of", "Ä", "ñu", "42", "data", "x1", "mid-word", "été"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "\n", ", ", "  ", "\x7f"]) for _ in range(n))
    items = [(i, text(rng.choice([10, 12, 25, 40]))) for i in range(20)]
    items += [(30, "The of"), (31, "data"), (32, "été, X1! 42 data x1"), (33, None), (34, ""), (35, "..."), (30, "of the"), (None, text(11)), (36, items[0][1])]
    docs = [(i, text(rng.choice([0, 1, 3, 9, 10, 60]))) for i in range(40)]
    for i in range(30):
        body = words(items[rng.randrange(20)][1])
        cut = body[rng.randrange(3) : rng.randrange(8, 30)]
        docs.append((100 + i, text(5).upper() + " -- ".join(c.decode() for c in cut) + ". " + text(7)))
    docs += [(200, None), (201, ""), (None, items[3][1]), (100, items[3][1]), (100, items[3][1]), (202, "data"), (203, items[1][1] * 300)]
    return docs, items


def test_equals_brute_force(frame, table):
    docs, items = corpus()
    assert result(decontam.contamination(frame(docs), table(items))) == brute(docs, items)


def test_other_windows(frame, table):
    docs, items = corpus(4)
    for window in (2, 7):
        assert result(decontam.contamination(frame(docs), table(items), window=window)) == brute(docs, items, window)


def test_hot_passage(frame, table):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(i, (f"a{i} {item} b{i % 7}" if i % 3 else f"c{i} clean")) for i in range(900)]
    found = decontam.contamination(frame(docs), table([(i, item) for i in range(50)])).collect()
    assert len(found) == 900
    assert all((len(r["items"]), [tuple(s) for s in r.spans]) == ((50, [(1, 31)]) if r.doc_id % 3 else (0, [])) for r in found)


def test_empty_tables(frame, table):
    assert decontam.contamination(frame([]), table([(1, "a b")])).count() == 0
    rows = decontam.contamination(frame([(1, "a b")]), table([])).collect()
    assert [(r.doc_id, r.n_words, r.spans, r["items"]) for r in rows] == [(1, 2, [], [])]


def test_every_shared_span_has_a_shared_fingerprint():
    rng = random.Random(5)
    a = [rng.choice("abcdefgh").encode() for _ in range(400)]
    x, y = Words([b" ".join(a)]), Words([b"z", b"q q " + b" , ".join(a[100:110]) + b" q"])
    assert x.minima(10, 5)[0][100] == y.minima(10, 5)[0][3]
    assert x.digest(100, 10) == y.digest(3, 10)
    whole = y.minima(10, 5)[1]
    assert not whole[0] and whole[1:].all()  # the first window would begin in another text


def test_long_words_and_pieces(monkeypatch):
    text = b"ab " * 50 + b"c" * 500 + b" ab"
    whole = Words([text]).hashes
    monkeypatch.setattr(decontam, "_PIECE", 64)
    monkeypatch.setattr(decontam, "_UP", decontam._powers(decontam._STEP, 64))
    monkeypatch.setattr(decontam, "_DOWN", decontam._powers(decontam._BACK, 64))
    assert np.array_equal(Words([text]).hashes, whole) and len(set(whole.tolist())) == 2


def test_full_bit_table_changes_nothing(frame, table):
    docs, items = corpus(6)
    for bits in (4, 17):
        assert result(decontam.contamination(frame(docs), table(items), bits=bits)) == brute(docs, items)


def test_text_columns_may_have_any_name(frame, table):
    docs = frame([(1, "a b c d e f g h i j k")]).select(F.col("doc_id").alias("_row"), F.col("text").alias("_text"))
    rows = decontam.contamination(docs, table([(1, "a b c")]), key="_row", text="_text").collect()
    assert rows[0]["_row"] == 1 and [tuple(s) for s in rows[0].spans] == [(0, 3)]
