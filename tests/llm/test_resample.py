import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from tickerloom.llm import resample

PATTERN = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, grams=1):
    words = PATTERN.findall(re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    return words, [b" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=10, least=20, buckets=10_000, grams=1):
    def counts(rows):
        out = [0] * buckets
        for _, text in rows:
            for f in plain_features(text, grams)[1]:
                out[zlib.crc32(f) % buckets] += 1
        return out

    s, t = counts(docs), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for key, text in docs:
        words, found = plain_features(text, grams)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["Été", "ñ", "A", "a", "X-y"]
    text = lambda k, low=0: " ".join(rng.choice(vocab[low:]) for _ in range(k))
    docs = [(i, text(rng.choice([0, 5, 19, 20, 21, 80, 400]), rng.choice([0, 100]))) for i in range(n)]
    docs += [(500, None), (501, ""), (502, "..."), (None, text(30)), (None, text(25)), (7, docs[7][1]), (503, "same " * 5000)]
    return docs, [(i, text(30, 100)) for i in range(20)]


def check(frame, docs, target, **how):
    rows = resample.resample(frame(docs), frame(target), **how).collect()
    every, drawn = brute(docs, target, how.get("percent", 10), how.get("least_words", 20), how.get("buckets", 10_000), how.get("grams", 1))
    assert sorted((list(r)[:5] for r in rows), key=repr) == sorted(every, key=repr)
    got = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in got] == [(r[0], r[4]) for r in drawn]


def test_equals_brute_force(frame):
    check(frame, *corpus())


@pytest.mark.parametrize("how", [{"percent": 100}, {"buckets": 97, "grams": 3, "percent": 37}, {"least_words": 0, "percent": 50}])
def test_other_settings(frame, how):
    check(frame, *corpus(120, 2), **how)


def test_a_third_of_all_rows_alike(frame):
    docs, target = corpus(100, 3)
    check(frame, docs + [(9, "one two three " * 10)] * 50 + [(None, "x " * 30)] * 50, target, percent=90)


def test_empty_tables(frame):
    assert resample.resample(frame([]), frame([(1, "a")])).count() == 0
    check(frame, [(1, "a b"), (2, "c " * 30)], [], percent=100)


def test_planes_are_exact():
    rng = np.random.default_rng(4)
    for low, high in ((-5, 6), (0, 1), (-8, 8), (-30_000, 20_000), (3, 9), (-9, -3)):
        gain = rng.integers(low, high, 130)
        counts = rng.integers(0, 70_000, (6, 130)) * (rng.random((6, 130)) < 0.3)
        counts[2] = 0
        row, bucket = np.nonzero(counts)
        got = resample.plane_sums(row, bucket, counts[row, bucket], 6, 130, *resample.gain_planes(gain))
        assert got.tolist() == (counts @ gain).tolist()


def test_pieces_keep_runs(monkeypatch):
    text = "Some WORDS that, cross--pieces; é ü 12 ".encode() * 40
    want = plain_features(text.decode(), 4)
    for size in (1, 7, 64):
        monkeypatch.setattr(resample, "_PIECE", size)
        pieces = list(resample.features(text, 4))
        assert sum(n for n, _ in pieces) == len(want[0])
        assert sorted(f for _, found in pieces for f in found) == sorted(want[1])


def test_very_long_text(frame):
    check(frame, [(1, "alpha Beta " * 200_000), (2, "gamma " * 40)], [(1, "beta")], percent=100)
