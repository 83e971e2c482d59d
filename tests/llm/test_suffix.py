import collections
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tickerloom.llm import common, suffix


def plain(texts, length=200):
    places = {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            places.setdefault(b[p : p + length], []).append((i, p))
    covered = [bytearray(len((t or "").encode())) for t in texts]
    for found in places.values():
        for i, p in found if len(found) > 1 else ():
            covered[i][p : p + length] = b"\1" * length
    out = []
    for t, c in zip(texts, covered):
        b = (t or "").encode()
        out.append((bytes(x for x, gone in zip(b, c) if not gone), sum(c), sum(1 for k in range(len(c)) if c[k] and not (k and c[k - 1]))))
    return out


def texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(60) for _ in range(3)] + [text(38)]
    out = [None, "", "x" * 3000, "ab" * 900, "word " * 500, "\x00" * 450]
    for _ in range(40):
        t = text(rng.randint(0, 100))
        for _ in range(rng.randint(0, 3)):
            t += rng.choice(["", "\n", " "]) + rng.choice(passages)[rng.randint(0, 20) :] + text(rng.randint(0, 60))
        out.append(t)
    out += [out[10], out[10], out[20][:90] + "Z" + out[20][90:]] + [text(5) + passages[0] + text(20) for _ in range(60)]
    return out


@pytest.mark.parametrize("bucket", [40_000, 40])  # 40: hot passages are cut by many partition boundaries
def test_equals_brute_force(frame, bucket):
    rows = texts(bucket)
    df = frame([(None if i % 9 == 0 else i % 50, t) for i, t in enumerate(rows)])  # equal and null keys
    got = suffix.remove_repeats(df, bucket=bucket)
    assert got.columns[: len(df.columns)] == df.columns
    found = sorted((r.text or "", bytes(r._kept), r._n_removed, r._n_spans) for r in got.select("text", "_kept", "_n_removed", "_n_spans").collect())
    assert found == sorted((t or "", *w) for t, w in zip(rows, plain(rows)))


def test_a_passage_of_all_rows_is_spread_over_partitions(frame, monkeypatch):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(900)
    rows = [text(rng.randint(30, 120)) + passage + text(rng.randint(30, 120)) for _ in range(300)]
    rows += [rows[0]] * 100 + [text(500)]  # copies with one key
    df = frame([(0 if i >= 300 else i, t) for i, t in enumerate(rows)])
    dealt, kind = [], type(df)
    deal = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda *a: dealt.append(deal(*a)) or dealt[-1])
    monkeypatch.setattr(suffix, "discard", lambda stored: None)  # the deal is counted below
    got = suffix.remove_repeats(df, bucket=40)
    found = sorted((r.text, bytes(r._kept), r._n_removed, r._n_spans) for r in got.select("text", "_kept", "_n_removed", "_n_spans").collect())
    assert found == sorted((t, *w) for t, w in zip(rows, plain(rows)))
    sizes = [r["count"] for r in dealt[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 2000 and max(sizes) < 200


def test_full_bit_tables_change_nothing(frame):
    rows = texts(40_000)
    got = suffix.remove_repeats(frame(list(enumerate(rows))), bits=2)
    found = sorted((r.text or "", bytes(r._kept), r._n_removed, r._n_spans) for r in got.select("text", "_kept", "_n_removed", "_n_spans").collect())
    assert found == sorted((t or "", *w) for t, w in zip(rows, plain([t or "" for t in rows])))


def test_empty_and_short_tables(frame):
    assert suffix.remove_repeats(frame([])).count() == 0
    (row,) = suffix.remove_repeats(frame([(1, "short")])).collect()
    assert bytes(row._kept) == b"short" and row._n_removed == 0


def test_multikey_order():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 21)).astype(np.uint8)
    order = suffix.multikey_order(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_equal_strings_hold_equal_sync_points():
    rng = random.Random(5)
    a, b, shared = (bytes(rng.choice(b"abcd ") for _ in range(n)) for n in (300, 150, 200))
    points = []
    for text, at in ((a + shared + b, 300), (b + shared + a, 150)):
        points.append({p - at for p in suffix.sync_points(text)[0].tolist() if at <= p <= at + 168})
    assert points[0] & points[1]


def test_tasks_give_freed_memory_back():
    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

    pins = []

    def rows():
        held = [np.ones(2000) for _ in range(10_000)]  # 160 MB in pieces of the heap
        pins.append([np.ones(2000) for _ in range(10)])  # behind them, so that the heap does not shrink by itself
        yield len(held)

    before = resident()
    assert list(common.released(rows())) == [10_000]
    assert resident() - before < 60


def test_strings_across_partitions():
    rng = np.random.default_rng(2)
    blobs = []
    for part in range(4):
        some = np.zeros(500, suffix._DIGEST)
        for name, most in (("h", 300), ("h2", 3), ("tid", 20), ("at", 50), ("d", 5)):
            some[name] = rng.integers(0, most, 500)
        some["n"] = part % 2
        blobs.append(some)
    rows = pa.table({"_part": pa.array([0] * 5, pa.int32()), "_open": pa.array([b.tobytes() for b in blobs] + [b""], pa.binary())})
    seen = collections.Counter((r["h"], r["h2"]) for b in blobs for r in b)
    want = {(r["tid"], r["n"], r["at"] - r["d"]) for b in blobs for r in b if seen[r["h"], r["h2"]] > 1}
    got = suffix._across(rows, 200)
    assert got.column_names == ["_tid", "_n", "_from", "_to"] and got.schema.types == [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    assert [tuple(r.values()) for r in got.to_pylist()] == [(t, n, a, a + 200) for t, n, a in sorted(want)]
