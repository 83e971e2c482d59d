import random
import zlib

import numpy as np
import pytest
from tickerloom.llm import packing


def best_fit(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(window - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 16, 64])
    lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 150))]
    counts = {n: lengths.count(n) for n in lengths}
    runs, windows = packing.plan(counts, window)
    filled = {}
    for length, _, n, first, offset in runs:
        for i in range(n):
            filled.setdefault(first + i, []).append((offset, length))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert len(filled) == windows
    assert sorted(window - sum(n for _, n in p) for p in filled.values()) == best_fit(lengths, window)


def test_plan_work_does_not_grow_with_counts():
    runs, _ = packing.plan({n: 10**12 + n for n in range(1, 1025)})
    assert len(runs) < 10_000


def test_pack_documents(frame, ranks):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "of", "x9", "é!"]) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "no key"), (3, "twice"), (3, "twice"), (502, "long " * 3000)]
    got = packing.pack_documents(frame(rows), ranks, window=64).toPandas()
    encode = packing.Encoder(ranks)
    want = []
    for k, t in rows:
        ids = encode(t or "") + b"\0\0\0\0"
        for start in range(0, len(ids) // 4, 64):
            part = ids[4 * start : 4 * start + 256]
            want.append((str(k), start, len(part) // 4, zlib.crc32(part), len(ids) // 4))
    keys = ["start", "length", "ids_crc32", "doc_tokens"]
    ids = ["None" if np.isnan(k) else str(int(k)) for k in got.doc_id]
    assert sorted(zip(ids, *(got[c].tolist() for c in keys))) == sorted(want)
    for _, rows_ in got.groupby("sequence_id"):
        at = 0
        for offset, length in sorted(zip(rows_.offset, rows_.length)):
            assert offset == at
            at += length
        assert at <= 64
    assert got.sequence_id.nunique() == len(best_fit([w[2] for w in want], 64)) == got.sequence_id.max() + 1


def test_empty_table(frame, ranks):
    assert packing.pack_documents(frame([]), ranks).count() == 0
