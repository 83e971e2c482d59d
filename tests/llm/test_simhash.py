import random

import numpy as np
import pytest
import xxhash
from tickerloom.llm import simhash


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_fingerprint_by_definition():
    for text in [None, "", " \n", "One", "a B", "a b c", "a b a b a b", "É \x0b é\xa0x y z", "w " * 70_000 + "end"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_tiles_lose_no_link():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for _ in range(12))]))
    for block in (4096, 16):
        sizes = {}
        for t in simhash.Tiling({}, 3).tile(fps).tolist():
            sizes[t] = sizes.get(t, 0) + 1
        groups, values, own = simhash.dealt(fps, simhash.Tiling(sizes, 3, block, 2 * block))
        edges = []
        for g in np.unique(groups):
            at = groups == g
            assert own[at].sum() <= 4 * block + 8  # hashed blocks are of bounded size, about
            edges += zip(*(x.tolist() for x in simhash.tile_edges(values[at & own], values[at & ~own], 3)))
        parent = {int(p): int(p) for p in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[find(a)] = find(b)
        want = plain_groups([int(p) for p in fps])
        got = {p: find(p) for p in parent}
        assert len(set(zip(got.values(), want.values()))) == len(set(got.values())) == len(set(want.values()))


def documents(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80))) for i in range(30)]
    rows += [(100 + i, rows[i % 5][1].replace(" ", "  ", 3)) for i in range(10)]
    rows += [(200 + i, rows[7][1] + f" tail{i}") for i in range(40)]
    return [*rows, (300, None), (301, ""), (302, "\n "), (None, rows[3][1]), (None, "alone"), (5, rows[5][1]), (5, "other text")]


def test_near_duplicates_equal_brute_force(frame):
    rows = documents()
    got = simhash.near_duplicates(frame(rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    root = plain_groups(prints)
    least = {}
    for (k, _), p in zip(rows, prints):
        if k is not None:
            least[root[p]] = min(k, least.get(root[p], k))
    want = sorted((str(k), f"{p:016x}", str(least.get(root[p]))) for (k, _), p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    small = simhash.components(simhash.fingerprints(frame(rows)), block=4, visitors=8).collect()
    assert {r.fp % 2**64: r.root for r in small}.keys() == {p for p in prints if sum(root[q] == root[p] for q in set(prints)) > 1}


def test_keep_one_keeps_every_group_once(frame):
    rows = documents()
    kept = simhash.keep_one(frame(rows))
    assert kept.columns == frame(rows).columns
    root = plain_groups([plain_fingerprint(t) for _, t in rows])
    roots = [root[plain_fingerprint(r.text)] for r in kept.collect()]
    assert sorted(roots) == sorted(set(root.values()))


def test_empty_table(frame):
    assert simhash.near_duplicates(frame([])).count() == 0 and simhash.keep_one(frame([])).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 5])
def test_other_radii(radius):
    rng = np.random.default_rng(radius)
    fps = np.unique(rng.integers(0, 2**12, 200, dtype=np.uint64) * np.uint64(0x10001))
    sizes = {}
    for t in simhash.Tiling({}, radius).tile(fps).tolist():
        sizes[t] = sizes.get(t, 0) + 1
    groups, values, own = simhash.dealt(fps, simhash.Tiling(sizes, radius))
    met = set()
    for g in np.unique(groups):
        at = groups == g
        met |= {frozenset((int(a), int(b))) for a in values[at & own] for b in values[at]}
    assert all(frozenset((int(a), int(b))) in met for a in fps for b in fps if (int(a) ^ int(b)).bit_count() <= radius)
