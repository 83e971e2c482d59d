import zlib

from tickerloom.llm import sharding


def rows():
    out = [(i, f"text {i}") for i in range(150)]
    out += [(1000 + i, f"copy {i // 3}") for i in range(60)]
    out += [(2000 + i, "hot") for i in range(100)]
    return [*out, (None, None), (None, ""), (5, "text 5"), (5, "text 5"), (9, "é" * 5000)]


def test_law_slots_and_links(frame):
    docs = rows()
    assigned = sharding.assign(frame(docs))
    got = assigned.toPandas()
    assert sorted(zip(got["size"], got.text_crc32)) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in docs)
    sizes = got.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert set(got.law) == {"rows"} and got.grown_shard.isna().all()
    copies = got[got.text_md5.map(got.groupby("text_md5").size()) == 3]
    assert (copies.groupby("text_md5").shard.nunique() == 1).mean() > 0.9
    hot = got[got["size"] == 4]
    assert hot.shard.nunique() <= 8  # 100 rows need five shards of 20
    cut = sharding.cut_links(assigned).first()
    assert cut.cut < 0.5 * cut.links


def test_small_tables(frame):
    assert sharding.assign(frame([])).count() == 0
    one = sharding.assign(frame([(1, "a")])).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]
    assert {r.shard for r in sharding.assign(frame([(1, "a"), (2, "b"), (3, "c")])).collect()} == {0, 1, 2}
