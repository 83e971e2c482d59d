"""Near-duplicate removal against the serial rule, with crowds, chains and few leaders per key."""

import random

import pytest
from plain_dedup import Item, duplicates, normalize, serial_kept
from pyspark.sql import functions as F
from tickerloom.functions import text as tx
from tickerloom.operators import dedup, news

SCHEMA = "original_index long, title string, doc string"
VOCABULARY = [f"w{i}x{i * 7 % 13}" for i in range(400)]


def corpus(seed, groups, crowd=0):
    """Groups of edited copies, a crowd of near-copies of one text, and unrelated items."""
    rng = random.Random(seed)
    rows = []

    def text(n):
        return [rng.choice(VOCABULARY) for _ in range(n)]

    def edited(base, n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(VOCABULARY)
        return out

    for _ in range(groups):
        base, title = text(rng.choice([2, 40, 160, 300])), text(rng.randint(2, 8))
        for _ in range(rng.randint(1, 5)):
            base = edited(base, rng.randint(0, 2)) if rng.random() < 0.7 else base
            shown = edited(title, 1) if rng.random() < 0.3 else title
            rows.append((" ".join(shown) if rng.random() > 0.1 else "", " ".join(base)))
    base, title = text(250), text(7)
    for _ in range(crowd):
        shown = edited(title, 1) if rng.random() < 0.3 else title
        rows.append((" ".join(shown), " ".join(edited(base, rng.randint(0, 1)))))
    rows += [("A", "one letter title"), ("A", "one letter title"), ("", ""), ("", "x"), ("分析报告 二零", "股票 市场 分析 报告"), ("分析报告 二零", "股票 市场 分析 报告")]
    rng.shuffle(rows)
    return [(i, normalize(t), normalize(d)) for i, (t, d) in enumerate(rows) if normalize(d)]


@pytest.mark.parametrize("seed,groups,crowd,leaders", [(1, 40, 0, 64), (2, 25, 60, 1), (3, 25, 80, 2), (4, 40, 40, 3)])
def test_same_as_serial_rule(spark, seed, groups, crowd, leaders):
    rows = corpus(seed, groups, crowd)
    kept, lost = serial_kept(rows)
    items = spark.createDataFrame(rows, SCHEMA)
    outcome = dedup.deduplicate(items, leaders=leaders, with_matches=True)
    dropped = {r.original_index for r in outcome.dropped.collect()}
    assert {r[0] for r in rows} - dropped == kept
    assert {r.original_index: r.duplicate_of for r in outcome.matches.collect()} == lost
    if leaders < 3:
        assert outcome.rounds > 1  # the crowd is larger than the leaders of a key
    if crowd:
        assert len(lost) > crowd // 2


def test_matches_do_not_change_the_outcome(spark):
    rows = corpus(5, 20, 50)
    items = spark.createDataFrame(rows, SCHEMA)
    plain = {r[0] for r in dedup.deduplicate(items, leaders=2).dropped.collect()}
    matched = {r[0] for r in dedup.deduplicate(items, leaders=2, with_matches=True).dropped.collect()}
    assert plain == matched


def test_duplicates_always_share_a_key(spark):
    rows = corpus(6, 50, 30)
    items = [Item(*r) for r in rows]
    keyed = dedup.compared(spark.createDataFrame(rows, SCHEMA)).select(
        "original_index", dedup.candidate_keys(F.col("simhash"), F.col("counts")).alias("keys")
    )
    keys = {r.original_index: set(r["keys"]) for r in keyed.collect()}
    pairs = [(a.index, b.index) for a in items for b in items if a.index < b.index and duplicates(a, b)]
    assert len(pairs) > 50
    assert all(keys[a] & keys[b] for a, b in pairs)


def test_settle_equals_serial_scan_on_random_graphs(spark):
    rng = random.Random(7)
    edges, expected, offset = [], set(), 0
    for _ in range(30):
        n = 14
        own = [(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.18]
        kept = []
        for v in range(n):
            if not any((k, v) in own for k in kept):
                kept.append(v)
        edges += [(offset + a, offset + b) for a, b in own]
        expected |= {offset + v for v in kept}
        offset += n
    nodes = spark.range(offset).withColumnRenamed("id", "original_index")
    kept, dropped = dedup.settle(nodes, spark.createDataFrame(edges, "a long, b long"))
    assert {r[0] for r in kept.collect()} == expected
    assert {r[0] for r in dropped.collect()} == set(range(offset)) - expected


def test_chain_keeps_both_ends(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "a long, b long")
    kept, _ = dedup.settle(spark.range(4).withColumnRenamed("id", "original_index"), edges)
    assert sorted(r[0] for r in kept.collect()) == [0, 2]


def test_stats(spark):
    items = spark.createDataFrame([(i, "t t", "d") for i in range(5)], SCHEMA)
    row = dedup.dedup_stats(items, items.where("original_index > 2").select("original_index")).first()
    assert (row.original, row.duplicates, row.kept) == (5, 2, 3)


def test_news_items_fallbacks(spark):
    schema = "original_index long, Date string, Article_title string, Stock_symbol string, Article string, Textrank_summary string, risk_deepseek double"
    rows = [
        (0, None, None, "AAPL", None, "summary text", 3.0),
        (1, "2020-01-01", "Title", None, "ＦＵＬＬ　ｗｉｄｔｈ café a – b", None, None),
        (2, None, "t", "X", " ", None, 1.0),
        (3, None, "t", "X", "–", None, 1.0),
    ]
    got = {r.original_index: r for r in news.news_items(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {0, 1}
    assert (got[0].doc, got[0].title, got[0].labels, got[0].date) == ("summary text", "AAPL", "risk_score:3.0", "")
    assert (got[1].doc, got[1].stock_symbol, got[1].labels) == ("FULL width caf a  b", "", "")


@pytest.mark.parametrize(
    "raw",
    ["a – b", " x y　", "ﬁne ½ ™ …", "line\x1cbreak\x85next end", "é café", "分析 报告，", "", "  ", "Ⅷ ⑧ ㎏", "tab\t\r\n"],
)
def test_normalize_equals_python(spark, raw):
    got = spark.createDataFrame([(raw,)], "t string").select(tx.normalize(F.col("t")).alias("x")).first().x
    assert got == normalize(raw)


def test_segmenter_words_emit_spaces(spark):
    df = spark.createDataFrame([("Up 3.5 now... ok,分析师",)], "t string")
    assert df.select(tx.segmenter_words(F.col("t")).alias("w")).first().w == ["Up", " ", "3.5", " ", "now", "...", " ", "ok", ",", "分析", "师"]


def test_crowd_of_different_texts_forms_no_pairs(spark, monkeypatch):
    """One title and the same words in other order: equal SimHash and title, different shingles."""
    rng = random.Random(6)
    words = [rng.choice(VOCABULARY) for _ in range(60)]
    rows = [(i, "one title for all", normalize(" ".join(rng.sample(words, len(words))))) for i in range(300)]
    kept, _ = serial_kept(rows)
    compared = []
    stored = dedup.materialize

    def counted(df, label):
        out = stored(df, label)
        if label == "titles":
            compared.append(out.count())
        return out

    monkeypatch.setattr(dedup, "materialize", counted)
    outcome = dedup.deduplicate(spark.createDataFrame(rows, SCHEMA))
    assert {r[0] for r in rows} - {r.original_index for r in outcome.dropped.collect()} == kept
    assert sum(compared) < len(rows)


def test_discarded_tables_are_gone(spark):
    import pathlib

    from tickerloom.session import discard, materialize

    kept = materialize(spark.range(3), "kept")
    gone = materialize(kept.selectExpr("id + 1 AS id"), "gone")
    assert gone.count() == 3
    discard(gone)
    assert not pathlib.Path(gone.scratch).exists() and kept.count() == 3


@pytest.mark.parametrize("leaders", [1, 4, 64])
def test_title_tokens_are_keys_of_crowds_only(spark, leaders):
    rows = corpus(8, 40, 70)
    nodes = dedup.compared(spark.createDataFrame(rows, SCHEMA)).where(F.size("counts") > 0).localCheckpoint()
    keyed = dedup.key_rows(nodes, leaders).collect()
    keys, n_keys = {}, {r.original_index: r.n_keys for r in keyed}
    for r in keyed:
        keys.setdefault(r.original_index, []).append((r["pick"], r.key))
    assert all(len(keys[i]) == n for i, n in n_keys.items()) and len(keys) == nodes.count()
    picks = len(dedup.block_masks())
    blocks = dedup.block_masks()
    hashes = {r.original_index: r.simhash for r in nodes.select("original_index", "simhash").collect()}
    lonely = [i for i, h in hashes.items() if all(sum(h & m == other & m for other in hashes.values()) <= leaders for m in blocks)]
    assert lonely and all(n_keys[i] == picks for i in lonely)
    items = [Item(*r) for r in rows]
    pairs = [(a.index, b.index) for a in items for b in items if a.index < b.index and a.index in keys and b.index in keys and duplicates(a, b)]
    assert len(pairs) > 50 and all(set(keys[a]) & set(keys[b]) for a, b in pairs)


def test_tables_of_the_search_are_gone(spark, monkeypatch):
    import pathlib

    stored, original = [], dedup.materialize

    def noted(df, label):
        stored.append((label, original(df, label)))
        return stored[-1][1]

    monkeypatch.setattr(dedup, "materialize", noted)
    rows = corpus(9, 20, 30)
    outcome = dedup.deduplicate(spark.createDataFrame(rows, SCHEMA), with_matches=True)
    there = {label for label, df in stored if pathlib.Path(df.scratch).exists()}
    assert not there & {"leaders", "minhash", "wanted"} and "searchable" in there
    kept, lost = serial_kept(rows)
    assert {r.original_index: r.duplicate_of for r in outcome.matches.collect()} == lost
    assert {r[0] for r in rows} - {r.original_index for r in outcome.dropped.collect()} == kept
