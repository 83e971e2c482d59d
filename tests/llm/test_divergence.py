import random
import re
from collections import Counter, defaultdict

import pytest
from tickerloom.llm import divergence

PATTERN = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SCHEMA = "lang string, source string, text string, term string, n long, part string, rank int, no int"


def terms(text):
    return [re.sub(rb"[A-Z]", lambda m: m.group().lower(), t).decode() for t in PATTERN.findall((text or "").encode())]


def brute(docs, least=30, top=50):
    groups, seen, times = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source, found = lang or "", source or "", terms(text)
        groups[lang, source].update(found)
        seen[lang].update(set(found))
        times[lang].update(found)
    kept = {lang: [t for t, d in seen[lang].items() if d >= least] for lang, _ in groups}

    def shares(count, lang):
        n, v = sum(count[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 1000000000 * (count[t] + 5) // (n + 5 * v) for t in kept[lang]}

    p = {g: shares(c, g[0]) for g, c in groups.items()}
    q = {lang: shares(times[lang], lang) for lang in kept}
    out = []
    for lang, source in groups:
        pairs = [(b, sum(abs(p[lang, source][t] - p[lang, b][t]) for t in kept[lang])) for other, b in groups if other == lang and b != source]
        over = [(t, p[lang, source][t] - q[lang][t]) for t in kept[lang] if groups[lang, source][t] and p[lang, source][t] > q[lang][t]]
        for part, rows, most in (("pair", pairs, len(pairs)), ("term", over, top)):
            ordered = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]
            out += [(lang, source, part, item, value, i) for i, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    vocab = ["the", "The", "Ärger", "ärger", "é", "don't", "x2y", "rare"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(10)]
    docs = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", "en"]), rng.choice(["a", "b", "b", "c", "é"])
        low = rng.choice([0, 20]) if source == "b" else 0
        docs.append((lang, source, " ".join(rng.choice(vocab[low:]) for _ in range(rng.choice([0, 3, 40])))))
    docs += [("fr", "a", "un deux"), ("fr", "b", None), ("xx", "only", "alone"), (None, None, "no name"), (None, "z", ""), ("", "", "w " * 3)]
    return docs


@pytest.fixture(scope="module")
def table(spark):
    return lambda docs: spark.createDataFrame([(*d, *[None] * 5) for d in docs], SCHEMA)


def result(found):
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force(table):
    docs = corpus()
    found = divergence.audit(table(docs))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert result(found) == brute(docs)


def test_other_limits_and_many_buckets(table):
    docs = corpus(150, 2)
    assert result(divergence.audit(table(docs), least=2, top=3, bucket=10)) == brute(docs, 2, 3)


def test_many_sources_and_copies(table):
    rng = random.Random(3)
    docs = [("en", f"s{i % 40}", " ".join(rng.choice("abcdefgh") * 2 for _ in range(9))) for i in range(400)] + [("en", "s1", "aa bb copy")] * 200
    assert result(divergence.audit(table(docs))) == brute(docs)


def test_empty_table_and_no_terms(table):
    assert divergence.audit(table([])).count() == 0
    docs = [("en", "a", "x"), ("en", "b", None), ("de", "c", "y")]
    assert result(divergence.audit(table(docs))) == brute(docs) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_full_tables_are_handed_on(table, monkeypatch):
    import pyarrow as pa

    docs = corpus(60, 4)
    batch = pa.RecordBatch.from_arrays([pa.array([d[i] or "" for d in docs]) for i in range(3)], ["lang", "source", "text"])
    sums = []
    for size in (10, 1 << 20):
        monkeypatch.setattr(divergence, "_HELD_TERMS", size)
        total = Counter()
        for b in divergence._counted([batch]):
            for lang, source, term, n, d in zip(*(c.to_pylist() for c in b.columns)):
                total[lang, source, term, "n"] += n
                total[lang, source, term, "d"] += d
        sums.append(total)
    assert sums[0] == sums[1]


def test_long_texts_by_pieces(monkeypatch):
    text = "Alpha beta-beta, 12 é ".encode() * 50
    want = Counter(t.encode() for t in terms(text.decode()))
    for size in (1, 5, 1 << 20):
        monkeypatch.setattr(divergence, "_PIECE", size)
        assert divergence.term_counts(text) == want
