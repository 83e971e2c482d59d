import random
from functools import cache
from itertools import product

import pytest
from pyspark.sql import functions as F
from tickerloom.functions import segment
from tickerloom.functions import text as tx


def plain(run, words):
    """Every way to cut a run, the best by cost, number of words, and length of the first words."""
    table = segment.Dictionary(words)
    cost = lambda w: table.costs.get(w) if words.get(w) else (table.unknown if len(w) == 1 else None)

    @cache
    def ways(at):
        if at == len(run):
            return [()]
        return [(run[at:end], *rest) for end in range(at + 1, len(run) + 1) if cost(run[at:end]) is not None for rest in ways(end)]

    return list(min(ways(0), key=lambda way: (sum(map(cost, way)), len(way), [-len(w) for w in way])))


def test_equals_enumeration():
    rng = random.Random(1)
    for turn in range(300):
        letters = "中国人民银行"[: rng.randint(2, 6)]
        pool = ["".join(p) for size in (1, 2, 3, 4) for p in product(letters, repeat=size)]
        words = {w: rng.choice([1, 2, 2, 5, 50, 400]) for w in rng.sample(pool, min(len(pool), rng.randint(0, 30)))}
        table = segment.Dictionary(words)
        for _ in range(8):
            run = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
            assert table.cut(run) == plain(run, words), (run, words)


def test_words_and_unknown_characters(spark):
    given = spark.createDataFrame([("人民", 50), ("中国人民", 2), ("银行", 30), ("中国", 40), ("人民", 5), (None, 9), ("", 9), ("国人", 0)], "word string, n long")
    cut = segment.dictionary_words(segment.dictionary(given))
    texts = ["中国人民银行", "abc 中国x!人山人民", "plain words only.", "", None, "龥一"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.w for r in frame.orderBy("i").select(cut(F.col("t")).alias("w")).collect()]
    assert got == [["中国", "人民", "银行"], ["abc", "中国", "x!", "人", "山", "人民"], ["plain", "words", "only."], [], None, ["龥", "一"]]
    grams = frame.where("i = 0").select(tx.shingles(F.col("t"), k=2, cut=cut).alias("g")).first().g
    assert grams == ["中国 人民", "人民 银行"]
    assert len(segment.dictionary(given, most=2).costs) == 4  # two words and their beginnings


def test_learned_words(spark):
    rng = random.Random(2)
    names = ["茅台", "银行", "有限公司", "平安"]
    filler = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未"
    rows = ["".join(rng.choice([rng.choice(names), rng.choice(filler), rng.choice(filler)]) for _ in range(30)) + " x" for _ in range(80)]
    learned = {r.word: r.n for r in segment.learned_words(spark.createDataFrame([(r,) for r in rows], "text string")).collect()}
    assert set(names) <= set(learned)
    assert all(learned[n] == sum(r.count(n) for r in rows) for n in names)
    assert {w for w in learned if len(w) == 1} == {c for r in rows for c in r if c not in " x"}
    assert not [w for w in learned if len(w) == 2 and set(w) <= set(filler)]
    assert segment.Dictionary(learned).cut("平安银行甲有限公司") == ["平安", "银行", "甲", "有限公司"]


@pytest.mark.parametrize("rows", [[], [(None,), ("no such characters",)]])
def test_nothing_to_learn(spark, rows):
    frame = spark.createDataFrame(rows, "text string")
    learned = segment.learned_words(frame)
    assert learned.count() == 0
    cut = segment.dictionary_words(segment.dictionary(learned))
    assert spark.range(1).select(cut(F.lit("中国 a")).alias("w")).first().w == ["中", "国", "a"]
