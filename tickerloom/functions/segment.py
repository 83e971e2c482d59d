"""Dictionary segmentation of CJK text, with the dictionary given as a table or learned from the corpus.

A run of CJK characters is cut into the words whose costs sum up to the least: a word costs the rounded log of its inverse share among
all words of the dictionary. Characters that no word covers stay single, at the cost of a word seen once. Equal sums go to
fewer words, then to the longest first word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions.text import Words, words
from tickerloom.session import materialize

CJK = "[一-龥]"
#: A learned word: its characters at most, occurrences at least, and how often more than by chance it follows from its parts.
LONGEST, LEAST, COHESION = 4, 5, 8.0
#: Words a dictionary may have; the commonest are kept. It is what every task holds, so it must not grow with the corpus.
MOST = 500_000
COST_SCALE = 1000
_TOKENS = re.compile("[a-zA-Z0-9.!?,;:]+|[一-龥]+")


class Dictionary:
    """Costs of words, with all their beginnings, so that a search along a run ends where no word goes on."""

    def __init__(self, counts: Mapping[str, int]):
        total = sum(counts.values())
        self.costs: dict[str, int | None] = {}
        for word, n in counts.items():
            for end in range(1, len(word)):
                self.costs.setdefault(word[:end])
            self.costs[word] = round(COST_SCALE * (math.log(total) - math.log(n)))
        self.unknown = round(COST_SCALE * math.log(max(1, total)))

    def cut(self, run: str) -> list[str]:
        n = len(run)
        best, step = [(0, 0)] * (n + 1), [1] * n
        for at in range(n - 1, -1, -1):
            top = None
            for end in range(at + 1, n + 1):
                cost = self.costs.get(run[at:end], -1)
                if cost == -1 and end > at + 1:
                    break
                if cost is None or cost == -1:
                    cost = self.unknown if end == at + 1 else None
                if cost is not None:
                    found = (cost + best[end][0], 1 + best[end][1])
                    if top is None or found <= top:
                        top, step[at] = found, end - at
                if end == at + 1 and run[at:end] not in self.costs:
                    break
            best[at] = top
        out, at = [], 0
        while at < n:
            out.append(run[at : at + step[at]])
            at += step[at]
        return out


def dictionary(table: DataFrame, word: str = "word", count: str = "n", most: int = MOST) -> Dictionary:
    """The ``most`` commonest words of a table (ties by the word); null and empty words, and counts below one, do not count."""
    known = table.where((F.length(word) > 0) & (F.col(count) >= 1)).groupBy(F.col(word).alias("word")).agg(F.sum(count).alias("n"))
    return Dictionary({r.word: r.n for r in known.orderBy(F.desc("n"), "word").limit(most).collect()})


def dictionary_words(words_of: Dictionary) -> Words:
    """A cut for ``shingles``, ``simhash`` and near-duplicate removal. Texts without CJK characters do not go to Python."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            return [w for token in _TOKENS.findall(text) for w in (words_of.cut(token) if "一" <= token[0] <= "龥" else (token,))]

        return texts.map(one)

    def of(text: Column) -> Column:
        return F.coalesce(cut(F.when(text.rlike(CJK), text)), words(text))

    return of


def learned_words(texts: DataFrame, text: str = "text", longest: int = LONGEST, least: int = LEAST, cohesion: float = COHESION) -> DataFrame:
    """``(word, n)``: all single CJK characters with their counts, and the longer runs that occur often and hold together.

    A run holds together if it is ``cohesion`` times as frequent as its two parts would meet by chance, wherever it is parted. All counting is
    by Spark: runs are counted with map-side combine, and every candidate is joined with the counts of its parts.
    """
    runs = texts.select(F.explode(F.regexp_extract_all(text, F.lit(f"{CJK}+"), F.lit(0))).alias("run"))
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length("run")),
            lambda at: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - at + 1)), lambda size: F.substr("run", at, size)),
        )
    )
    counted = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).select(F.explode(pieces).alias("word"), "n")
    counts = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "pieces")
    total = counts.where(F.length("word") == 1).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = counts.where((F.length("word") > 1) & (F.col("n") >= least))
    cuts = often.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("at"))
    parts = cuts.select("word", "n", F.substr("word", F.lit(1), F.col("at")).alias("a"), F.substr("word", F.col("at") + 1).alias("b"))
    part = lambda side: counts.select(F.col("word").alias(side), F.col("n").alias(f"n_{side}"))
    tied = parts.join(part("a"), "a").join(part("b"), "b").groupBy("word", "n").agg(F.max(F.col("n_a").cast("double") * F.col("n_b")).alias("chance"))
    held = tied.where(F.col("n").cast("double") * F.lit(float(total)) >= F.col("chance") * F.lit(cohesion)).select("word", "n")
    return counts.where(F.length("word") == 1).unionByName(held)
