"""Normalisation, words, shingles, MinHash, SimHash and pair similarities of news text."""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions import signatures

# The kept characters, whitespace, shingle width, permutations and thresholds.
KEPT_CHARACTERS = "[a-zA-Z0-9 .!?,;:一-龥]+"
WHITESPACE_AFTER_NFKC = "\x1c\x1d\x1e\x1f\x85\u1680\u2028\u2029"
_DROPPED = re.compile(KEPT_CHARACTERS.replace("[", "[^"))
SHINGLE_WORDS = 3
PERMUTATIONS = 128
TITLE_THRESHOLD = 0.8
CONTENT_THRESHOLD = 0.75
SIMHASH_THRESHOLD = 3
#: Words whose bits are added up at once.
WORDS_AT_ONCE = 1 << 14
TITLE_FALLBACK_CHARACTERS = 100

# Smoothed idf of a token found in one of two texts; a token in both has weight 1.
SINGLE_IDF = math.log(1.5) + 1.0

Words = Callable[[Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``, lambdas included."""
    return F.element_at(F.transform(F.array(value), body), 1)


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode NFKC; Spark SQL has no such function."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def _runs(text: Column, pattern: str, joint: str) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), joint)


def clean(text: Column) -> Column:
    """Collapse whitespace, trim, then drop characters outside the kept set; null becomes ''.

    Both steps join the runs to keep: in the JVM, collecting runs of a plain character class is
    several times faster than replacing what lies between them. A text that both would leave as it is, such as one that
    was cleaned before and lost no character between two spaces, is only looked through.
    """
    spaced = F.translate(text, WHITESPACE_AFTER_NFKC, " " * len(WHITESPACE_AFTER_NFKC))
    plain = F.when(text.rlike(f"[{WHITESPACE_AFTER_NFKC}]"), spaced).otherwise(text)
    settled = text.rlike(rf"^(?:{KEPT_CHARACTERS})?\z") & ~(text.contains("  ") | text.startswith(" ") | text.endswith(" "))
    return F.coalesce(F.when(settled, text).otherwise(_runs(_runs(plain, r"\S+", " "), KEPT_CHARACTERS, "")), F.lit(""))


def normalize(text: Column) -> Column:
    """NFKC, then what ``clean`` does, in one Arrow function: whitespace of an NFKC form is what ``split`` takes for it."""

    def one(value: str) -> str:
        stable = value if value.isascii() else unicodedata.normalize("NFKC", value)
        return _DROPPED.sub("", " ".join(stable.split()))

    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else one(t) for t in texts.to_pylist()], pa.string())

    return F.coalesce(F.arrow_udf(compute, T.StringType())(text), F.lit(""))


def words(text: Column) -> Column:
    """Whitespace-separated words of normalised text; runs of CJK are cut into character pairs."""
    return F.regexp_extract_all(text, F.lit("[a-zA-Z0-9.!?,;:]+|[一-龥]{1,2}"), F.lit(0))


def segmenter_words(text: Column) -> Column:
    """Alternative cut that also emits each space and punctuation mark, as dictionary segmenters do."""
    return F.regexp_extract_all(text, F.lit(r"[一-龥]{1,2}|[0-9A-Za-z]+(?:\.[0-9]+)?|\.+|[ !?,;:]"), F.lit(0))


def shingles(text: Column, k: int = SHINGLE_WORDS, cut: Words = words) -> Column:
    """Distinct runs of ``k`` words; the text itself when it has fewer."""

    def runs(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - k)
        return F.array_distinct(F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])))

    return let(cut(text), lambda w: F.when(F.size(w) < k, F.array(text)).otherwise(runs(w)))


def minhash(grams: Column, permutations: int = PERMUTATIONS) -> Column:
    """Smallest salted md5 per salt, as hex; hex order is numeric order. No shingles give zeros."""
    return signatures.minhash(grams, permutations)


_WORD = re.compile("[a-zA-Z0-9.!?,;:]+|[一-龥]{1,2}")


def word_shingles(text: str) -> list[str]:
    """What ``shingles`` gives for one text with its defaults."""
    w = _WORD.findall(text)
    return list(dict.fromkeys(map(" ".join, zip(w, w[1:], w[2:])))) if len(w) >= SHINGLE_WORDS else [text]


def packed_minhash(text: Column) -> Column:
    """``minhash`` of a text's shingles, 16 bytes a salt in one binary value; they are cut where the hashing is."""
    return signatures.packed_minhash(text, PERMUTATIONS, word_shingles)


def packed_grams(grams: Column) -> Column:
    return signatures.packed_minhash(grams, PERMUTATIONS)


def unpacked(sig: Column) -> Column:
    return signatures.unpacked(sig, PERMUTATIONS)


def equal_positions(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def equal_places(a: Column, b: Column) -> Column:
    """``equal_positions`` of packed signatures."""
    return signatures.equal_places(a, b)


def minhash_jaccard(a: Column, b: Column) -> Column:
    return F.when(F.size(a) != F.size(b), 0.0).otherwise(equal_positions(a, b) / F.size(a))


def shingle_jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


class _Halves(dict):
    """The low half of a word's md5, made at first sight."""

    def __missing__(self, word: str) -> bytes:
        got = self[word] = hashlib.md5(word.encode()).digest()[8:]
        return got


def _vote(hashes: bytes) -> int:
    """The SimHash of hashes of eight bytes; up to 255 bits are added up in a byte."""
    n, votes = len(hashes) // 8, np.zeros(64, np.int64)
    for at in range(0, n, WORDS_AT_ONCE):
        some = np.frombuffer(hashes, np.uint8)[8 * at : 8 * (at + WORDS_AT_ONCE)]
        bits = np.unpackbits(some).reshape(-1, 64)
        votes += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n).view(">i8")[0])


def text_simhashes(texts: pa.Array) -> pa.Array:
    """SimHashes of the words of texts; each distinct word of a batch is hashed once."""
    halves = _Halves()
    rows = (row.as_py() for row in texts)
    return pa.array([None if t is None else _vote(b"".join(map(halves.__getitem__, _WORD.findall(t)))) for t in rows], pa.int64())


def simhashes(lists: pa.Array) -> pa.Array:
    """SimHashes of lists of words; each distinct word of a batch is hashed once."""
    halves = _Halves()
    rows = (row.as_py() for row in lists)
    return pa.array([None if w is None else _vote(b"".join(map(halves.__getitem__, w))) for w in rows], pa.int64())


def simhash(tokens: Column) -> Column:
    """64-bit SimHash over the low halves of the words' md5: a bit is set when more than half of the words,
    repeats counted, have it. Null stays null, no words give 0.
    """
    return F.arrow_udf(lambda lists: simhashes(lists), T.LongType())(tokens)


def text_simhash(text: Column, cut: Words = words) -> Column:
    """SimHash of a text's words; the built-in cut is made where the hashing is, so words do not travel to Python one by one."""
    if cut is words:
        return F.arrow_udf(lambda texts: text_simhashes(texts), T.LongType())(text)
    return simhash(cut(text))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def edit_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return (
        F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0)
        .when(a == b, 1.0)
        .otherwise(1 - F.levenshtein(a, b) / longest)
    )


def term_counts(text: Column) -> Column:
    """Map of lower-case tokens of two or more word characters to their counts: one sort, then runs are measured."""
    tokens = F.sort_array(F.regexp_extract_all(F.lower(text), F.lit("[0-9a-z一-龥]{2,}"), F.lit(0)))

    def runs(t: Column) -> Column:
        places = F.when(F.size(t) > 0, F.sequence(F.lit(1), F.size(t))).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 1) | (F.get(t, i - 1) != F.get(t, i - 2)))

        def counted(s: Column) -> Column:
            ends = F.concat(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), F.array(F.size(t) + 1))
            sizes = F.zip_with(s, F.slice(ends, F.lit(1), F.size(s)), lambda a, b: b - a)
            return F.map_from_arrays(F.transform(s, lambda i: F.get(t, i - 1)), sizes)

        return let(starts, counted)

    return let(tokens, runs)


def tfidf_cosine(a: Column, b: Column) -> Column:
    """Cosine of the tf-idf vectors of two count maps, the idf fitted on just these two texts.

    The maps are matched by hash, so the cost follows their sizes; looking keys up in a map goes through it each time.
    """
    counts = F.map_values(F.map_zip_with(a, b, lambda _, x, y: F.struct(F.coalesce(x, F.lit(0)).alias("a"), F.coalesce(y, F.lit(0)).alias("b"))))
    start = F.struct(*[F.lit(0.0).alias(name) for name in ("ab", "own_a", "own_b", "aa", "bb")])

    def add(acc: Column, x: Column) -> Column:
        both = (x["a"] > 0) & (x["b"] > 0)
        square = {c: x[c].cast("double") * x[c] for c in "ab"}
        return F.struct(
            (acc["ab"] + x["a"].cast("double") * x["b"]).alias("ab"),
            (acc["own_a"] + F.when(both, 0.0).otherwise(square["a"])).alias("own_a"),
            (acc["own_b"] + F.when(both, 0.0).otherwise(square["b"])).alias("own_b"),
            (acc["aa"] + F.when(both, square["a"]).otherwise(0.0)).alias("aa"),
            (acc["bb"] + F.when(both, square["b"]).otherwise(0.0)).alias("bb"),
        )

    def value(acc: Column) -> Column:
        norms = [F.sqrt(acc[2 * c] + SINGLE_IDF**2 * acc[f"own_{c}"]) for c in "ab"]
        return F.when(acc["ab"] == 0, F.lit(0.0)).otherwise(acc["ab"] / (norms[0] * norms[1]))

    return F.aggregate(counts, start, add, value)


def title_similarity(a: Column, b: Column, counts_a: Column, counts_b: Column) -> Column:
    return (edit_similarity(a, b) + tfidf_cosine(counts_a, counts_b)) / 2


def compared_title(title: Column, doc: Column) -> Column:
    """The title, or the first characters of the text when it has none."""
    return F.coalesce(F.when(title != "", title), F.left(doc, F.lit(TITLE_FALLBACK_CHARACTERS)))
