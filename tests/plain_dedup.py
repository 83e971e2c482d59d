"""A serial, plain-Python form of the removal rule, for comparison on small fixtures."""

import hashlib
import math
import re
import unicodedata
from collections import Counter


def normalize(text):
    text = unicodedata.normalize("NFKC", text or "")
    text = re.sub(r"\s+", " ", text).strip()
    return re.sub(r"[^一-龥0-9A-Za-z\s.!?,;:]", "", text)


def words(text):
    return re.findall(r"[a-zA-Z0-9.!?,;:]+|[一-龥]{1,2}", text)


def shingle_set(text):
    w = words(text)
    return {text} if len(w) < 3 else {" ".join(w[i : i + 3]) for i in range(len(w) - 2)}


def signature(text):
    grams = [g.encode() for g in shingle_set(text)]
    return [min(hashlib.md5(g + str(i).encode()).digest() for g in grams) for i in range(128)]


def simhash(text):
    counts = [0] * 64
    w = words(text)
    for word in w:
        h = int(hashlib.md5(word.encode()).hexdigest(), 16)
        for i in range(64):
            counts[i] += 1 if h >> i & 1 else -1
    return sum(1 << i for i in range(64) if counts[i] > 0) if w else 0


def edit(a, b):
    if not a or not b:
        return 0.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last if x == y else 1 + min(last, row[j], row[j - 1])
    return 1 - row[-1] / max(len(a), len(b))


def cosine(a, b):
    ta, tb = (Counter(re.findall(r"\b\w\w+\b", x.lower())) for x in (a, b))
    idf = {t: math.log(3 / (1 + (t in ta) + (t in tb))) + 1 for t in ta | tb}
    norm = lambda c: math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
    if not ta or not tb:
        return 0.0
    return sum(ta[t] * tb[t] * idf[t] ** 2 for t in ta & tb) / (norm(ta) * norm(tb))


class Item:
    def __init__(self, index, title, doc):
        self.index = index
        self.title = normalize(title if title else doc[:100])
        text = normalize(doc)
        self.sim, self.sig = simhash(text), signature(text)


def duplicates(a, b):
    if bin(a.sim ^ b.sim).count("1") > 3:
        return False
    if sum(x == y for x, y in zip(a.sig, b.sig)) / 128 <= 0.75:
        return False
    return (edit(a.title, b.title) + cosine(a.title, b.title)) / 2 > 0.8


def serial_kept(rows):
    """Kept ids and, per dropped id, the earliest kept duplicate, in input order."""
    kept, lost = [], {}
    for index, title, doc in sorted(rows):
        item = Item(index, title, doc)
        match = next((k for k in kept if duplicates(k, item)), None)
        if match is None:
            kept.append(item)
        else:
            lost[index] = match.index
    return {k.index for k in kept}, lost
