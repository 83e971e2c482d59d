"""Pre-tokens and byte-pair merges of a public byte-level vocabulary."""

from __future__ import annotations

import base64
import heapq
from array import array

import public_tokenizers
import regex

RANKS = "byte_bpe_50k.tiktoken"
_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: A text cut at its blanks gives the same pre-tokens piece by piece, unless a piece has white space at an end.
_EDGE = regex.compile(r"\A\s|\s\Z")
#: Memory that one task spends on pieces it has seen.
CACHED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


def pretokens(text: str) -> list[str]:
    return _PATTERN.findall(text)


def first_pretoken(text: str) -> str:
    return _PATTERN.search(text).group()


class Uneven(Exception):
    """A text whose blanks can't be used as cuts."""


class Pieces(dict):
    """Remembers ``make(piece)`` for the blank-separated pieces of texts, as bytes that can be concatenated.

    ``encode(text)`` gives ``b"".join(make(pre-token) ...)`` of the whole text. A blank before a visible character
    always belongs to the pre-token that follows it, so pieces can be looked up whole; other texts take the pattern.
    """

    def __init__(self, make, keep: int = CACHED):
        self.make, self.keep = make, keep

    def __missing__(self, piece: str) -> bytes:
        if piece == "" or _EDGE.search(piece):
            raise Uneven
        if len(self) >= self.keep:
            self.clear()
        got = self[piece] = b"".join(map(self.make, pretokens(" " + piece)))
        return got

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            if first == "" or _EDGE.search(first):
                raise Uneven
            return b"".join(map(self.make, pretokens(first))) + b"".join(map(self.__getitem__, rest))
        except Uneven:
            return b"".join(map(self.make, pretokens(text)))


def merged(piece: bytes, ranks: dict[bytes, int]) -> array:
    """Ids of one pre-token: the neighbours of lowest rank are joined, leftmost first, until none is known."""
    whole = ranks.get(piece)
    if whole is not None:
        return array("I", (whole,))
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) <= 40:
        while len(parts) > 1:
            known = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
            least = min(known)
            if least == _NONE:
                break
            at = known.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return array("I", map(ranks.__getitem__, parts))
    return _merged_long(parts, ranks)


_NONE = 1 << 31


def _merged_long(parts: list, ranks: dict[bytes, int]) -> array:
    """The same for long pre-tokens with a heap of joinable neighbours, in n log n."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (rank, i, len(parts[i]), len(parts[j])))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= n or len(parts[i]) != a or len(parts[j]) != b:
            continue  # one side has been joined since
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return array("I", (ranks[p] for p in parts if p is not None))
