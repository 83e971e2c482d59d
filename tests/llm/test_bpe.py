import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from tickerloom.llm import bpe, bpe_table, packing
from tokenizers import Tokenizer

PARTS = ["a", "b", " ", "  ", "\n", "é", "Z", "9", "½", "'", "s", "'s", "|", " the", "ing", "<|endoftext|>", "一", "😀", "\xa0", "\x1c", "\t", "\x00", "x" * 60]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})


def test_merges_and_pieces(ranks, plain):
    table = bpe.read_ranks(ranks)
    pieces = bpe.Pieces(lambda t: bpe.merged(t.encode(), table).tobytes(), keep=50)
    for text in [*random_texts(1500), "ab" * 3000, " " * 500, "é" * 200]:
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == plain.encode_ordinary(text)


def test_packing_ids_are_those_of_the_tokenizers_file(ranks):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.Encoder(ranks)
    for text in [*random_texts(1500, 8), " " * 5000 + "x", "a\n" + "\n " * 900, "b" * 3000]:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("chunk_bytes", [1 << 24, 300])
def test_encode_and_decode(frame, ranks, plain, chunk_bytes):
    rows = [*enumerate(random_texts(60)), (None, None), (2, "again"), (2, "again"), (2**60 + 1, "large key"), (7, "w " * 30_000)]
    coded = bpe_table.decode(bpe_table.encode(frame(rows), ranks, chunk_bytes=chunk_bytes), ranks).collect()
    got = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in coded)
    want = sorted((str(k), np.array(plain.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in rows)
    assert got == want


def test_empty_table(frame, ranks):
    assert bpe_table.encode(frame([]), ranks).count() == 0
