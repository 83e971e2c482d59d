import public_tokenizers
import pytest
from tickerloom.llm import bpe


@pytest.fixture(scope="session")
def ranks():
    return public_tokenizers.path(bpe.RANKS)


#: Columns of documents plus ones named like an operator's own.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, shard int, score double, key string, ids binary, _n int"


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents from ``(doc_id, text)`` rows; every other column is null."""

    def make(rows):
        return spark.createDataFrame([(k, t, *[None] * 9) for k, t in rows], SCHEMA)

    return make
