"""A corpus pipeline: drop toxic documents, near-duplicates and long repeated passages, then pack the rest.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that the stage before it kept; the result is written as
Parquet to the shared folder and read back as the next stage's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.llm import bpe, packing, simhash, suffix, toxicity
from tickerloom.llm.common import table
from tickerloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (a score of 0.5 or more) go. It learns from the rows still there."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.withColumn("_tl_score", toxicity.score_column(model, F.col("text")))
    return scored.where("_tl_score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the smallest doc_id."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte of a 200-byte string that starts more than once goes; a character that lost a byte goes with it.

    ``n_chars`` is counted anew where text was cut. Documents stay, even if nothing is left of their text.
    """
    cleaned = suffix.remove_repeats(docs)
    text = F.when(F.col("_n_removed") > 0, _decoded(F.col("_kept"))).otherwise(F.col("text"))
    out = cleaned.withColumn("text", text)
    if "n_chars" in docs.columns:
        counted = F.when(F.col("_n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _decoded(data):
    def decode(values):
        return values.map(lambda b: b.decode("utf-8", "ignore"))

    return F.pandas_udf(decode, T.StringType())(data)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1,024 ids."""
    return packing.pack_documents(docs, public_tokenizers.path(bpe.RANKS))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

#: No SQL: the stages learn a model, link by fingerprints, and tokenize. Tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
