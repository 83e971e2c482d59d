"""Token ids, loss masks and padded batches. ``ids`` turns text into an array of integers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions.text import let

# The ignored label, the batch width multiple, the older length and marker.
IGNORED = -100
PAD_MULTIPLE = 8
LEGACY_LENGTH = 512
LEGACY_MARKER = "Assistant: "
PAD_ID, EOS_ID = 0, 2

Ids = Callable[[Column], Column]


def code_points(text: Column) -> Column:
    """The default token function: one id per character. Real tokenizers come in as Arrow UDFs."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(characters, lambda c: F.ascii(c))


def _repeat(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value), n.cast("int"))


def encode_completion(prompt: Column, answer: Column, max_length: int, ids: Ids = code_points) -> Column:
    """Prompt ids cut so that the answer fits, then the answer and the end id; the prompt carries no loss."""

    def joined(answer_ids: Column) -> Column:
        room = F.lit(max_length) - F.size(answer_ids)
        checked = F.when(room > 0, room).otherwise(F.raise_error(F.lit("max_length is too small to hold the target answer")).cast("int"))
        return let(
            F.slice(ids(prompt), F.lit(1), checked),
            lambda p: F.struct(
                F.concat(p, answer_ids).alias("input_ids"),
                _repeat(1, F.size(p) + F.size(answer_ids)).alias("attention_mask"),
                F.concat(_repeat(IGNORED, F.size(p)), answer_ids).alias("labels"),
            ),
        )

    return let(F.concat(ids(answer), F.array(F.lit(EOS_ID))), joined)


def legacy_answer(text: Column, max_length: int = LEGACY_LENGTH, ids: Ids = code_points) -> Column:
    """Ids cut and padded to ``max_length``; labels only after the last answer marker.

    When the cut removed the marker's end, everything up to three ids past the last occurrence of
    the marker word's first id is masked; without any marker all labels are ignored.
    """
    after = F.length(text) - F.locate(LEGACY_MARKER[::-1], F.reverse(text)) + 1
    found = F.locate(LEGACY_MARKER, text) > 0
    word = F.size(ids(F.lit(LEGACY_MARKER.rstrip(": "))))
    first = F.element_at(ids(F.lit(LEGACY_MARKER.rstrip(": "))), 1)

    def masked(x: Column) -> Column:
        kept = x["kept"]
        actual = F.size(kept)
        back = F.array_position(F.reverse(kept), first)
        fallback = F.when(back > 0, F.least(actual - back + word + 3, actual)).otherwise(0)
        prefix = F.when(~found, max_length).when(x["mask"] <= actual, x["mask"]).otherwise(fallback).cast("int")
        cut = F.least(prefix, actual).cast("int")
        visible = F.slice(kept, cut + 1, F.greatest(actual - cut, F.lit(0)).cast("int"))
        return F.struct(
            F.concat(kept, _repeat(PAD_ID, max_length - actual)).alias("input_ids"),
            F.concat(_repeat(IGNORED, cut), visible, _repeat(IGNORED, max_length - actual)).alias("labels"),
            actual.alias("actual_length"),
        )

    prompt_ids = ids(F.left(text, after.cast("int")))
    return let(
        F.struct(F.slice(ids(text), 1, max_length).alias("kept"), F.size(prompt_ids).alias("mask")), masked
    )


def pad_batches(examples: DataFrame, position: str, batch_size: int) -> DataFrame:
    """Pad each batch to its longest row, rounded up to a multiple of eight.

    A batch holds ``batch_size`` rows, which bounds the window.
    """
    batch = F.floor((F.col(position) - 1) / batch_size)
    longest = F.max(F.size("input_ids")).over(W.partitionBy("batch"))
    width = (F.ceil(F.col("_longest") / PAD_MULTIPLE) * PAD_MULTIPLE).cast("int")
    sized = examples.withColumn("batch", batch).withColumn("_longest", longest).withColumn("width", width)

    def padded(name: str, value: int) -> Column:
        return F.concat(F.col(name), _repeat(value, F.col("width") - F.size(name))).alias(name)

    others = [c for c in examples.columns if c not in ("input_ids", "attention_mask", "labels")]
    return sized.select(
        *others, "batch", "width", padded("input_ids", PAD_ID), padded("attention_mask", 0), padded("labels", IGNORED)
    )
