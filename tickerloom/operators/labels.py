"""Labelled rows: cleaning, distribution, sampling and splits.

Row choices are random but repeatable: the order is the md5 of ``seed:row_id``, so the same rows
come out under any partitioning. The generator of pandas cannot be reproduced; counts, quotas and
the disjointness of splits can, and are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.operators.ranking import seeded, with_rank
from tickerloom.session import materialize

# Score range, default symbol, least rows, rows of the older path and its split.
LOWEST, HIGHEST = 1, 5
DEFAULT_SYMBOL = "STOCK"
LEAST_ROWS = 20
LEGACY_ROWS = 1000
LEGACY_EVAL_SHARE = 0.2


def valid_labels(rows: DataFrame) -> DataFrame:
    """Rows with a summary and a numeric label whose integer part lies in 1..5."""
    number = F.col("label_raw").try_cast("double")
    return (
        rows.where(F.col("Lsa_summary").isNotNull())
        .where((number >= LOWEST) & (number < HIGHEST + 1))
        .withColumn("label", number.cast("int"))
    )


def fill_defaults(rows: DataFrame) -> DataFrame:
    return rows.withColumn("Stock_symbol", F.coalesce(F.col("Stock_symbol").cast("string"), F.lit(DEFAULT_SYMBOL)))


def clean_labels(rows: DataFrame) -> DataFrame:
    return fill_defaults(valid_labels(rows))


def legacy_labels(rows: DataFrame, first: int = LEGACY_ROWS) -> DataFrame:
    """The first rows in input order, then those with a summary and a label other than 0."""
    number = F.col("label_raw").try_cast("double")
    return head(rows, first).where(F.col("Lsa_summary").isNotNull() & number.isNotNull() & (number != 0)).withColumn(
        "label", number
    )


def row_guard(rows: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    """One row with the count when there are enough rows, none otherwise."""
    return rows.agg(F.count("*").alias("n")).where(F.col("n") >= least)


def require_rows(rows: DataFrame, least: int = LEAST_ROWS) -> DataFrame:
    """``rows`` itself; raises when fewer than ``least`` remain. Reads at most ``least`` rows to decide."""
    found = rows.limit(least).count()
    if found < least:
        raise ValueError(f"Only {found} valid rows remain; at least {least} are required.")
    return rows


def distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label").agg(F.count("*").alias("n")).orderBy("label")


def label_set(rows: DataFrame) -> DataFrame:
    return rows.select("label").distinct().orderBy("label")


def quotas(rows: DataFrame, n: int) -> DataFrame:
    """Per label its size, request and take; and the shortfall that other labels must fill.

    There is one row per label (five at most after cleaning), so the unpartitioned windows and the
    broadcasts of this table are small by construction.
    """
    whole = W.partitionBy(F.lit(0))
    sized = rows.groupBy("label").agg(F.count("*").alias("size"))
    placed = sized.withColumn("position", F.row_number().over(whole.orderBy("label")) - 1).withColumn(
        "k", F.count("*").over(whole)
    )
    requested = F.floor(F.lit(n) / F.col("k")) + F.when(F.col("position") < F.lit(n) % F.col("k"), 1).otherwise(0)
    taken = placed.withColumn("requested", requested).withColumn("take", F.least("requested", "size"))
    return taken.withColumn("shortfall", F.lit(n) - F.sum("take").over(whole)).drop("k")


def head(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy("row_id").limit(n)


def shuffled(rows: DataFrame, seed: int) -> DataFrame:
    """Every row with its place in a seeded permutation."""
    return with_rank(rows, seeded(seed, "row_id"), "row_id", "shuffle_pos")


def sample_random(rows: DataFrame, n: int, seed: int) -> DataFrame:
    return with_rank(rows, seeded(seed, "row_id"), "row_id", "shuffle_pos", at_most=n)


def _by_quota(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """Each row with its quota flag, and among the rest its place in the shortfall order."""
    per_label = with_rank(rows, seeded(F.col("label") + seed, "row_id"), "row_id", "_rank", ["label"])
    table = F.broadcast(quotas(rows, n).select("label", "take", "shortfall"))
    return per_label.join(table, "label").withColumn("_chosen", F.col("_rank") <= F.col("take"))


def quota_rows(rows: DataFrame, n: int, seed: int) -> DataFrame:
    return _by_quota(rows, n, seed).where("_chosen").select(*rows.columns)


def remainder(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows not selected, by id."""
    return rows.join(selected.select("row_id"), "row_id", "left_anti")


def select_by_id(rows: DataFrame, selected: DataFrame) -> DataFrame:
    return rows.join(selected.select("row_id"), "row_id", "left_semi")


def sample_balanced(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """Equal quotas per label, the shortfall filled from the rest, the whole shuffled.

    Ranks need ids and labels alone: those are read once and stored between the steps, and the other columns
    are joined to the ids picked at the end.
    """
    ids = materialize(rows.select("row_id", "label"), "ids")
    flagged = materialize(_by_quota(ids, n, seed), "flagged")
    rest = with_rank(flagged.where("NOT _chosen"), seeded(seed, "row_id"), "row_id", "_fill", at_most=n)
    filled = rest.where(F.col("_fill") <= F.col("shortfall")).select("row_id")
    picked = materialize(flagged.where("_chosen").select("row_id").unionByName(filled), "picked")
    return rows.join(shuffled(picked, seed), "row_id").select(*rows.columns, "shuffle_pos")


def select_rows(rows: DataFrame, n: int, mode: str, seed: int) -> DataFrame:
    """``head``, ``random`` or ``balanced`` choice of n rows; everything, shuffled, when n covers it or is not positive."""
    if n <= 0 or rows.limit(n + 1).count() <= n:
        return shuffled(rows, seed)
    if mode == "head":
        return head(rows, n)
    return sample_random(rows, n, seed) if mode == "random" else sample_balanced(rows, n, seed)


def stratify_check(rows: DataFrame, share: float) -> DataFrame:
    """One row: sizes and whether each class can appear on both sides of a split."""
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    sizes = counts.agg(F.sum("n").alias("n"), F.count("*").alias("classes"), F.min("n").alias("smallest"))
    evals = F.greatest(F.lit(1), F.bround(F.col("n") * share).cast("long"))
    return sizes.withColumn("eval_count", evals).withColumn(
        "can_stratify",
        (F.col("smallest") >= 2) & (F.col("eval_count") >= F.col("classes")) & (F.col("n") - F.col("eval_count") >= F.col("classes")),
    )


def train_quota(rows: DataFrame, share: float) -> DataFrame:
    """Training rows per label: proportional, the missing ones to the largest remainders."""
    whole = W.partitionBy(F.lit(0))
    sized = rows.groupBy("label").agg(F.count("*").alias("size")).withColumn("n", F.sum("size").over(whole))
    n_train = F.col("n") - F.ceil(F.col("n") * share)
    exact = sized.withColumn("exact", n_train * F.col("size") / F.col("n")).withColumn("base", F.floor("exact"))
    missing = n_train - F.sum("base").over(whole)
    order = F.row_number().over(whole.orderBy((F.col("exact") - F.col("base")).desc(), "label"))
    return (
        exact.withColumn("missing", missing).withColumn("order", order)
        .select("label", (F.col("base") + F.when(F.col("order") <= F.col("missing"), 1).otherwise(0)).alias("n_train"))
    )


def split_random(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """``part`` is ``eval`` for the first ceil(share * n) rows of the seeded order."""
    ranked = shuffled(rows, seed)
    total = rows.agg(F.count("*").alias("_n")).withColumn("_one", F.lit(1))
    limited = ranked.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    part = F.when(F.col("shuffle_pos") <= F.ceil(F.col("_n") * share), "eval").otherwise("train")
    return limited.withColumn("part", part).select(*rows.columns, "part")


def split_stratified(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """Train/eval split that keeps the class shares when feasible, else a random one."""
    if not stratify_check(rows, share).first()["can_stratify"]:
        return split_random(rows, share, seed)
    ranked = with_rank(rows, seeded(seed, "row_id"), "row_id", "_rank", ["label"])
    part = F.when(F.col("_rank") <= F.col("n_train"), "train").otherwise("eval")
    return ranked.join(F.broadcast(train_quota(rows, share)), "label").withColumn("part", part).select(*rows.columns, "part")
