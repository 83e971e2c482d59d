"""Evaluation of integer predictions; ``prediction`` is null when the output could not be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.labels import HIGHEST, LOWEST

LABELS = list(range(LOWEST, HIGHEST + 1))


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def _hit() -> Column:
    return F.coalesce(F.col("prediction") == F.col("truth"), F.lit(False))


def accuracy(rows: DataFrame) -> DataFrame:
    """Share of exact matches; unparsed predictions count as wrong."""
    return rows.agg(_share(_hit()).alias("accuracy"), F.count("*").alias("n"))


def accuracy_valid_only(rows: DataFrame) -> DataFrame:
    """Percent of exact matches among parsed predictions."""
    return rows.where(F.col("prediction").isNotNull()).agg(
        F.count_if(_hit()).alias("correct"), F.count("*").alias("total"), (_share(_hit()) * 100).alias("accuracy")
    )


def accuracy_per_class(rows: DataFrame) -> DataFrame:
    return rows.groupBy("truth").agg(
        F.count_if(_hit()).alias("correct"), F.count("*").alias("total"), (_share(_hit()) * 100).alias("accuracy")
    )


def within_one(rows: DataFrame) -> DataFrame:
    near = F.coalesce(F.abs(F.col("prediction") - F.col("truth")) <= 1, F.lit(False))
    return rows.agg(_share(near).alias("within_one"))


def invalid_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("prediction").isNull()).alias("invalid"), F.count("*").alias("total"))


def _label_frame(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([(x,) for x in LABELS], "truth int")


def confusion_matrix(rows: DataFrame) -> DataFrame:
    """Counts with one row per true label and one column per predicted label; other values are ignored."""
    counted = rows.groupBy("truth").agg(*[F.count_if(F.col("prediction") == x).alias(f"pred_{x}") for x in LABELS])
    return _label_frame(rows).join(counted, "truth", "left").na.fill(0)


def _safe(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def classification_report(rows: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label, and their micro, macro and weighted means."""
    tp = {x: F.count_if((F.col("truth") == x) & _hit()) for x in LABELS}
    predicted = {x: F.count_if(F.col("prediction") == x) for x in LABELS}
    support = {x: F.count_if(F.col("truth") == x) for x in LABELS}
    counted = rows.agg(
        F.array(
            *[F.struct(F.lit(str(x)).alias("label"), tp[x].alias("tp"), predicted[x].alias("predicted"), support[x].alias("support")) for x in LABELS]
        ).alias("rows")
    )
    total = lambda rows, part: F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + part(r))
    sums = F.struct(
        F.lit("micro avg").alias("label"),
        *[total(F.col("rows"), lambda r, c=c: r[c]).cast("long").alias(c) for c in ("tp", "predicted", "support")],
    )
    # one row until here; the means are taken over its five labels, so the input is read once
    scored = counted.select(F.transform("rows", _scores).alias("each"), _scores(sums).alias("micro"))
    names, support = ("precision", "recall", "f1"), total(F.col("each"), lambda r: r["support"])
    macro = [(total(F.col("each"), lambda r, c=c: r[c]) / F.size("each")).alias(c) for c in names]
    weighted = [_safe(total(F.col("each"), lambda r, c=c: r[c] * r["support"]), support).alias(c) for c in names]
    means = [F.struct(F.lit(n).alias("label"), *v, support.cast("long").alias("support")) for n, v in (("macro avg", macro), ("weighted avg", weighted))]
    return scored.select(F.inline(F.concat("each", F.array("micro", *means))))


def _scores(counts: Column) -> Column:
    precision, recall = _safe(counts["tp"], counts["predicted"]), _safe(counts["tp"], counts["support"])
    f1 = _safe(2 * precision * recall, precision + recall)
    return F.struct(
        counts["label"].alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), counts["support"].cast("long").alias("support")
    )
