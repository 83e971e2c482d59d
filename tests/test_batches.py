"""How often and in what portions texts are worked on."""

import pytest
from tickerloom.operators import dedup, scoring
from tickerloom.plans import corpus
from tickerloom.sources.standins import Tables


def test_python_gets_bounded_batches(spark):
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(bound, None)
    spark.conf.unset(bound)
    try:

        def load():
            def predict(symbols, summaries):  # scores 5 where a batch is small
                small = summaries.str.len().sum() < 16 << 20
                return [[0.0, 0.0, 0.0, 0.0, 1.0 if small else -1.0]] * len(summaries)

            return predict

        rows = spark.range(400).coalesce(1).selectExpr("'s' AS stock_symbol", "repeat('x', 100000) AS summary")
        assert [r[0] for r in scoring.score_news(rows, load, load).select("sentiment.score").distinct().collect()] == [5]
        spark.conf.unset(bound)
        dedup.compared(spark.createDataFrame([(1, "a b", "t")], "original_index long, doc string, title string"))
        assert spark.conf.get(bound) == str(8 << 20)
    finally:
        if before:
            spark.conf.set(bound, before)


@pytest.mark.parametrize("name", ["edit_similarity", "hamming_distance", "content_overlap", "is_duplicate"])
def test_pairs_read_stored_texts(spark, sf_dir, name):
    """Texts are normalised before the pairs are formed, not once for each side of them."""
    plan = getattr(corpus, name)(Tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_counted_items_are_stored(spark, sf_dir):
    plan = corpus.dedup_stats(Tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
