"""News items: from CSV rows, envelopes, title filters, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.functions.text import normalize
from tickerloom.session import bound_batches, redistribute

# Source tag, envelope limits, title rules, items scored per company.
LOCAL_SOURCE = "local_csv"
MIN_ITEMS, MAX_ITEMS = 1, 10
MIN_TITLE_CHARACTERS = 3
TITLE_STOP_PHRASES = ["官方网站", "百度百科", "移动官网"]
SCORED_ITEMS = 3
NEWS_FIELDS = ["title", "content", "published_at", "source", "url"]
NEWS_JSON = "query string, count int, news array<struct<title string, content string, published_at string, source string, url string>>"


def _given(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def news_items(rows: DataFrame, spread: bool = False) -> DataFrame:
    """Seven-field items from news rows; items without text are dropped.

    With ``spread`` rows are hashed over all shuffle partitions, each with the one text that is used. The empty texts leave inside the generator: a filter behind the projection would be pushed
    below it and normalise every text twice.
    """
    chosen = rows.select(
        F.coalesce(_given(F.col("Article")), _given(F.col("Textrank_summary"))).alias("_text"),
        F.coalesce(_given(F.col("Article_title")), _given(F.col("Stock_symbol"))).alias("_title"),
        F.when(F.col("risk_deepseek").isNotNull(), F.concat(F.lit("risk_score:"), F.col("risk_deepseek").cast("string")))
        .otherwise("")
        .alias("labels"),
        F.coalesce("Stock_symbol", F.lit("")).alias("stock_symbol"),
        F.coalesce("Date", F.lit("")).alias("date"),
        "original_index",
    )
    return bound_batches(redistribute(chosen, "original_index") if spread else chosen).select(
        F.lit(LOCAL_SOURCE).alias("source"),
        F.explode(F.filter(F.array(normalize(F.col("_text"))), lambda doc: doc != "")).alias("doc"),
        "labels",
        normalize(F.col("_title")).alias("title"),
        "stock_symbol",
        "date",
        "original_index",
    )


#: A character that NFKC and the character rules surely keep: digits, marks and CJK never compose, letters not with ASCII.
_SURE = r"[0-9.!?,;:一-龥]|[a-zA-Z](?=[\x00-\x7f])"


def titled_items(rows: DataFrame) -> DataFrame:
    """``(original_index, doc, title)`` of the same items, for those who compare titles alone.

    Texts of rows that surely have a text and a title are not read beyond the first sure character, and their ``doc`` is
    ''. Other rows need their text to tell whether they stay or as a title, so it is normalised.
    """
    text = F.coalesce(_given(F.col("Article")), _given(F.col("Textrank_summary")))
    title = F.coalesce(_given(F.col("Article_title")), _given(F.col("Stock_symbol")))
    sure = F.coalesce(title.rlike(_SURE) & text.rlike(_SURE), F.lit(False))
    chosen = rows.select("original_index", sure.alias("_sure"), title.alias("_title"), F.when(~sure, text).alias("_text"))
    spread = bound_batches(redistribute(chosen, "original_index"))
    docs = F.filter(F.array(normalize(F.col("_text"))), lambda doc: F.col("_sure") | (doc != ""))
    return spread.select("original_index", F.explode(docs).alias("doc"), normalize(F.col("_title")).alias("title"))


def clamp_limit(k: int) -> int:
    return max(MIN_ITEMS, min(int(k), MAX_ITEMS))


def top_items(items: DataFrame, k: int, keys: Sequence[str] = ("query",), order: str = "pos") -> DataFrame:
    """The first k items per key. Spark limits each group before the shuffle, so hot keys stay cheap."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(order))
    return items.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def news_envelopes(items: DataFrame, k: int, queries: DataFrame | None = None) -> DataFrame:
    """One JSON envelope per query with at most k (1..10) items; queries without items get an empty list."""
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in NEWS_FIELDS]
    top = top_items(items, clamp_limit(k)).select("query", "pos", F.struct(*fields).alias("item"))
    gathered = top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("ranked"))
    if queries is not None:
        gathered = queries.select("query").distinct().join(gathered, "query", "left")
    news = F.coalesce(F.col("ranked.item"), F.from_json(F.lit("[]"), NEWS_JSON.split("news ")[1]))
    return gathered.select("query", F.to_json(F.struct("query", F.size(news).alias("count"), news.alias("news"))).alias("envelope"))


def parse_envelopes(envelopes: DataFrame) -> DataFrame:
    parsed = envelopes.select(F.from_json("envelope", NEWS_JSON).alias("e"))
    return parsed.select("e.query", F.posexplode("e.news").alias("pos", "item")).select("query", "pos", "item.*")


def first_by_title(items: DataFrame, keys: Sequence[str] = (), order: str = "pos") -> DataFrame:
    """The first item of each exact title within ``keys``: one aggregate over one read, with map-side combine."""
    rest = [c for c in items.columns if c not in (*keys, "title")]
    first = items.groupBy(*keys, "title").agg(F.min(F.struct(F.col(order).alias("_order"), *[F.col(f"`{c}`") for c in rest])).alias("_first"))
    return first.select(*[F.col(f"_first.`{c}`") if c in rest else F.col(f"`{c}`") for c in items.columns])


def filter_titles(items: DataFrame, k: int) -> DataFrame:
    """Titles of three or more characters without stop phrases, each once, at most k per query."""
    fit = F.length("title") >= MIN_TITLE_CHARACTERS
    for phrase in TITLE_STOP_PHRASES:
        fit &= ~F.col("title").contains(phrase)
    return top_items(first_by_title(items.where(fit), ["query"]), k)


def select_for_scoring(items: DataFrame) -> DataFrame:
    """At most three usable items per query, each exactly once."""
    usable = items.where(F.trim("content") != "")
    return top_items(first_by_title(usable, ["query"]), SCORED_ITEMS)
