"""Queries over the news corpus: files, normalisation, similarity, near-duplicate removal, envelopes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.functions import segment
from tickerloom.functions import text as tx
from tickerloom.operators import dedup, news, scoring
from tickerloom.plans.registry import query
from tickerloom.plans.shape import final
from tickerloom.session import free_shuffles, materialize, redistribute, scratch_path
from tickerloom.sources import files


def norm(x: str) -> str:
    return (
        f"coalesce(regexp_replace(trim(regexp_replace(nfc_normalize({x}), '\\s+', ' ', 'g')), "
        f"'[^一-龥0-9A-Za-z\\s.!?,;:]', '', 'g'), '')"
    )


def given(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN trim({x}) <> '' THEN {x} END" for x in xs) + ")"


ITEMS = f"""items AS MATERIALIZED (SELECT * FROM (
  SELECT 'local_csv' AS source, {norm(given('"Article"', '"Textrank_summary"'))} AS doc,
         CASE WHEN risk_deepseek IS NULL THEN '' ELSE 'risk_score:' || risk_deepseek::VARCHAR END AS labels,
         {norm(given('"Article_title"', '"Stock_symbol"'))} AS title, coalesce("Stock_symbol", '') AS stock_symbol,
         coalesce("Date", '') AS date, original_index FROM v_news) WHERE doc <> '')"""
NODES = f"""{ITEMS}, nodes AS MATERIALIZED (SELECT original_index, {norm('doc')} AS doc2,
  {norm("CASE WHEN title <> '' THEN title ELSE left(doc, 100) END")} AS title2 FROM items)"""
CUT = "regexp_extract_all({}, '[a-zA-Z0-9.!?,;:]+|[一-龥]{{1,2}}')"
WORDS = f"""{NODES}, cut AS MATERIALIZED (SELECT original_index, doc2, {CUT.format('doc2')} AS w FROM nodes)"""
GRAMS = f"""{WORDS}, grams AS MATERIALIZED (SELECT original_index, CASE WHEN len(w) < 3 THEN [doc2]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM cut)"""


def sig(ids: str) -> str:
    return f"""flat AS MATERIALIZED (SELECT original_index, unnest(g) AS s FROM grams WHERE original_index IN (SELECT original_index FROM {ids})),
sig AS MATERIALIZED (SELECT original_index, list(m ORDER BY i) AS sig FROM (
  SELECT original_index, i, min(md5(s || i::VARCHAR)) AS m FROM flat, range(128) t(i) GROUP BY original_index, i) GROUP BY original_index)"""


BITS = ", ".join(f"sum((h >> {i}) & 1) AS b{i}" for i in range(64))
VALUE = " + ".join(f"CASE WHEN 2 * b{i} > n THEN {1 << i}::HUGEINT ELSE 0 END" for i in range(64))
SIM = f"""hashes AS MATERIALIZED (SELECT original_index, ('0x' || substr(md5(unnest(w)), 17, 16))::UBIGINT AS h FROM cut),
bits AS (SELECT original_index, count(*) AS n, {BITS} FROM hashes GROUP BY original_index),
sim AS MATERIALIZED (SELECT c.original_index, CASE WHEN v >= 9223372036854775808 THEN (v - 18446744073709551616)::BIGINT ELSE v::BIGINT END AS h
  FROM cut c JOIN (SELECT original_index, {VALUE} AS v FROM bits UNION ALL
    SELECT original_index, 0::HUGEINT FROM cut WHERE len(w) = 0) USING (original_index))"""
PAIRS = """pairs AS MATERIALIZED (SELECT a.original_index AS a, b.original_index AS b FROM nodes a JOIN nodes b ON b.original_index = a.original_index + 1
  UNION SELECT f.a, n.original_index FROM nodes n JOIN (SELECT title2, min(original_index) AS a FROM nodes GROUP BY title2) f USING (title2) WHERE f.a < n.original_index)"""


def cosines(pairs: str) -> str:
    """tf-idf fitted on the two titles of each pair, from the textbook formula."""
    tokens = "unnest(regexp_extract_all(lower(title2), '[0-9a-z一-龥]{2,}'))"
    return f"""tokens AS MATERIALIZED (SELECT original_index, tok, count(*) AS tf FROM (SELECT original_index, {tokens} AS tok FROM nodes) GROUP BY ALL),
both_sides AS (SELECT a, b, tok, tf AS ta, 0 AS tb FROM {pairs} p JOIN tokens t ON t.original_index = p.a
  UNION ALL SELECT a, b, tok, 0, tf FROM {pairs} p JOIN tokens t ON t.original_index = p.b),
per_token AS (SELECT a, b, tok, sum(ta) AS ta, sum(tb) AS tb FROM both_sides GROUP BY ALL),
weighted AS (SELECT a, b, ta * (ln(3.0 / (1 + (ta > 0)::INT + (tb > 0)::INT)) + 1) AS wa, tb * (ln(3.0 / (1 + (ta > 0)::INT + (tb > 0)::INT)) + 1) AS wb FROM per_token),
cosine AS (SELECT a, b, CASE WHEN sum(wa * wa) * sum(wb * wb) > 0 THEN sum(wa * wb) / (sqrt(sum(wa * wa)) * sqrt(sum(wb * wb))) ELSE 0 END AS cos FROM weighted GROUP BY a, b),
titles AS MATERIALIZED (SELECT p.a, p.b, CASE WHEN x.title2 = '' OR y.title2 = '' THEN 0 ELSE 1 - levenshtein(x.title2, y.title2)::DOUBLE / greatest(length(x.title2), length(y.title2)) END AS edit,
  coalesce(c.cos, 0) AS cos FROM {pairs} p JOIN nodes x ON x.original_index = p.a JOIN nodes y ON y.original_index = p.b LEFT JOIN cosine c ON c.a = p.a AND c.b = p.b)"""


EQUAL = "len(list_filter(list_zip(x.sig, y.sig), lambda z: z[1] = z[2])) / 128.0"


def items(t):
    return news.news_items(t.v_news, spread=True)


def items_of(t):
    return lambda ids: news.news_items(dedup.among(t.v_news)(ids))


def nodes(t):
    return dedup.compared(items(t))


def stored_nodes(t, *columns):
    """Titles and the named columns, stored: texts are normalised once, however often the table is read, and not for titles alone."""
    if {"doc2", "simhash"}.isdisjoint(columns):
        source = dedup.compared_titles(news.titled_items(t.v_news))
    else:
        source = nodes(t)
    return materialize(source.select("original_index", "title2", *columns), "nodes")


def paired(left):
    """Each item with its successor and with the first item of the same title: linear in the items."""
    ids = left.select("original_index", "title2")
    firsts = ids.groupBy("title2").agg(F.min("original_index").alias("a"))
    return (
        ids.select(F.col("original_index").alias("a"), (F.col("original_index") + 1).alias("b"))
        .unionByName(ids.join(firsts, "title2").where("a < original_index").select("a", F.col("original_index").alias("b")))
        .distinct()
    )


def with_sides(left):
    """The pairs with the columns of both sides; of a repeated index every row."""
    sides = [
        left.select(*[F.col(c).alias({"original_index": side}.get(c, f"{side}_{c}")) for c in left.columns]) for side in ("a", "b")
    ]
    return paired(left).join(sides[0], "a").join(sides[1], "b")


def news_pairs(t, *columns):
    return with_sides(stored_nodes(t, *columns))


# ---- files ------------------------------------------------------------------------------------


def news_csv(t):
    path = scratch_path(t.spark, "news-csv")
    files.write_csv(t.v_news.select(*files.NEWS_CSV.fieldNames()), path)
    return path


@query("scan_news_csv", """SELECT original_index, "Date", "Article_title", "Stock_symbol", md5("Article") AS article, md5("Textrank_summary") AS summary, risk_deepseek FROM v_news""")
def scan_news_csv(t):
    return files.read_csv(t.spark, news_csv(t), files.NEWS_CSV).select(
        "original_index", "Date", "Article_title", "Stock_symbol", F.md5("Article").alias("article"),
        F.md5("Textrank_summary").alias("summary"), "risk_deepseek",
    )


@query("scan_csv_pruned", """SELECT length("Lsa_summary") AS n, "Stock_symbol", label_raw FROM v_labels""")
def scan_csv_pruned(t):
    path = scratch_path(t.spark, "labels-csv")
    files.write_csv(t.v_labels.select(*files.LABEL_CSV.fieldNames()), path)
    df = files.read_csv_columns(t.spark, path, files.LABEL_CSV, ["Lsa_summary", "Stock_symbol", "label_raw"])
    return df.select(F.length("Lsa_summary").alias("n"), "Stock_symbol", "label_raw")


@query("csv_head_extract", """SELECT original_index, "Date", "Stock_symbol", md5("Article") AS article, risk_deepseek FROM v_news ORDER BY original_index LIMIT 5""")
def csv_head_extract(t):
    path = scratch_path(t.spark, "head-csv")
    files.head_extract(t.v_news.select(*files.NEWS_CSV.fieldNames()), path, "original_index")
    return files.read_csv(t.spark, path, files.NEWS_CSV, split=False).select(
        "original_index", "Date", "Stock_symbol", F.md5("Article").alias("article"), "risk_deepseek"
    )


@query("sink_jsonl", f"""WITH {ITEMS} SELECT original_index, md5(doc) AS doc, labels, title, stock_symbol, date, source FROM items""")
def sink_jsonl(t):
    df, path = items(t), scratch_path(t.spark, "news-jsonl")
    files.write_jsonl(df, path)
    back = files.read_jsonl(t.spark, path, df.schema)
    return back.select("original_index", F.md5("doc").alias("doc"), "labels", "title", "stock_symbol", "date", "source")


@query("news_item_build", f"""WITH {ITEMS} SELECT original_index, source, md5(doc) AS doc, labels, title, stock_symbol, date FROM items""")
def news_item_build(t):
    return items(t).withColumn("doc", F.md5("doc"))


# ---- normalisation, words, signatures ---------------------------------------------------------


@query("text_normalize", f"""SELECT doc_id, length({norm('text')}) AS n, md5({norm('text')}) AS digest FROM documents""")
def text_normalize(t):
    df = redistribute(t.documents, "doc_id").select("doc_id", tx.normalize(F.col("text")).alias("x"))
    return df.select("doc_id", F.length("x").alias("n"), F.md5("x").alias("digest"))


@query("udf_nfkc", "SELECT doc_id, md5(nfc_normalize(text)) AS digest FROM documents")
def udf_nfkc(t):
    """Every text through the Arrow function. The test texts hold no compatibility characters, so NFC agrees."""
    return t.documents.select("doc_id", F.md5(tx.nfkc(F.col("text"))).alias("digest"))


@query("tokenize_words", f"""WITH {WORDS} SELECT original_index, len(w) AS n, md5(array_to_string(w, '|')) AS digest FROM cut""")
def tokenize_words(t):
    df = nodes(t).select("original_index", tx.words(F.col("doc2")).alias("w"))
    return df.select("original_index", F.size("w").alias("n"), F.md5(F.array_join("w", "|")).alias("digest"))


SEGMENTED = f"""WITH runs AS (SELECT request_id, unnest(regexp_extract_all(query, '[a-zA-Z0-9.!?,;:]+|[一-龥]+')) AS run, unnest(range(len(regexp_extract_all(query, '[a-zA-Z0-9.!?,;:]+|[一-龥]+')))) AS pos FROM v_requests),
cjk AS (SELECT run, count(*) AS n FROM runs WHERE regexp_matches(run, '^[一-龥]') GROUP BY run),
pieces AS (SELECT substr(run, i, k) AS word, sum(n)::BIGINT AS n FROM cjk, range(1, 200) x(i), range(1, {segment.LONGEST} + 1) y(k) WHERE i + k - 1 <= length(run) GROUP BY word),
total AS (SELECT sum(n)::DOUBLE AS t FROM pieces WHERE length(word) = 1),
parts AS (SELECT word, n, substr(word, 1, k) AS a, substr(word, k + 1) AS b FROM pieces, range(1, {segment.LONGEST}) z(k) WHERE k < length(word) AND n >= {segment.LEAST}),
held AS (SELECT p.word, p.n FROM parts p JOIN pieces a ON a.word = p.a JOIN pieces b ON b.word = p.b, total GROUP BY p.word, p.n, t HAVING p.n * t >= {segment.COHESION} * max(a.n::DOUBLE * b.n)),
known AS (SELECT word, n FROM pieces WHERE length(word) = 1 UNION ALL SELECT * FROM held),
book AS (SELECT map(list(word), list(round({segment.COST_SCALE} * (ln(s) - ln(n)))::BIGINT)) AS costs FROM known, (SELECT sum(n) AS s FROM known) GROUP BY s),
ways AS (SELECT run, list_reduce(list_prepend([{{'cost': 0::BIGINT, 'size': 0::BIGINT, 'k': 0::BIGINT, 'words': []::VARCHAR[]}}], list_transform(range(length(run), 0, -1), lambda i: [{{'cost': i, 'size': 0::BIGINT, 'k': 0::BIGINT, 'words': []::VARCHAR[]}}])),
  lambda done, i: list_prepend(list_sort(list_transform(list_filter(range(1, least({segment.LONGEST}, length(run) - i[1].cost + 1) + 1), lambda k: costs[substr(run, i[1].cost, k)] IS NOT NULL),
    lambda k: {{'cost': costs[substr(run, i[1].cost, k)] + done[k].cost, 'size': done[k].size + 1, 'k': -k, 'words': list_prepend(substr(run, i[1].cost, k), done[k].words)}}))[1], done)) AS best FROM cjk, book)
SELECT request_id, count(*) AS n, md5(string_agg(w, '|' ORDER BY pos, j)) AS digest FROM (
  SELECT request_id, pos, unnest(coalesce(best[1].words, [run])) AS w, unnest(range(len(coalesce(best[1].words, [run])))) AS j FROM runs LEFT JOIN ways USING (run)) GROUP BY request_id"""


@query("segment_words", SEGMENTED)
def segment_words(t):
    """Requests cut by a dictionary that is learned from all of them."""
    requests = t.v_requests.select("request_id", "query")
    cut = segment.dictionary_words(segment.dictionary(segment.learned_words(requests, "query")))
    df = requests.select("request_id", cut(F.col("query")).alias("w"))
    return df.select("request_id", F.size("w").cast("long").alias("n"), F.md5(F.array_join("w", "|")).alias("digest"))


@query("pluggable_tokenizer", f"""WITH {NODES} SELECT original_index, len(w) AS n, md5(array_to_string(w, '|')) AS digest
FROM (SELECT original_index, list_filter(string_split(doc2, ' '), lambda x: x <> '') AS w FROM nodes)""")
def pluggable_tokenizer(t):
    """A word function supplied as an Arrow UDF in place of the built-in one."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(texts: pd.Series) -> pd.Series:
        return texts.str.split()

    df = nodes(t).select("original_index", cut(F.col("doc2")).alias("w"))
    return df.select("original_index", F.size("w").alias("n"), F.md5(F.array_join("w", "|")).alias("digest"))


@query("shingles", f"""WITH {GRAMS} SELECT original_index, len(g) AS n, md5(array_to_string(list_sort(g), '|')) AS digest FROM grams""")
def shingles(t):
    df = nodes(t).select("original_index", tx.shingles(F.col("doc2")).alias("g"))
    return df.select("original_index", F.size("g").alias("n"), F.md5(F.array_join(F.array_sort("g"), "|")).alias("digest"))


@query("md5_int", """SELECT doc_id, md5(text) AS digest, ('0x' || substr(md5(text), 1, 15))::BIGINT AS high, ('0x' || substr(md5(text), 18, 15))::BIGINT AS low FROM documents""")
def md5_int(t):
    digest = F.md5("text")
    half = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    return t.documents.select("doc_id", digest.alias("digest"), half(1).alias("high"), half(18).alias("low"))


@query("minhash_signature", f"""WITH {GRAMS}, {sig('nodes')} SELECT original_index, len(sig) AS n, sig[1] AS first, md5(array_to_string(sig, '|')) AS digest FROM sig""")
def minhash_signature(t):
    df = dedup.signed_items(nodes(t)).withColumnRenamed("sig", "s")
    return df.select("original_index", F.size("s").alias("n"), F.element_at("s", 1).alias("first"), F.md5(F.array_join("s", "|")).alias("digest"))


@query("simhash", f"WITH {WORDS}, {SIM} SELECT original_index, h AS simhash FROM sim")
def simhash(t):
    return nodes(t).select("original_index", "simhash")


# ---- pair similarities ------------------------------------------------------------------------


@query("edit_similarity", f"""WITH {NODES}, {PAIRS} SELECT p.a, p.b, round(CASE WHEN x.title2 = '' OR y.title2 = '' THEN 0
ELSE 1 - levenshtein(x.title2, y.title2)::DOUBLE / greatest(length(x.title2), length(y.title2)) END, 6) AS edit
FROM pairs p JOIN nodes x ON x.original_index = p.a JOIN nodes y ON y.original_index = p.b""")
def edit_similarity(t):
    return final(news_pairs(t).select("a", "b", tx.edit_similarity(F.col("a_title2"), F.col("b_title2")).alias("edit")))


@query("tfidf_cosine_pair", f"WITH {NODES}, {PAIRS}, {cosines('pairs')} SELECT a, b, round(cos, 6) AS cosine FROM titles")
def tfidf_cosine_pair(t):
    return final(news_pairs(t, "counts").select("a", "b", tx.tfidf_cosine(F.col("a_counts"), F.col("b_counts")).alias("cosine")))


@query("title_similarity", f"WITH {NODES}, {PAIRS}, {cosines('pairs')} SELECT a, b, round((edit + cos) / 2, 6) AS similarity FROM titles")
def title_similarity(t):
    similarity = tx.title_similarity(F.col("a_title2"), F.col("b_title2"), F.col("a_counts"), F.col("b_counts"))
    return final(news_pairs(t, "counts").select("a", "b", similarity.alias("similarity")))


def signature_pairs(t):
    """Pairs with the number of salts at which the signatures agree. Texts are neither stored nor moved for them."""
    left = materialize(dedup.packed_items(nodes(t), tx.words, "title2"), "minhash")
    free_shuffles(t.spark)  # the texts have been moved once; pairs move signatures only
    pairs = with_sides(left.select("original_index", "title2")).select("a", "b")
    a = left.select(F.col("original_index").alias("a"), F.col("sig").alias("sig_a"))
    b = left.select(F.col("original_index").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", tx.equal_places(F.col("sig_a"), F.col("sig_b")).alias("equal"))


OVERLAP = f"""WITH {GRAMS}, {PAIRS}, {sig('nodes')} SELECT p.a, p.b, @@ FROM pairs p JOIN sig x ON x.original_index = p.a JOIN sig y ON y.original_index = p.b"""


@query("minhash_jaccard", OVERLAP.replace("@@", f"({EQUAL} * 128)::BIGINT AS equal_positions"))
def minhash_jaccard(t):
    return signature_pairs(t).select("a", "b", F.col("equal").cast("long").alias("equal_positions"))


@query("content_overlap", OVERLAP.replace("@@", f"{EQUAL} AS overlap, {EQUAL} > 0.75 AS passes"))
def content_overlap(t):
    overlap = F.col("equal") / tx.PERMUTATIONS
    return signature_pairs(t).select("a", "b", overlap.alias("overlap"), (overlap > tx.CONTENT_THRESHOLD).alias("passes"))


@query("shingle_jaccard_exact", f"""WITH {GRAMS}, {PAIRS} SELECT p.a, p.b,
round(len(list_intersect(x.g, y.g))::DOUBLE / (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g))), 6) AS jaccard
FROM pairs p JOIN grams x ON x.original_index = p.a JOIN grams y ON y.original_index = p.b""")
def shingle_jaccard_exact(t):
    df = news_pairs(t, "doc2").select("a", "b", tx.shingles(F.col("a_doc2")).alias("x"), tx.shingles(F.col("b_doc2")).alias("y"))
    return final(df.select("a", "b", tx.shingle_jaccard(F.col("x"), F.col("y")).alias("jaccard")))


HAM = f"""WITH {WORDS}, {SIM}, {PAIRS} SELECT p.a, p.b, bit_count(xor(x.h, y.h))::INT AS distance@@
FROM pairs p JOIN sim x ON x.original_index = p.a JOIN sim y ON y.original_index = p.b"""


@query("hamming_distance", HAM.replace("@@", ""))
def hamming_distance(t):
    return news_pairs(t, "simhash").select("a", "b", tx.hamming(F.col("a_simhash"), F.col("b_simhash")).alias("distance"))


@query("semantic_distance", HAM.replace("@@", ", bit_count(xor(x.h, y.h)) <= 3 AS near"))
def semantic_distance(t):
    distance = tx.hamming(F.col("a_simhash"), F.col("b_simhash"))
    return news_pairs(t, "simhash").select("a", "b", distance.alias("distance"), (distance <= tx.SIMHASH_THRESHOLD).alias("near"))


@query("is_duplicate", f"""WITH {GRAMS}, {SIM}, {PAIRS}, {cosines('pairs')}, {sig('nodes')}
SELECT p.a, p.b, (edit + cos) / 2 > 0.8 AND {EQUAL} > 0.75 AND bit_count(xor(u.h, v.h)) <= 3 AS duplicate
FROM pairs p JOIN titles USING (a, b) JOIN sig x ON x.original_index = p.a JOIN sig y ON y.original_index = p.b
JOIN sim u ON u.original_index = p.a JOIN sim v ON v.original_index = p.b""")
def is_duplicate(t):
    """The three tests on each listed pair; MinHash only for pairs that pass the two cheap ones."""
    left = stored_nodes(t, "simhash", "counts")
    close = (tx.hamming(F.col("a_simhash"), F.col("b_simhash")) <= tx.SIMHASH_THRESHOLD).alias("near")
    pairs = materialize(with_sides(left.drop("counts")).select("a", "b", close), "listed")
    near = pairs.where("near").select("a", "b")
    passed = dedup.similar_content(dedup.similar_titles(near, left), dedup.SignatureStore(items_of(t))).withColumn("hit", F.lit(True))
    return pairs.join(passed, ["a", "b"], "left").select("a", "b", F.coalesce("hit", F.lit(False)).alias("duplicate"))


# ---- near-duplicate removal -------------------------------------------------------------------

EDGES = f"""WITH RECURSIVE {GRAMS}, {SIM},
near AS MATERIALIZED (SELECT x.original_index AS a, y.original_index AS b FROM sim x JOIN sim y ON x.original_index < y.original_index AND bit_count(xor(x.h, y.h)) <= 3),
{cosines('near')},
alike AS MATERIALIZED (SELECT a, b FROM titles WHERE (edit + cos) / 2 > 0.8),
involved AS (SELECT a AS original_index FROM alike UNION SELECT b FROM alike),
{sig('involved')},
edges AS MATERIALIZED (SELECT a, b FROM alike JOIN sig x ON x.original_index = a JOIN sig y ON y.original_index = b WHERE {EQUAL} > 0.75),
ordered AS MATERIALIZED (SELECT b, list(a) AS earlier, row_number() OVER (ORDER BY b) AS rn FROM edges GROUP BY b),
scan(rn, dropped) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
  SELECT o.rn, CASE WHEN len(list_filter(o.earlier, lambda x: NOT list_contains(s.dropped, x))) > 0 THEN list_append(s.dropped, o.b) ELSE s.dropped END
  FROM scan s JOIN ordered o ON o.rn = s.rn + 1),
gone AS MATERIALIZED (SELECT unnest(dropped) AS original_index FROM (SELECT dropped FROM scan ORDER BY rn DESC LIMIT 1))"""


@query("dedup_pair_join", EDGES + """ SELECT b AS original_index, min(a) AS duplicate_of FROM edges
WHERE b IN (SELECT original_index FROM gone) AND a NOT IN (SELECT original_index FROM gone) GROUP BY b""")
def dedup_pair_join(t):
    """Each dropped item with the earliest kept item it duplicates."""
    return dedup.deduplicate(items(t), with_matches=True, items_of=items_of(t)).matches


@query("dedup_greedy", EDGES + " SELECT original_index, md5(doc) AS doc, title FROM items WHERE original_index NOT IN (SELECT original_index FROM gone)")
def dedup_greedy(t):
    build = lambda rows: news.news_items(rows, spread=True)
    return dedup.deduplicated_rows(t.v_news, build).select("original_index", F.md5("doc").alias("doc"), "title")


@query("dedup_stats", EDGES + """ SELECT (SELECT count(*) FROM items) AS original, (SELECT count(*) FROM gone) AS duplicates,
(SELECT count(*) FROM items) - (SELECT count(*) FROM gone) AS kept""")
def dedup_stats(t):
    found = dedup.deduplicate(items(t), items_of=items_of(t))
    return dedup.dedup_stats(found.items, found.dropped)


CORPUS = EDGES + " SELECT original_index, md5(doc) AS doc, title, labels, stock_symbol FROM items WHERE original_index NOT IN (SELECT original_index FROM gone)"


@query("dedup_pipeline", CORPUS)
@query("dedup_corpus", CORPUS)  # the earlier name of the same chain
def dedup_corpus(t):
    """CSV to normalised items to kept items to JSON lines, read back."""
    rows = files.read_csv(t.spark, news_csv(t), files.NEWS_CSV)
    kept, path = dedup.deduplicated_rows(rows, news.news_items), scratch_path(t.spark, "deduplicated")
    files.write_jsonl(kept, path)
    return files.read_jsonl(t.spark, path, kept.schema).select("original_index", F.md5("doc").alias("doc"), "title", "labels", "stock_symbol")


# ---- envelopes, titles, top-k -----------------------------------------------------------------

TOP = "SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos) AS rn FROM v_crawl"


@query("topk_news", f"SELECT query, pos, title FROM ({TOP}) WHERE rn <= 10")
def topk_news(t):
    return news.top_items(t.v_crawl, news.clamp_limit(50)).select("query", "pos", "title")


@query("sink_news_json", f"""SELECT query, md5(json_object('query', query, 'count', count(*), 'news',
  list(json_object('title', title, 'content', content, 'published_at', published_at, 'source', source, 'url', url) ORDER BY pos))::VARCHAR) AS digest, count(*) AS n
FROM ({TOP}) WHERE rn <= 4 GROUP BY query UNION ALL SELECT 'nothing', md5('{{"query":"nothing","count":0,"news":[]}}'), 0""")
def sink_news_json(t):
    asked = t.v_crawl.select("query").unionByName(t.region.select(F.lit("nothing").alias("query")))
    envelopes = news.news_envelopes(t.v_crawl, 4, asked)
    return envelopes.select("query", F.md5("envelope").alias("digest"), F.get_json_object("envelope", "$.count").cast("long").alias("n"))


@query("news_json_parse", f"SELECT query, (rn - 1)::INT AS pos, title, md5(content) AS content, published_at, source, url FROM ({TOP}) WHERE rn <= 10")
def news_json_parse(t):
    return news.parse_envelopes(news.news_envelopes(t.v_crawl, 10)).withColumn("content", F.md5("content"))


@query("dedup_exact_title", "SELECT title, min(pos) AS pos FROM v_crawl GROUP BY title")
def dedup_exact_title(t):
    return news.first_by_title(t.v_crawl).select("title", "pos")


STOPPED = """(SELECT pos, query, content, CASE WHEN pos % 31 = 0 THEN title || '百度百科' WHEN pos % 37 = 0 THEN 'ab' ELSE title END AS title FROM v_crawl)"""


@query("filter_news_titles", f"""SELECT query, pos, title FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos) AS rn FROM
(SELECT query, title, min(pos) AS pos FROM {STOPPED} WHERE length(title) >= 3 AND NOT regexp_matches(title, '官方网站|百度百科|移动官网') GROUP BY query, title)) WHERE rn <= 8""")
def filter_news_titles(t):
    marked = t.v_crawl.withColumn(
        "title", F.when(F.col("pos") % 31 == 0, F.concat("title", F.lit("百度百科"))).when(F.col("pos") % 37 == 0, "ab").otherwise(F.col("title"))
    )
    return news.filter_titles(marked, 8).select("query", "pos", "title")


@query("select_max_three", """SELECT query, pos, title FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos) AS rn FROM
(SELECT query, title, min(pos) AS pos FROM v_crawl WHERE trim(content) <> '' GROUP BY query, title)) WHERE rn <= 3""")
def select_max_three(t):
    return news.select_for_scoring(t.v_crawl).select("query", "pos", "title")


def _stub_sql(step: int) -> str:
    logits = "[" + ", ".join(f"((length(text) + length(source)) * {k + step} % 17) / 4.0" for k in range(5)) + "]"
    return f"(SELECT doc_id, lang, {logits} AS lg FROM documents)"


def _best_sql(alias: str) -> str:
    return f"list_position({alias}.lg, list_max({alias}.lg))::INT"


def _probability_sql(alias: str, k: int) -> str:
    total = f"list_sum(list_transform({alias}.lg, lambda q: exp(q - list_max({alias}.lg))))"
    return f"round(exp({alias}.lg[{k}] - list_max({alias}.lg)) / {total}, 4)"


def stub_model(step: int):
    """Stands for a user's model in the query below: logits from the text length."""

    def load():
        def predict(symbols, summaries):
            sizes = summaries.str.len() + symbols.str.len()
            return [[float((int(n) * (k + step)) % 17) / 4.0 for k in range(5)] for n in sizes]

        return predict

    return load


@query("score_news_batch", f"""SELECT x.doc_id, {_best_sql('x')} AS sentiment, {_best_sql('y')} AS risk,
{_probability_sql('x', 5)} AS p_sentiment_5, {_probability_sql('y', 1)} AS p_risk_1 FROM {_stub_sql(3)} x JOIN {_stub_sql(7)} y USING (doc_id)""")
def score_news_batch(t):
    rows = t.documents.select("doc_id", F.col("source").alias("stock_symbol"), F.col("text").alias("summary"))
    scored = scoring.score_news(rows, stub_model(3), stub_model(7))
    return scored.select(
        "doc_id", F.col("sentiment.score").alias("sentiment"), F.col("risk.score").alias("risk"),
        F.col("sentiment.probabilities")["5"].alias("p_sentiment_5"), F.col("risk.probabilities")["1"].alias("p_risk_1"),
    )


@query("softmax_candidates", f"""SELECT doc_id, {_best_sql('x')} AS score, {', '.join(f"{_probability_sql('x', k)} AS p{k}" for k in range(1, 6))} FROM {_stub_sql(5)} x""")
def softmax_candidates(t):
    size = F.length("text") + F.length("source")
    logits = F.array(*[((size * (k + 5)) % 17) / 4.0 for k in range(5)])
    df = t.documents.select("doc_id", logits.alias("lg")).select("doc_id", scoring.softmax_score(F.col("lg")).alias("s"))
    return df.select("doc_id", "s.score", *[F.col("s.probabilities")[str(k)].alias(f"p{k}") for k in range(1, 6)])
