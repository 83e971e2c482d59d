"""The registered queries of the operators, with check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import ann, bpe, bpe_table, decontam, divergence, html_tree, lm, oph, packing, resample, sharding, simhash, suffix, toxicity
from tickerloom.llm.common import table


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(bpe.RANKS)
    coded = bpe_table.decode(bpe_table.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.RANKS))


def op6_html_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_tree.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.RANKS))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = suffix.remove_repeats(docs)
    return cleaned.select(
        "doc_id",
        (F.octet_length("_kept") + F.col("_n_removed")).cast("long").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["to"] - s["from"]))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op12_bit_sliced_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_adaptive_scan,
        op2_simhash_near_dedup,
        op3_byte_bpe,
        op4_one_permutation_minhash,
        op5_attention_lm,
        op6_html_tree_model,
        op7_label_propagation,
        op8_toxicity,
        op9_packing,
        op10_suffix_array_dedup,
        op11_winnowing,
        op12_bit_sliced_resampling,
        op13_source_divergence,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
#: One bit of a CRC-32 table entry per step.
_CRC_STEPS = ",\n".join(f"c{i + 1} AS (SELECT i, xor(c >> 1, 3988292384 * (c & 1)) AS c FROM c{i})" for i in range(8))

CHECKS: dict[str, str] = {
    "op11_winnowing": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
t AS (SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda s: array_to_string(list_slice(w, s, s + 9), ' '))) AS win FROM i WHERE len(w) > 0),
p AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n),
h AS (SELECT r, s, p.n, item FROM (SELECT r, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win FROM p) p JOIN t ON t.win = p.win AND t.n = p.n),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM (SELECT DISTINCT r, s, n FROM h)) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)""",
    "op12_bit_sliced_resampling": f"""WITH c0 AS (SELECT range AS i, range AS c FROM range(256)),
{_CRC_STEPS},
crc AS (SELECT list(c ORDER BY i) AS t FROM c8),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
x AS (SELECT true AS of_doc, r, unnest(w) AS word FROM d UNION ALL SELECT false, 0, unnest({_WORDS}) FROM benchmark),
u AS (SELECT word, hex(word) AS h FROM (SELECT DISTINCT word FROM x)),
k AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 10000 AS b FROM u, crc),
n AS (SELECT b, count(*) FILTER (of_doc) AS s, count(*) FILTER (NOT of_doc) AS t FROM x JOIN k USING (word) GROUP BY b),
a AS (SELECT sum(s)::BIGINT AS ss, sum(t)::BIGINT AS tt FROM n),
g AS (SELECT b, floor(1000 * ln(((t + 1) * (ss + 10000))::DOUBLE / ((s + 1) * (tt + 10000))::DOUBLE))::BIGINT AS gain FROM n, a),
w AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS total FROM x JOIN k USING (word) JOIN g USING (b) WHERE of_doc GROUP BY r),
o AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight, ('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT AS h FROM d LEFT JOIN w USING (r)),
p AS (SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::BIGINT AS score FROM o),
q AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS z, count(*) OVER (PARTITION BY n_features >= 20) AS able FROM p)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND z <= 10 * able // 100 THEN z END::BIGINT AS rank FROM q""",
    "op13_source_divergence": rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS text FROM documents),
x AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM x GROUP BY ALL HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS n_all FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM x GROUP BY ALL),
e AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, k.n AS m FROM s JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
t AS (SELECT lang, source, sum(n) AS n_own FROM e GROUP BY ALL),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (n_own + 5 * v)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (m + 5)) // (n_all + 5 * v)::HUGEINT AS q
  FROM e JOIN t USING (lang, source) JOIN l USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM o)
SELECT lang, source, part, item, value, rank::INT AS rank FROM z WHERE part = 'pair' OR rank <= 50""",
}
