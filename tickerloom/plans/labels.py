"""Queries over labelled rows: cleaning, sampling, splits, prompts, masks, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickerloom.functions import outputs, prompts
from tickerloom.operators import labels, masking, metrics
from tickerloom.plans.registry import query
from tickerloom.plans.shape import final

SEED, N, SHARE = 42, 150, 0.1

CLEAN = """clean AS MATERIALIZED (SELECT row_id, "Lsa_summary", coalesce("Stock_symbol", 'STOCK') AS "Stock_symbol", trunc(x)::INT AS label
  FROM (SELECT *, TRY_CAST(label_raw AS DOUBLE) AS x FROM v_labels) WHERE "Lsa_summary" IS NOT NULL AND x >= 1 AND x < 6)"""


def clean(t):
    return labels.clean_labels(t.v_labels)


def narrow(t):
    return clean(t).select("row_id", "label", "Stock_symbol")


@query("filter_label_valid", """SELECT row_id, trunc(x)::INT AS label FROM (SELECT *, TRY_CAST(label_raw AS DOUBLE) AS x FROM v_labels)
WHERE "Lsa_summary" IS NOT NULL AND x IS NOT NULL AND trunc(x) BETWEEN 1 AND 5""")
def filter_label_valid(t):
    return labels.valid_labels(t.v_labels).select("row_id", "label")


@query("filter_label_legacy", """SELECT row_id, TRY_CAST(label_raw AS DOUBLE) AS label FROM (SELECT * FROM v_labels ORDER BY row_id LIMIT 1000)
WHERE "Lsa_summary" IS NOT NULL AND TRY_CAST(label_raw AS DOUBLE) <> 0""")
def filter_label_legacy(t):
    return labels.legacy_labels(t.v_labels).select("row_id", "label")


@query("fill_defaults", """SELECT row_id, coalesce("Stock_symbol", 'STOCK') AS "Stock_symbol" FROM v_labels""")
def fill_defaults(t):
    return labels.fill_defaults(t.v_labels).select("row_id", "Stock_symbol")


@query("guard_min_rows", f"WITH {CLEAN} SELECT count(*) AS n FROM clean HAVING count(*) >= 20")
def guard_min_rows(t):
    return labels.row_guard(clean(t))


@query("label_distribution", f"WITH {CLEAN} SELECT label, count(*) AS n FROM clean GROUP BY label")
def label_distribution(t):
    return labels.distribution(clean(t))


@query("label_set", f"WITH {CLEAN} SELECT DISTINCT label FROM clean")
def label_set(t):
    return labels.label_set(clean(t))


QUOTA = f"""{CLEAN}, sized AS (SELECT label, count(*) AS size FROM clean GROUP BY label),
asked AS (SELECT *, row_number() OVER (ORDER BY label) - 1 AS position, {N} // (SELECT count(*) FROM sized) + CASE WHEN row_number() OVER (ORDER BY label) - 1 < {N} % (SELECT count(*) FROM sized) THEN 1 ELSE 0 END AS requested FROM sized),
quota AS (SELECT *, least(requested, size) AS take, {N} - sum(least(requested, size)) OVER () AS shortfall FROM asked)"""


@query("balanced_quota", f"WITH {QUOTA} SELECT label, size, position, requested::BIGINT AS requested, take::BIGINT AS take, shortfall::BIGINT AS shortfall FROM quota")
def balanced_quota(t):
    df = labels.quotas(clean(t), N)
    return df.select("label", "size", *[F.col(c).cast("long").alias(c) for c in ("position", "requested", "take", "shortfall")])


CHOSEN = f"""{QUOTA}, ranked AS (SELECT c.row_id, c.label, take, shortfall, row_number() OVER (PARTITION BY c.label ORDER BY md5((c.label + {SEED})::VARCHAR || ':' || c.row_id), c.row_id) AS rn
  FROM clean c JOIN quota q ON q.label = c.label),
chosen AS (SELECT row_id, label FROM ranked WHERE rn <= take),
filling AS (SELECT row_id, label FROM (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || row_id), row_id) AS f FROM ranked WHERE rn > take) WHERE f <= shortfall)"""


@query("select_by_index", f'WITH {CHOSEN} SELECT row_id, label, "Stock_symbol" FROM clean JOIN chosen USING (row_id, label)')
def select_by_index(t):
    rows = narrow(t)
    return labels.select_by_id(rows, labels.quota_rows(rows, N, SEED))


@query("sample_remainder_anti", f'WITH {CHOSEN} SELECT row_id, label, "Stock_symbol" FROM clean WHERE row_id NOT IN (SELECT row_id FROM chosen)')
def sample_remainder_anti(t):
    rows = narrow(t)
    return labels.remainder(rows, labels.quota_rows(rows, N, SEED))


@query("union_selected", f"WITH {CHOSEN} SELECT row_id, label FROM chosen UNION ALL SELECT row_id, label FROM filling")
def union_selected(t):
    return labels.sample_balanced(narrow(t), N, SEED).select("row_id", "label")


@query("sample_balanced", f"""WITH {CHOSEN} SELECT row_id, label, row_number() OVER (ORDER BY md5('{SEED}:' || row_id), row_id) AS shuffle_pos
FROM (SELECT * FROM chosen UNION ALL SELECT * FROM filling)""")
def sample_balanced(t):
    return labels.sample_balanced(narrow(t), N, SEED).select("row_id", "label", "shuffle_pos")


@query("sample_head", f"WITH {CLEAN} SELECT row_id, label FROM clean ORDER BY row_id LIMIT {N}")
def sample_head(t):
    return labels.head(narrow(t), N).select("row_id", "label")


@query("sample_random", f"WITH {CLEAN} SELECT row_id, label FROM clean ORDER BY md5('{SEED}:' || row_id), row_id LIMIT {N}")
def sample_random(t):
    return labels.sample_random(narrow(t), N, SEED).select("row_id", "label")


@query("shuffle_rows", f"WITH {CLEAN} SELECT row_id, label, row_number() OVER (ORDER BY md5('{SEED}:' || row_id), row_id) AS shuffle_pos FROM clean")
def shuffle_rows(t):
    return labels.select_rows(narrow(t), 0, "random", SEED).select("row_id", "label", "shuffle_pos")


@query("stratify_feasible", f"""WITH {CLEAN}, c AS (SELECT count(*) AS n FROM clean GROUP BY label),
s AS (SELECT sum(n)::BIGINT AS n, count(*) AS classes, min(n) AS smallest, greatest(1, round_even(sum(n) * {SHARE}, 0)::BIGINT) AS eval_count FROM c)
SELECT n, classes, smallest, eval_count, smallest >= 2 AND eval_count >= classes AND n - eval_count >= classes AS can_stratify FROM s""")
def stratify_feasible(t):
    return labels.stratify_check(clean(t), SHARE)


@query("split_stratified", f"""WITH {CLEAN}, c AS (SELECT label, count(*) AS size, sum(count(*)) OVER () AS n FROM clean GROUP BY label),
e AS (SELECT *, (n - ceil(n * {SHARE})) AS n_train, (n - ceil(n * {SHARE})) * size / n AS exact FROM c),
q AS (SELECT label, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label) <= n_train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS take FROM e)
SELECT row_id, label, CASE WHEN rn <= take THEN 'train' ELSE 'eval' END AS part
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('{SEED}:' || row_id), row_id) AS rn FROM clean) JOIN q USING (label)""")
def split_stratified(t):
    return labels.split_stratified(narrow(t), SHARE, SEED).select("row_id", "label", "part")


@query("split_random", f"""WITH {CLEAN} SELECT row_id, label, CASE WHEN rn <= ceil(n * 0.2) THEN 'eval' ELSE 'train' END AS part
FROM (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || row_id), row_id) AS rn, count(*) OVER () AS n FROM clean)""")
def split_random(t):
    return labels.split_random(narrow(t), labels.LEGACY_EVAL_SHARE, SEED).select("row_id", "label", "part")


# ---- parsed outputs and metrics ---------------------------------------------------------------

FIRST = "nullif(regexp_extract(generated, '(?:^|[^0-9])([1-5])(?:[^0-9]|$)', 1), '')::INT"
TAIL = """(CASE WHEN TRY_CAST(nullif(regexp_extract(list_extract(string_split(generated, 'Assistant:'), -1), '^\\s*(\\S+)', 1), '') AS INT) BETWEEN 1 AND 5
THEN TRY_CAST(nullif(regexp_extract(list_extract(string_split(generated, 'Assistant:'), -1), '^\\s*(\\S+)', 1), '') AS INT) END)"""
RATED = f"""{CLEAN}, rated AS MATERIALIZED (SELECT c.row_id, c.label AS truth, {TAIL} AS prediction FROM clean c JOIN v_outputs o ON o.row_id = c.row_id)"""


def rated(t):
    parsed = t.v_outputs.select("row_id", outputs.tail_score(F.col("generated")).alias("prediction"))
    return narrow(t).select("row_id", F.col("label").alias("truth")).join(parsed, "row_id")


@query("parse_score_regex", f"SELECT row_id, {FIRST} AS score FROM v_outputs")
def parse_score_regex(t):
    return t.v_outputs.select("row_id", outputs.first_score(F.col("generated")).alias("score"))


@query("parse_score_tail", f"SELECT row_id, {TAIL} AS score FROM v_outputs")
def parse_score_tail(t):
    return t.v_outputs.select("row_id", outputs.tail_score(F.col("generated")).alias("score"))


@query("score_label_map", f"""SELECT row_id, ['负面', '轻微负面', '中性', '正面', '极正面'][{TAIL}] AS sentiment,
coalesce({TAIL}::VARCHAR || ' (' || ['极低风险', '低风险', '中等风险', '高风险', '极高风险'][{TAIL}] || ')', '无法分析风险') AS risk FROM v_outputs""")
def score_label_map(t):
    score = F.col("score")
    return t.v_outputs.select("row_id", outputs.tail_score(F.col("generated")).alias("score")).select(
        "row_id", outputs.score_text(score, outputs.SENTIMENT_TEXTS).alias("sentiment"),
        outputs.score_with_text(score, outputs.RISK_TEXTS, outputs.RISK_FAILED).alias("risk"),
    )


HIT = "coalesce((prediction = truth)::INT, 0)"


@query("accuracy", f"WITH {RATED} SELECT round(avg({HIT}), 6) AS accuracy, count(*) AS n FROM rated")
def accuracy(t):
    return final(metrics.accuracy(rated(t)))


@query("accuracy_valid_only", f"WITH {RATED} SELECT sum({HIT})::BIGINT AS correct, count(*) AS total, round(avg({HIT}) * 100, 6) AS accuracy FROM rated WHERE prediction IS NOT NULL")
def accuracy_valid_only(t):
    return final(metrics.accuracy_valid_only(rated(t)))


@query("accuracy_per_class", f"WITH {RATED} SELECT truth, sum({HIT})::BIGINT AS correct, count(*) AS total, round(avg({HIT}) * 100, 6) AS accuracy FROM rated GROUP BY truth")
def accuracy_per_class(t):
    return final(metrics.accuracy_per_class(rated(t)))


@query("within_one_accuracy", f"WITH {RATED} SELECT round(avg(coalesce((abs(prediction - truth) <= 1)::INT, 0)), 6) AS within_one FROM rated")
def within_one_accuracy(t):
    return final(metrics.within_one(rated(t)))


@query("invalid_count", f"WITH {RATED} SELECT count(*) FILTER (WHERE prediction IS NULL) AS invalid, count(*) AS total FROM rated")
def invalid_count(t):
    return metrics.invalid_count(rated(t))


@query("confusion_matrix", f"""WITH {RATED} SELECT l.truth::INT AS truth, {', '.join(f'count(*) FILTER (WHERE prediction = {x}) AS pred_{x}' for x in range(1, 6))}
FROM range(1, 6) l(truth) LEFT JOIN rated r ON r.truth = l.truth GROUP BY l.truth""")
def confusion_matrix(t):
    return metrics.confusion_matrix(rated(t))


@query("classification_report", f"""WITH {RATED}, k AS (SELECT l.x, count(*) FILTER (WHERE truth = l.x AND prediction = l.x) AS tp,
  count(*) FILTER (WHERE prediction = l.x) AS pr, count(*) FILTER (WHERE truth = l.x) AS support FROM range(1, 6) l(x), rated GROUP BY l.x),
m AS (SELECT x::VARCHAR AS label, tp, pr, support FROM k UNION ALL SELECT 'micro avg', sum(tp), sum(pr), sum(support) FROM k),
s AS (SELECT label, CASE WHEN pr = 0 THEN 0 ELSE tp / pr END AS precision, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, support FROM m),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM s)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f WHERE label <> 'micro avg'
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f WHERE label <> 'micro avg'""")
def classification_report(t):
    return final(metrics.classification_report(rated(t)))


# ---- prompts, masks, batches ------------------------------------------------------------------


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


USER = "'Stock symbol: ' || \"Stock_symbol\" || chr(10) || 'Summarized news: ' || \"Lsa_summary\""
LEGACY = f"{sql_text(prompts.legacy_head('risk'))} || 'User: News to Stock Symbol -- ' || \"Stock_symbol\" || ': ' || \"Lsa_summary\" || chr(10) || 'Assistant:'"


@query("prompt_messages", f"""WITH {CLEAN} SELECT row_id, 2 AS n, 'system,user' AS roles, {sql_text(prompts.SYSTEM['sentiment'])} AS system_text, md5({USER}) AS user_digest FROM clean""")
def prompt_messages(t):
    m = prompts.messages("sentiment", F.col("Stock_symbol"), F.col("Lsa_summary"))
    df = clean(t).select("row_id", m.alias("m"))
    return df.select(
        "row_id", F.size("m").alias("n"), F.array_join("m.role", ",").alias("roles"),
        F.col("m")[0]["content"].alias("system_text"), F.md5(F.col("m")[1]["content"]).alias("user_digest"),
    )


@query("prompt_fewshot", f"WITH {CLEAN} SELECT row_id, md5({LEGACY}) AS asked, md5({LEGACY} || ' ' || label::VARCHAR) AS answered FROM clean")
def prompt_fewshot(t):
    asked = prompts.legacy_conversation("risk", F.col("Stock_symbol"), F.col("Lsa_summary"))
    answered = prompts.legacy_conversation("risk", F.col("Stock_symbol"), F.col("Lsa_summary"), F.col("label"))
    return clean(t).select("row_id", F.md5(asked).alias("asked"), F.md5(answered).alias("answered"))


MAX_LENGTH = 600


def examples(t):
    prompt = prompts.user_content(F.col("Stock_symbol"), F.col("Lsa_summary"))
    encoded = masking.encode_completion(prompt, F.col("label").cast("string"), MAX_LENGTH)
    return clean(t).select("row_id", "label", encoded.alias("e")).select("row_id", "label", "e.*")


def codes(x: str) -> str:
    return f"list_transform(list_filter(string_split({x}, ''), lambda c: c <> ''), lambda c: unicode(c))"


ENCODED = f"""{CLEAN}, ids AS (SELECT row_id, label, list_slice({codes(USER)}, 1, {MAX_LENGTH - 2}) AS p, list_concat({codes('label::VARCHAR')}, [2]) AS a FROM clean),
encoded AS (SELECT row_id, label, list_concat(p, a) AS input_ids, list_concat(list_transform(p, lambda x: -100), a) AS labels FROM ids)"""


@query("encode_completion_mask", f"""WITH {ENCODED} SELECT row_id, len(input_ids) AS n, len(input_ids) AS attended, md5(array_to_string(input_ids, ',')) AS ids_digest,
md5(array_to_string(labels, ',')) AS labels_digest FROM encoded""")
def encode_completion_mask(t):
    attended = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return examples(t).select(
        "row_id", F.size("input_ids").alias("n"), attended.alias("attended"),
        F.md5(F.array_join("input_ids", ",")).alias("ids_digest"), F.md5(F.array_join("labels", ",")).alias("labels_digest"),
    )


L = 1600


@query("legacy_answer_mask", f"""WITH {CLEAN}, texts AS (SELECT row_id, CASE WHEN row_id % 10 = 0 THEN "Lsa_summary" ELSE {LEGACY} || ' ' || label::VARCHAR END AS x FROM clean),
pos AS (SELECT *, CASE WHEN contains(x, 'Assistant: ') THEN length(x) - strpos(reverse(x), reverse('Assistant: ')) + 1 ELSE NULL END AS mask, list_slice({codes('x')}, 1, {L}) AS kept FROM texts),
cuts AS (SELECT *, len(kept) AS actual, CASE WHEN mask IS NULL THEN len(kept) WHEN mask <= len(kept) THEN mask
  WHEN list_contains(kept, 65) THEN least(len(kept) - list_position(list_reverse(kept), 65) + 12, len(kept)) ELSE 0 END AS cut FROM pos)
SELECT row_id, actual::INT AS actual_length, md5(array_to_string(list_concat(kept, list_transform(range({L} - actual), lambda q: 0)), ',')) AS ids_digest,
md5(array_to_string(list_concat(list_transform(range(cut), lambda q: -100), list_slice(kept, cut + 1, actual), list_transform(range({L} - actual), lambda q: -100)), ',')) AS labels_digest FROM cuts""")
def legacy_answer_mask(t):
    answered = prompts.legacy_conversation("risk", F.col("Stock_symbol"), F.col("Lsa_summary"), F.col("label"))
    text = F.when(F.col("row_id") % 10 == 0, F.col("Lsa_summary")).otherwise(answered)
    df = clean(t).select("row_id", text.alias("x")).select("row_id", masking.legacy_answer(F.col("x"), L).alias("e"))
    return df.select(
        "row_id", "e.actual_length", F.md5(F.array_join("e.input_ids", ",")).alias("ids_digest"), F.md5(F.array_join("e.labels", ",")).alias("labels_digest")
    )


@query("pad_batch", f"""WITH {ENCODED}, placed AS (SELECT *, (row_number() OVER (ORDER BY md5('{SEED}:' || row_id), row_id) - 1) // 4 AS batch FROM encoded),
wide AS (SELECT *, (ceil(max(len(input_ids)) OVER (PARTITION BY batch) / 8.0) * 8)::INT AS width FROM placed)
SELECT row_id, batch::BIGINT AS batch, width, md5(array_to_string(list_concat(input_ids, list_transform(range(width - len(input_ids)), lambda q: 0)), ',')) AS ids_digest,
md5(array_to_string(list_concat(labels, list_transform(range(width - len(input_ids)), lambda q: -100)), ',')) AS labels_digest, len(input_ids) AS attended FROM wide""")
def pad_batch(t):
    padded = masking.pad_batches(labels.shuffled(examples(t), SEED), "shuffle_pos", 4)
    attended = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return padded.select(
        "row_id", "batch", "width", F.md5(F.array_join("input_ids", ",")).alias("ids_digest"),
        F.md5(F.array_join("labels", ",")).alias("labels_digest"), attended.alias("attended"),
    )
