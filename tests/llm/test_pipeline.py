import random

import corpus_pipeline
from tickerloom.llm import packing, simhash, suffix, toxicity
from tickerloom.llm.common import table


def test_stages_by_brute_force(spark, tmp_path, ranks):
    letters = "abcdefghij"
    words = ["w" + letters[i // 100] + letters[i // 10 % 10] + letters[i % 10] for i in range(400)]
    text = lambda a, n: " ".join(random.Random(a).choices(words, k=n))
    passage = " ".join(words[i * 11 % 400] for i in range(70))
    docs = [(i, text(i, 90) + (" vilexa grumk zlurb" if i % 5 == 0 else "")) for i in range(150)]
    docs += [(200 + i, text(i, 90)) for i in range(1, 20, 6)]  # exact copies
    docs += [(300 + i, text(i + 400, 40) + " " + passage + " " + text(i + 500, 40)) for i in range(4)]
    docs += [(400, None), (401, ""), (None, "without a key " + text(999, 60))]
    frame = spark.createDataFrame([(k, t, "en", "src0", None if t is None else len(t)) for k, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(150)], "doc_id long, toxic int")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")

    sf, now = str(tmp_path), table(spark, str(tmp_path), "documents")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, now, sf)
    assert clean.columns == now.columns
    kept = {r.doc_id for r in clean.collect()}
    assert not kept & {i for i in range(0, 150, 5)} and len(kept) == 120 + 4 + 4 + 3

    one = stages["near_dedup"](spark, clean, sf)
    prints = {}
    for r in clean.collect():
        prints.setdefault(simhash.fingerprint(r.text), []).append(r.doc_id)
    left = {r.doc_id for r in one.collect()}
    assert one.columns == now.columns and not left & {201, 207, 213, 219} and 1 in left and len(left & {400, 401}) == 1

    cut = stages["suffix_dedup"](spark, one, sf)
    rows = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == now.columns and rows.keys() == left
    for i in range(4):
        assert passage[5:60] not in rows[300 + i].text and rows[300 + i].n_chars == len(rows[300 + i].text)
    assert rows[1].text == docs[1][1]

    packed = stages["packing"](spark, cut, sf)
    assert {r.doc_id for r in packed.collect()} == left
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=str) == sorted(map(tuple, packed.collect()), key=str)
    assert (toxicity, packing, suffix) is not None
