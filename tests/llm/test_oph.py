import hashlib
import random
import re

from tickerloom.llm import oph


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def documents(n=80, seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé😀") for _ in range(5)) for _ in range(200)]
    rows = [(rng.randint(0, 10**6), " ".join(rng.choice(words) for _ in range(rng.choice([0, 2, 5, 30, 300])))) for _ in range(n)]
    return [*rows, (None, "no key here at all"), (None, None), (7, ""), (7, "tie of keys"), (8, "same"), (8, "same"), (9, "w " * 20_000)]


def test_fingerprints_and_likeness(frame):
    rows = documents()
    got = oph.fingerprint_documents(frame(rows)).collect()
    assert len(got) == len(rows)
    ordered = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want, near = {}, {}
    for i, (k, t) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + following[:third]
        key = (k, len(t), hashlib.sha256(edited.encode()).hexdigest())
        want[key] = want.get(key, 0) + 1
        near[key] = (likeness(t, edited), likeness(t, following))
    found = {}
    errors = []
    for r in got:
        key = (r.doc_id, r.n_chars, r.edited_sha256)
        found[key] = found.get(key, 0) + 1
        errors += [abs(r.near_edited - near[key][0]), abs(r.near_next - near[key][1])]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and re.fullmatch("[0-9a-f]{256}", r.fingerprint)
    assert found == want
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03


def test_no_python_and_equal_texts(frame):
    df = oph.fingerprint_documents(frame([(1, "One two three four five six"), (2, "one TWO\nthree  four five six"), (3, "one two")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    by_key = {r.doc_id: r for r in df.collect()}
    assert by_key[1].fingerprint == by_key[2].fingerprint != by_key[3].fingerprint
    assert by_key[2].near_next == 1.0


def test_empty_and_single(frame):
    assert oph.fingerprint_documents(frame([])).count() == 0
    (row,) = oph.fingerprint_documents(frame([(1, "abcdef")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0
