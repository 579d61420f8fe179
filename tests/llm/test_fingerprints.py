import hashlib
from collections import Counter

from tests.llm.cases import DOCS, documents, prose, spaced_words
from wardline.llm.fingerprints import BLANK, SAMPLES, fingerprint_documents


def jaccard(a, b):
    a, b = Counter(spaced_words(a)), Counter(spaced_words(b))
    return sum((a & b).values()) / sum((a | b).values())


def edited(text, following):
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def test_edited_texts_and_order(spark):
    rows = [(n, t or "", s) for n, (_, t, s) in enumerate(DOCS)]
    got = {r["doc_id"]: r for r in fingerprint_documents(documents(spark, rows)).collect()}
    order = sorted((r[0] for r in rows), reverse=True)
    texts = {r[0]: r[1] for r in rows}
    for n, doc_id in enumerate(order):
        following = order[(n + 1) % len(order)]
        r, text = got[doc_id], edited(texts[doc_id], texts[following])
        assert r["n_chars"] == len(texts[doc_id])
        assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        same = got[following]["fingerprint"] == r["fingerprint"]
        assert (texts[doc_id] == texts[following]) <= same and (not same or r["near_next"] == 1.0)
        assert (r["fingerprint"] == BLANK) == (not spaced_words(texts[doc_id]))
        assert (r["edited_fingerprint"] == BLANK) == (not spaced_words(text))
        assert 0 <= r["near_edited"] <= 1


def test_likeness_is_the_generalised_jaccard_similarity(spark):
    rows = [(n, prose(30 + n % 50, n // 2) + " the the the" * (n % 7), "s") for n in range(240)]
    got = {r["doc_id"]: r for r in fingerprint_documents(documents(spark, rows, clash=False)).collect()}
    near = [(got[n]["near_edited"], jaccard(t, edited(t, rows[n - 1][1]))) for n, t, _ in rows]
    near += [(got[n]["near_next"], jaccard(t, rows[n - 1][1])) for n, t, _ in rows]
    off = [a - b for a, b in near]
    spread = sum(b * (1 - b) for _, b in near) / SAMPLES / len(near)
    assert abs(sum(off) / len(off)) < 4 * (spread / len(near)) ** 0.5
    assert 0.7 * spread < sum(x * x for x in off) / len(off) < 1.4 * spread


def test_repeated_rows_null_ids_and_nulls(spark):
    got = fingerprint_documents(documents(spark)).collect()
    assert len(got) == len(DOCS)
    assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in DOCS)
    copies = [r for r in got if r["doc_id"] == 5]
    assert len({r["fingerprint"] for r in copies}) == 1 and 1.0 in [r["near_next"] for r in copies]


def test_one_row_is_its_own_next(spark):
    r = fingerprint_documents(documents(spark, [(1, "a b c d e f", "s")])).collect()[0]
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"a b c da b").hexdigest() or r["n_chars"] == 11


def test_empty_table(spark):
    assert fingerprint_documents(documents(spark, [])).collect() == []


def test_the_least_and_largest_ids(spark):
    ids = [-(2**63), -(2**63) + 1, 0, 2**63 - 1, None, -(2**63)]
    docs = documents(spark, [(n, prose(20, k), "a") for k, n in enumerate(ids)])
    got = fingerprint_documents(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((n is None, n or 0) for n in ids)
    # The first after the last: the text of a null id is followed by that of the largest.
    texts = {n: prose(20, k) for k, n in enumerate(ids) if n != -(2**63)}
    last = next(r for r in got if r["doc_id"] is None)
    cut = len(texts[None]) // 3
    edited = texts[None][: len(texts[None]) - cut] + texts[2**63 - 1][:cut]
    assert last["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
