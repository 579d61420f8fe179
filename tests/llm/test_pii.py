import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from tests.llm.cases import DOCS, LONG, documents, prose
from wardline.llm.pii import _apart, discovered, find_identifiers, mark, mask_identifiers

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    worth = [int(d) if n % 2 == 0 else sum(divmod(2 * int(d), 10)) for n, d in enumerate(reversed(digits))]
    return sum(worth) % 10 == 0


def base(text):
    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits or "1"),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s[2] for s in sorted(spans)]


ODD = [
    "a@b.c_d@e.f a@b a@.b @b.c x@y.z.. x@y-.z %+-@q.w",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 9999999999999999999999.1.1.1 1.2.3.4",
    "4337166598464399 4337 1665 9846 4399 4337-1665-9846-4399 43371665984643991 4337  1665 0000000000000000",
    "+1 (578) 555-6437 +12 +1..........2 +44 20 7946 0958 4918187128635271 ++1 234 567 8901- +1-2-3-4-5-6-7-8-9-0-",
    "𝒳 a@b.cd 日本 10.1.2.3 é +1 (578) 555-6437",
    "1" * 30_000,
    "a" * 30_000 + "@",
    "1.1." * 5_000,
    "x@" + "y." * 5_000 + "z",
    "+1" + " " * 20_000,
    "12-" * 4_000,
]


def test_base_spans(spark):
    texts = [t for _, t, _ in DOCS] + ODD
    docs = documents(spark, [(n, t, "s") for n, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in find_identifiers(docs).collect()}
    for n, text in enumerate(texts):
        spans = base(text)
        r = got[n]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), text and text[:60]
        assert [r[f"n_{kind}"] for kind in PATTERNS] == [sum(s.startswith(kind) for s in spans) for kind in PATTERNS]
        assert set(spans) <= set(filter(None, r["spans"].split(",")))


def contexts(n):
    rows = [(i, f"{prose(4, i)} reach sales via person{i}@mail{i}.example.com {prose(3, i + 50)}", "s") for i in range(n)]
    rows.append((900, f"{prose(4, 900)} reach sales via other(at)mail.example.com today", "s"))
    rows.append((901, f"{prose(4, 901)} we saw other(at)mail2.example.com today", "s"))
    return rows


def test_confident_contexts_discover(spark):
    docs = documents(spark, contexts(12))
    got = {r["doc_id"]: r for r in find_identifiers(docs).collect()}
    text = dict((i, t) for i, t, _ in contexts(12))
    assert got[900]["spans"] and got[900]["n_email"] == 0
    kind, start, stop = got[900]["spans"].split(":")
    assert (kind, text[900][int(start) : int(stop)]) == ("email", "other(at)mail.example.com")
    assert got[901]["spans"] == ""


def test_few_seeds_or_mixed_contexts_discover_nothing(spark):
    assert discovered(mark(documents(spark, contexts(3)))).count() == 0
    mixed = contexts(12) + [(i, f"reach sales via 10.0.{i % 200}.7 now and then reach sales via number{i} x", "s") for i in range(1000, 1012)]
    assert discovered(mark(documents(spark, mixed))).count() == 0


def test_masking(spark):
    docs = documents(spark).withColumnRenamed("source", "lang")
    docs = docs.selectExpr("*", "length(text) as n_chars").drop("source_size")
    got = mask_identifiers(docs, ["doc_id", "text", "n_chars"]).collect()
    assert len(got) == len(DOCS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert by_id[1]["text"] is None and by_id[2]["text"] == "" and by_id[8]["text"] == DOCS[9][1]
    assert by_id[4]["text"] == LONG.replace("last.one@mail.example.org", "[EMAIL]")
    assert by_id[5]["text"] == "Released under the MIT License.\nmail [EMAIL] now"
    assert by_id[6]["text"] == "émigré Ünïcödé 日本語 𝒳𝒴 call [PHONE] from [IP]"
    assert by_id[6]["n_chars"] == len(by_id[6]["text"])
    assert {r["text"] for r in got if r["doc_id"] is None} == {None, "no id at all, card [CARD] here"}


def test_overlapping_kinds_are_masked_once(spark):
    docs = documents(spark, [(1, "call +4337166598464399 or 4337166598464399 x", "s")], clash=False)
    assert mask_identifiers(docs, ["text"]).collect()[0]["text"] in (
        "call [CARD] or [CARD] x", "call [PHONE] or [CARD] x", "call +[CARD] or [CARD] x",
    )


def test_empty_table(spark):
    assert find_identifiers(documents(spark, [])).collect() == []
    assert mask_identifiers(documents(spark, []), ["doc_id", "text"]).collect() == []


def test_a_hundred_thousand_spans_in_one_text(spark):
    text = " ".join(f"{n % 256}.{n % 7}.0.1 x{n}" if n % 2 else f"me{n}@mail.example.com" for n in range(100_000))
    docs = documents(spark, [(1, text, "s")])
    started = time.perf_counter()
    got = find_identifiers(docs).collect()[0]
    masked = mask_identifiers(docs, ["text"]).collect()[0]["text"]
    assert time.perf_counter() - started < 120
    spans = base(text)
    assert len(spans) == 100_000 and got["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert masked == re.sub(PATTERNS["ip"], "[IP]", re.sub(PATTERNS["email"], "[EMAIL]", text))


def test_spans_apart_from_others(spark):
    draw = random.Random(3)

    def some(count, width):
        return sorted({(a, draw.randrange(5), a + draw.randrange(1, width)) for a in (draw.randrange(2000) for _ in range(count))})

    data = [(some(n, 30), some(m, 30)) for n, m in ((0, 0), (5, 0), (0, 5), (200, 3), (3, 200), (150, 150))]
    rows = [tuple([(a, kind, b, "v") for a, kind, b in side] for side in pair) for pair in data]
    kind = "array<struct<start:int,kind:int,stop:int,value:string>>"
    got = spark.createDataFrame(rows, f"spans {kind}, others {kind}").select(_apart(F.col("spans"), F.col("others"))).collect()
    for r, (spans, others) in zip(got, data):
        assert sorted((s["start"], s["kind"], s["stop"]) for s in r[0]) == [s for s in spans if not any(o[0] < s[2] and s[0] < o[2] for o in others)]


def test_words_around_a_span(spark):
    long = "w" * 300
    text = f"{long} one 10.0.0.1 two2 {long} 10.0.0.2 {long} ab  10.0.0.3\n{'é' * 127} x"
    got = {i["value"]: (i["left2"], i["left"], i["right"]) for i in mark(documents(spark, [(1, text, "s")])).collect()[0]["instances"] if i["seed"]}
    assert got["10.0.0.1"] == ("", "one", "two0")
    # Words that go on further than is looked make no pattern.
    assert got["10.0.0.2"] == ("", "", "") and got["10.0.0.3"][:2] == ("", "ab")

