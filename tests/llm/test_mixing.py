from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, documents, prose, rows, spaced_words
from wardline.llm import mixing
from wardline.llm.mixing import apply_mix, mix_sources


def expected_targets(sizes, weights=(1, 2, 3), cap=3.0):
    """By resharing until nothing is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    stopped, total = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: cap * sizes[s] for s in over}


def check(got, source_of):
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        source = source_of(r)
        sizes[source] += r["size"]
        taken[source] += r["taken"]
        targets.setdefault(source, r["target"])
        assert r["target"] == targets[source] and 0 <= r["taken"] <= 3 * r["size"]
    wanted = expected_targets(sizes)
    for source in sizes:
        assert targets[source] == pytest.approx(wanted[source])
        assert abs(taken[source] - targets[source]) <= 1
    assert all(r["source_size"] == sizes[source_of(r)] for r in got)


@pytest.mark.parametrize("bucket", [4096, 3])
def test_sources_meet_their_targets(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    docs = documents(spark)
    got = mix_sources(docs, keep=("source",)).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d, s, len(spaced_words(t))) for d, t, s in DOCS)
    check(got, lambda r: r["source"])


def test_a_hot_source_and_many_small_ones(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    data = [(n, prose(1 + n * 7 % 60, n), "hot" if n % 3 == 0 else f"s{n % 40}") for n in range(900)]
    data += [(2000 + n, "", f"empty{n}") for n in range(3)]
    docs = documents(spark, data)
    got = mix_sources(docs, keep=("source",)).collect()
    check(got, lambda r: r["source"])
    passes = defaultdict(set)
    for r in got:
        if r["size"]:
            passes[r["source"]].add(r["taken"] // r["size"])
    # Whole passes come first: documents of a source differ by one pass at most.
    assert all(max(p) - min(p) <= 1 for p in passes.values())
    assert rows(mix_sources(docs.repartition(7), keep=("source",))) == rows(mix_sources(docs, keep=("source",)))


def test_heavier_documents_are_drawn_more_often(spark):
    text = prose(10, 4)
    data = [(n, text if n % 2 else text.replace(" ", " ,!;.,"), "a") for n in range(2000)] + [(n, text, "b") for n in range(5000, 8000)]
    got = mix_sources(documents(spark, data), keep=("source",), weights=(1, 5)).where("source = 'a' and taken > 0").collect()
    plain = sum(r["doc_id"] % 2 for r in got)
    assert plain > 3 * (len(got) - plain)


def test_the_mix_itself(spark):
    docs = documents(spark)
    taken = Counter()
    for r in apply_mix(docs, ["doc_id", "text", "source"]).collect():
        taken[r["source"]] += len(spaced_words(r["text"]))
        whole = [t for d, t, s in DOCS if (d, s) == (r["doc_id"], r["source"])]
        assert any(r["text"] == t or (t or "").startswith(r["text"]) for t in whole)
    plan = Counter()
    for r in mix_sources(docs, keep=("source",)).collect():
        plan[r["source"]] += r["taken"]
    assert taken == +plan


def test_only_empty_texts_and_empty_table(spark):
    got = mix_sources(documents(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0)] * 2
    assert mix_sources(documents(spark, [])).collect() == []
    assert apply_mix(documents(spark, []), ["doc_id", "text", "source"]).collect() == []


def test_ranges_hold_alike_whatever_the_weights(spark, monkeypatch):
    """Half of a source is drawn twenty times less often than the other half."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    data = [(n, f"{n} " * 3, "hot") for n in range(6000)]
    weight = F.when(F.col("doc_id") % 2 == 0, 0.05).otherwise(1.0)
    race = -F.log(mixing.unit(F.xxhash64("doc_id", "text", F.lit(9)))) / weight
    steps = F.ceil(F.lit(6000) / (4 * 64))
    docs = documents(spark, data)
    most = docs.groupBy(F.floor(F.log2(race) * steps)).count().agg(F.max("count")).first()[0]
    assert most <= 2 * 64
    got = mix_sources(docs, weight=weight, keep=("source",)).collect()
    check(got, lambda r: r["source"])
