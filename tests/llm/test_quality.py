import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import CLASHING, LONG, prose
from wardline.llm.quality import context_table, held_out, judge_quality, keep_good, train

LABELS = "doc_id long, quality int, toxic int"


def good(n):
    return prose(40 + n % 40, n)


def junk(n):
    return " ".join(w.upper() + "!!" for w in prose(30, n).split()) if n % 2 else (prose(1, n) + " ") * 60


def corpus(spark, n=600):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        label = int(draw.random() < 0.8)
        rows.append((i, good(i) if label else junk(i)))
        labels.append((i, label, 0))
    rows += [(n, None), (n + 1, ""), (n + 2, LONG), (n + 3, LONG), (None, "the one"), (0, rows[0][1])]
    labels += [(None, 1, 0), (1, None, 0), (2, 7, 0), (99999, 0, 0), (3, labels[3][1], 1)]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    docs = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)
    return docs, spark.createDataFrame(labels, LABELS), dict((i, label) for i, label, _ in labels[:n])


def test_scores(spark):
    docs, labels, truth = corpus(spark)
    got = judge_quality(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    tested = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(tested) > 80 and sum(a == b for a, b in tested) / len(tested) > 0.95
    again = {r["doc_id"]: r["score"] for r in judge_quality(docs.repartition(5), labels).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in got)
    texts = {r["doc_id"]: r["score"] for r in got}
    assert texts[602] == texts[603] and texts[600] == texts[601]


def test_scores_come_from_the_text_and_learned_rows_alone(spark):
    docs, labels, _ = corpus(spark, 200)
    plain = {r["doc_id"]: r["score"] for r in judge_quality(docs, labels).collect()}
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = judge_quality(docs.withColumn("source", F.lit("y")), turned.withColumn("toxic", F.lit(1))).collect()
    assert all(abs(plain[r["doc_id"]] - r["score"]) < 1e-9 for r in other)


def test_every_document_is_counted(spark):
    docs = spark.createDataFrame([(n, "alpha beta gamma") for n in range(40)], "doc_id long, text string").repartition(7)
    one = context_table(docs.limit(1))
    assert (context_table(docs) == 40 * one).all() and np.abs(one).sum() > 0


def test_no_labels(spark):
    docs, labels, _ = corpus(spark, 20)
    assert {r["score"] for r in judge_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert train(np.zeros((0, 3)), np.zeros(0)) is None
    one = train(np.ones((1, 3)), np.ones(1, int))
    assert 0 <= one.scores(np.ones((1, 3)))[0] <= 1


def test_empty_table(spark):
    docs, labels, _ = corpus(spark, 20)
    assert judge_quality(docs.limit(0), labels).collect() == []


def test_rejected_documents_go(spark):
    docs, labels, _ = corpus(spark)
    kept = {r["doc_id"] for r in keep_good(docs, labels, ["doc_id", "text"]).collect()}
    assert kept == {r["doc_id"] for r in judge_quality(docs, labels).collect() if r["predicted"]}
