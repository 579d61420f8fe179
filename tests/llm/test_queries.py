"""The registered queries on the smallest tables, against their SQL where they have one."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.cases import rows
from wardline.llm.packing import pack_documents
from wardline.llm.pii import find_identifiers
from wardline.llm.quality import judge_quality
from wardline.llm.simhash import simhash_groups
from wardline.llm.mixing import mix_sources
from wardline.session import stable

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")

OWN = sorted(name for name in entry.queries() if name.startswith("op"))


def test_one_query_for_each_operator():
    assert Counter(name.split("_")[0] for name in OWN) == {f"op{n}": 1 for n in range(1, 14)}
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", [name for name in OWN if name in entry.oracle_sql()])
def test_against_sql(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    connection = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = connection.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(result.columns) == columns
    expected = sorted(result.select(*columns).fetchall(), key=repr)
    assert rows(df.select(*columns)) == expected and expected


CONTRACT = {
    "op1": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op4": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5": "doc_id fingerprint component_id",
    "op6": "page_id payload_bytes payload_digest record_type refers_to",
    "op7": "doc_id held_out score predicted",
    "op8": "page_id host path rule verdict",
    "op9": "doc_id size source_size target taken",
    "op10": "query_id rank vec_id score",
    "op11": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op12": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13": "vec_id component n deviation whitened explained identity_error",
}
INTEGERS = {"rank": "int", "predicted": "int", "component": "int"}
OTHERS = dict.fromkeys("score base_score target near_edited near_next whitened explained identity_error".split(), "double") | {"held_out": "boolean"}
TEXTS = "base_sha256 spans base_labels labels edited_sha256 fingerprint edited_fingerprint payload_digest record_type host path rule verdict ends_sha256"


@pytest.mark.parametrize("name", OWN)
def test_columns(spark, name):
    got = dict(entry.queries()[name](spark, SF_DIR).dtypes)
    kinds = INTEGERS | OTHERS | dict.fromkeys(TEXTS.split(), "string")
    if name == "op10_exact_top_k":
        kinds = kinds | {"score": "bigint"}
    assert got == {c: kinds.get(c, "bigint") for c in CONTRACT[name.split("_")[0]].split()}


def test_the_pipeline_does_what_its_operators_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "simhash near-dedup", "personal data", "source mixing", "packing"]

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    good = stable(stages["quality classifier"](spark, docs, SF_DIR))
    assert ids(good) == ids(judge_quality(docs, labels).where("predicted = 1")) and good.columns == docs.columns
    single = stable(stages["simhash near-dedup"](spark, good, SF_DIR))
    assert ids(single) == sorted({r["component_id"] for r in simhash_groups(good).collect()}) and single.columns == docs.columns
    masked = stable(stages["personal data"](spark, single, SF_DIR))
    assert ids(masked) == ids(single) and masked.columns == docs.columns
    spans = {r["doc_id"]: r["found"] for r in find_identifiers(single).collect()}
    after = {r["doc_id"]: r for r in masked.collect()}
    for r in single.collect():
        if not spans[r["doc_id"]]:
            assert after[r["doc_id"]] == r
        else:
            assert all(s["value"] not in after[r["doc_id"]]["text"] for s in spans[r["doc_id"]])
            assert after[r["doc_id"]]["n_chars"] == len(after[r["doc_id"]]["text"])
    mixed = stable(stages["source mixing"](spark, masked, SF_DIR))
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len([w for w in r["text"].split() if w]) if r["text"].isascii() else 0
    plan = {r["doc_id"]: r["taken"] for r in mix_sources(masked).collect()}
    ascii_ids = {d for d, r in after.items() if r["text"].isascii()}
    assert {d: n for d, n in plan.items() if d in ascii_ids and n} == {d: n for d, n in words.items() if d in ascii_ids and n}
    packed = stages["packing"](spark, mixed, SF_DIR)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert rows(packed.select(*key)) == rows(pack_documents(mixed, corpus_pipeline.TOKENIZER).select(*key))
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert rows(whole.select(*key)) == rows(packed.select(*key))
