"""The queries that apply the operators to the given tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm.common import table
from wardline.llm.contexts import score_texts
from wardline.llm.mixing import mix_sources
from wardline.llm.fingerprints import fingerprint_documents
from wardline.llm.licenses import scan_licenses
from wardline.llm.packing import pack_documents
from wardline.llm.pii import find_identifiers
from wardline.llm.prefixes import conversation_trie
from wardline.llm.quality import judge_quality
from wardline.llm.simhash import simhash_groups
from wardline.llm.topk import exact_top_k
from wardline.llm.urls import Rule, judge_urls
from wardline.llm.warc import archive_pages
from wardline.llm.whitening import whiten_embeddings
from wardline.plans.registry import query

ARCHIVE_SQL = """
WITH hashed AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM hashed GROUP BY payload_digest)
SELECT page_id, octet_length(payload) AS payload_bytes, payload_digest,
       CASE WHEN octet_length(payload) >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(payload) >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN firsts USING (payload_digest)
"""

URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

_FITS = """
    SELECT page_id, host, path, max_by(rule, length(rule)) AS rule
    FROM parts LEFT JOIN (VALUES {rules}) AS r(action, rule_host, rule_path, rule)
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id, host, path
"""

URL_SQL = f"""
WITH rests AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
), fits AS ({_FITS.format(rules=", ".join(f"('{r.action}', '{r.host}', '{r.path}', '{r.key}')" for r in URL_RULES))})
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({", ".join(f"'{r.key}'" for r in URL_RULES if r.action == "block")}) THEN 'block' ELSE 'allow' END AS verdict
FROM fits
"""


#: The ranks of the vocabulary byte_bpe_50k.json: with the added tokens of that file the same ids, made in a quarter of the time.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op1_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, window=1024)


@query("op2_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_identifiers(table(spark, sf_dir, "documents")).drop("found")


@query("op3_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in every document."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


@query("op4_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled fingerprint of every document and of its edited text, and how alike they are."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))


@query("op5_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: 4-word shingles, links at 4 or fewer differing bits."""
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4)


@query("op6_warc_bundles", ARCHIVE_SQL)
def warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the bundles it was written to."""
    return archive_pages(table(spark, sf_dir, "pages"))


@query("op7_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document by a network learned from the labels of the other four folds."""
    return judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_url_filters", URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url, by longest rule held in a Bloom filter cascade."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document when sources are mixed 1 : 2 : 3 with at most three passes."""
    return mix_sources(table(spark, sf_dir, "documents"))


TOP_SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 20
"""


@query("op10_exact_top_k", TOP_SQL)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors by inner product of every vector whose id is divisible by 20."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op11_context_tree")
def context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every text by context-tree weighting, and by the counts of its words."""
    return score_texts(table(spark, sf_dir, "documents"))


# CRC-32 bit by bit: a byte is mixed in, then eight steps follow (-1).
TRIE_SQL = """
WITH own AS (
    SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT *, xor(list_reduce(
        [4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295) % 6 AS h
    FROM own
), rebuilt AS (
    SELECT o.conv_id, coalesce(b.turns[1:o.h], []) || o.turns[o.h + 1:] AS turns
    FROM heads o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), members AS (
    SELECT conv_id, d, turns[1:d] AS node, len(turns) = d AS last FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(node[d].text), 0) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM members GROUP BY node, d
), children AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), tops AS (
    SELECT node[1:k] AS node, count(*) FILTER (n IS NULL) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT nodes.node, saved, n, unnest(range(0, d + 1)) AS k FROM nodes LEFT JOIN children ON children.node = nodes.node) GROUP BY ALL
)
SELECT nodes.conv_id, CAST(nodes.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN tops ON tops.node = nodes.node LEFT JOIN children ON children.node = nodes.node
LEFT JOIN nodes above ON above.d = nodes.d - 1 AND above.node = nodes.node[1:nodes.d - 1]
"""


@query("op12_conversation_trie", TRIE_SQL)
def conversation_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of every vector, fitted on distinct vectors."""
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))
