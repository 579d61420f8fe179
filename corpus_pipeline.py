"""From raw documents to packed training sequences: five stages, each on everything the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm.common import table
from wardline.llm.mixing import apply_mix
from wardline.llm.packing import pack_documents
from wardline.llm.pii import mask_identifiers
from wardline.llm.quality import keep_good
from wardline.llm.simhash import keep_one_of_each
from wardline.plans.registry import query
from wardline.session import stable

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of ``sf_dir``."""
    return keep_good(docs, table(spark, sf_dir, "labels"), COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 4-word shingles, at most 4 differing bits."""
    return keep_one_of_each(docs, COLUMNS, shingle=4, radius=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    return mask_identifiers(docs, COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them: repeated for whole passes, cut where a source meets its target."""
    return apply_mix(docs, COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in the training sequences."""
    return pack_documents(docs, TOKENIZER, window=1024)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("personal data", personal_data),
    ("source mixing", mixing),
    ("packing", packing),
]

#: No SQL: the classifier, 64-bit shingle hashes and the tokenizer are beyond it. Tested stage by stage instead.
ORACLE_SQL: str | None = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
