"""Documents with everything that may go wrong in them, and the rows of a result."""

import random
import re
from contextlib import contextmanager

WORDS = "the of and ering tion onder thand est le la ndou rehe anst inble oth heat erly tiond ouer nder".split()


def prose(number: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(WORDS) for _ in range(number))


LONG = prose(6000, 1) + " Licensed under the Apache License, Version 2.0. write to last.one@mail.example.org"

#: doc_id, text, source
DOCS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n ", None),
    (4, LONG, "b"),
    (5, "Released under the MIT License.\nmail ab.cd@x-y.example.com now", "b"),
    (5, "Released under the MIT License.\nmail ab.cd@x-y.example.com now", "b"),
    (6, "émigré Ünïcödé 日本語 𝒳𝒴 call +1 (578) 555-6437 from 10.0.0.255", "b"),
    (None, "no id at all, card 4337-1665 9846 4399 here", None),
    (None, None, None),
    (8, prose(300, 2), "c"),
    (9, prose(300, 2), "c"),
    (10, prose(299, 2) + " changed", "c"),
    (11, "one", "c"),
    (12, "one two", ""),
    (13, prose(40, 3), "d"),
]

CLASHING = "row size score rank key base labels length words fingerprint part shard source_size _row taken path _text".split()


def documents(spark, rows=DOCS, clash=True):
    columns = "doc_id long, text string, source string"
    extra = CLASHING if clash else []
    schema = ", ".join([columns, *[f"`{c}` string" for c in extra]])
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


#: Small thresholds, under which adaptive execution splits the hot partitions of small tables.
SPLIT_EARLY = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # A partition is split by the tasks that wrote to it, which read a file each.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "4k",
    "spark.sql.files.openCostInBytes": "1",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plans(monkeypatch, module):
    """The plans of everything that ``module`` writes with ``stable``, as they were run in the end."""
    plans = []
    original = module.stable

    def noted(df):
        result = original(df)
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return result

    monkeypatch.setattr(module, "stable", noted)
    return plans
