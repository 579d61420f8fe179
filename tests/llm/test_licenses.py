import random
import re
import time
from re import _parser as parser

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, ascii_lower, documents
from wardline.llm.license_rules import CONFIDENCE, RULES
from wardline.llm.licenses import _resolve, scan_licenses

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        phrase = phrase.split()
        for n in range(len(words)):
            if words[n : n + len(phrase)] == phrase:
                starts.append(n)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


ODD = [
    "mit license mit license mit-license MIT  \n LICENSE mitlicense mit licenses",
    "the Apache license, general public license; GENERAL PUBLIC LICENSE",
    "MİT License mit lıcense éapache license apache licenseé",
    "license",
    "mit license " * 3000,
]


def test_base_phrases(spark):
    texts = [t for _, t, _ in DOCS] + ODD
    got = {r["doc_id"]: r for r in scan_licenses(documents(spark, [(n, t, "s") for n, t in enumerate(texts)])).collect()}
    for n, text in enumerate(texts):
        r = got[n]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text), text and text[:50]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def found(spark, text):
    r = scan_licenses(documents(spark, [(1, text, "s")])).collect()[0]
    return set(filter(None, r["labels"].split(","))), r["score"], r["detections"]


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}, 0.9),
        ("GNU General Public License, version 3", {"gpl", "gpl-3.0"}, 0.9),
        ("the GNU Lesser General Public License v2.1", {"gpl", "lgpl-2.1"}, 0.9),
        ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}, 0.9),
        ("SPDX-License-Identifier: BSD-3-Clause", {"bsd-3-clause"}, 1.0),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"}, 0.95),
        ("All rights reserved.", {"all-rights-reserved"}, 0.4),
        ("a permit to licensees, rights", set(), 0.0),
    ],
)
def test_rules(spark, text, labels, score):
    assert found(spark, text)[:2] == (labels, score)


def test_a_detection_inside_a_better_one_goes(spark):
    _, _, detections = found(spark, "GNU General Public License, version 3 and the MIT License")
    assert [d["label"] for d in detections] == ["gpl-3.0", "mit"]


def test_hundreds_of_rules_that_compile_and_need_their_keyword():
    assert len(RULES) > 300 and max(r.priority for r in RULES) + 1 == len(CONFIDENCE)
    for rule in RULES:
        re.compile(rule.pattern)
        plain = re.fullmatch(r"[a-z0-9 ]+", rule.pattern)
        assert not plain or rule.keyword in rule.pattern.replace(" ", "") or rule.keyword in rule.pattern, rule


def wordings(parsed):
    """Texts of a parsed pattern: every alternative, every optional part with and without, the least repeats."""
    done = [""]
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            more = [chr(value)]
        elif kind == "ANY":
            more = ["~"]
        elif kind == "IN":
            more = [chr(x) if str(k) == "LITERAL" else "0" for k, x in value]
        elif kind == "BRANCH":
            more = [text for branch in value[1] for text in wordings(branch)]
        elif kind == "SUBPATTERN":
            more = wordings(value[-1])
        elif kind == "MAX_REPEAT":
            least, most, inner = value
            more = [text * n for n in sorted({least, min(most, least + 1)}) for text in wordings(inner)]
        else:
            raise NotImplementedError(kind)
        done = [a + b for a in done for b in more]
    return done


def test_every_alternative_of_every_rule_holds_its_keyword():
    assert set(wordings(parser.parse("(?:a|b)c?[sd]"))) == {"as", "ad", "acs", "acd", "bs", "bd", "bcs", "bcd"}
    missing = []
    for rule in RULES:
        texts = wordings(parser.parse(rule.pattern))
        assert all(re.fullmatch(rule.pattern, text) for text in texts), rule
        missing += [(rule, text) for text in texts if rule.keyword not in text]
    assert not missing


@pytest.mark.parametrize("verb", ["Licensed", "Released", "distributed"])
@pytest.mark.parametrize("name", ["under the MIT.", "under MIT terms"])
def test_mit_without_the_word_license(spark, verb, name):
    assert found(spark, f"{verb} {name}")[:2] == ({"mit"}, 0.75)


def test_empty_table(spark):
    assert scan_licenses(documents(spark, [])).collect() == []


def test_a_hundred_thousand_phrases_in_one_text(spark):
    text = " ".join("mit license" if n % 2 else f"Licensed under the Apache License, Version 2.0 x{n}" for n in range(100_000))
    started = time.perf_counter()
    r = scan_licenses(documents(spark, [(1, text, "s")])).collect()[0]
    assert time.perf_counter() - started < 120
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(text)
    assert len(r["detections"]) >= 100_000


def test_suppression_against_every_pair(spark):
    draw = random.Random(4)
    data = []
    for count in (0, 1, 5, 70, 300):
        found = []
        for _ in range(count):
            start = draw.randrange(600)
            found.append((start, start + draw.randrange(1, 40), draw.randrange(len(CONFIDENCE)), draw.choice("abc")))
        data.append((found,))
    kind = "array<struct<start:int,stop:int,priority:int,label:string>>"
    got = spark.createDataFrame(data, f"found {kind}").select(_resolve(F.col("found"))).collect()
    for r, (found,) in zip(got, data):
        ordered = sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3]))
        kept = [d for n, d in enumerate(ordered) if not any(e[1] >= d[1] and e[2] <= d[2] for e in ordered[:n])]
        assert [tuple(d) for d in r[0]] == kept
