"""License scans by ordered signature rules.

A text is turned into its words, one space apart. Rules (``license_rules``) are only tried where their keyword occurs
in the text, so most texts meet none. What the rules find is resolved in order of place: a detection that lies wholly
inside one of the same or a higher priority is dropped. Everything happens within the row, in built-in functions;
nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ascii_lower, bound, match_places, running
from wardline.llm.license_rules import CONFIDENCE, RULES, Rule

#: Everything that is no part of a word: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that are always reported, with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

_DETECTION = "array<struct<start:int,stop:int,priority:int,label:string>>"


def _whole_words(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _words_before(words: Column, size: Column) -> Column:
    """Number of the word that follows the first ``size`` characters of the padded words."""
    head = F.substring(words, F.lit(1), size)
    return (F.length(head) - F.length(F.replace(head, F.lit(" "), F.lit(""))) - 1).cast("long")


def _base_places(words: Column) -> list[tuple[Column, Column, Column]]:
    """For each base phrase the number of its places and the first and last word it starts at."""
    found = []
    for phrase, _ in BASE:
        gaps = F.split(words, _whole_words(phrase))
        number = F.size(gaps) - 1
        last = F.length(words) - F.length(F.element_at(gaps, -1)) - len(phrase)
        found.append(
            (
                number.cast("long"),
                F.when(number > 0, _words_before(words, F.length(F.element_at(gaps, 1)))),
                F.when(number > 0, _words_before(words, last)),
            )
        )
    return found


def _spans(words: Column, rule: Column) -> Column:
    """The places of one rule: character offsets into the padded words."""
    return F.transform(
        match_places(words, rule["pattern"]),
        lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"), rule["priority"].alias("priority"), rule["label"].alias("label")),
    )


def _resolve(found: Column) -> Column:
    """Detections that lie in no other of the same or a higher priority; of equal ones the first by label stays."""
    order = F.array_sort(
        F.transform(
            found, lambda d: F.struct(d["start"].alias("start"), (-d["stop"]).alias("back"), d["priority"].alias("priority"), d["label"].alias("label"))
        )
    )

    none = F.array_repeat(F.lit(-1), len(CONFIDENCE))

    def ends_of(d: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(len(CONFIDENCE) - 1)), lambda n: F.when(n == d["priority"], -d["back"]).otherwise(-1))

    def kept(ordered: Column) -> Column:
        # For each priority the furthest end of all detections up to this one.
        ends = running(F.transform(ordered, ends_of), none, lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)), "array<int>")
        before = F.slice(F.concat(F.array(none), ends), F.lit(1), F.size(ordered))
        pairs = F.zip_with(ordered, before, lambda d, end: F.struct(d.alias("d"), end.alias("ends")))
        free = F.filter(pairs, lambda x: ~F.exists(F.slice(x["ends"], F.lit(1), x["d"]["priority"] + 1), lambda end: end >= -x["d"]["back"]))
        return F.transform(
            free,
            lambda x: F.struct(x["d"]["start"].alias("start"), (-x["d"]["back"]).alias("stop"), x["d"]["priority"].alias("priority"), x["d"]["label"].alias("label")),
        )

    return F.when(F.size(found) > 0, bound(order, kept)).otherwise(F.array().cast(_DETECTION))


def _constant(rules: Sequence[Rule]) -> Column:
    rows = [r._replace(pattern=_whole_words(r.pattern))._asdict() for r in rules]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<label:string,priority:int,keyword:string,pattern:string>>")


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections`` of every row.

    Null text is empty: no words, no labels (empty strings), score 0. ``detections`` are what the rules found, after
    suppression, with offsets into the words of the text (lower case, one space apart, a space at both ends). The score
    is that of the surest detection or base phrase. Repeated rows and null ids are rows like any other; an empty table
    gives an empty result; columns other than ``doc_id`` and ``text`` are not looked at.
    """
    keywords = F.from_json(F.lit(json.dumps(sorted({r.keyword for r in rules}))), "array<string>")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.concat(F.lit(" "), F.trim(F.regexp_replace("text", BETWEEN, " ")), F.lit(" ")).alias("words"),
        F.lower("text").alias("low"),
    )
    rows = rows.select(
        "doc_id",
        F.when(F.col("words") == "  ", 0)
        .otherwise(F.length("words") - F.length(F.replace(F.col("words"), F.lit(" "), F.lit(""))) - 1)
        .cast("long")
        .alias("n_words"),
        "words",
        F.filter(keywords, lambda k: F.contains(F.col("low"), k)).alias("keys"),
    )
    # Only texts with a keyword go on; base phrases all hold one.
    gated = F.when(F.size("keys") > 0, ascii_lower(F.col("words"))).otherwise(F.lit(" "))
    rows = rows.select("doc_id", "n_words", "keys", gated.alias("words"))
    tried = F.filter(_constant(rules), lambda r: F.array_contains(F.col("keys"), r["keyword"]) & F.rlike(F.col("words"), r["pattern"]))
    rows = rows.withColumn("hits", F.when(F.size("keys") > 0, tried).otherwise(F.filter(_constant(rules), lambda r: F.lit(False))))
    base = F.col("words").contains(" license ")
    places = _base_places(F.col("words"))
    rows = rows.select(
        "doc_id",
        "n_words",
        *[F.when(base, c).alias(f"{name}{n}") for n, three in enumerate(places) for name, c in zip(("n", "first", "last"), three)],
        F.flatten(F.transform("hits", lambda r: _spans(F.col("words"), r))).alias("found"),
    )
    rows = rows.withColumn("detections", _resolve(F.col("found")))
    counts = [F.coalesce(f"n{n}", F.lit(0)) for n in range(len(BASE))]
    total = counts[0] + counts[1] + counts[2]
    base_labels = F.array_compact(F.array(*[F.when(count > 0, label) for count, (_, label) in zip(counts, BASE)]))
    sure = F.transform("detections", lambda d: F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), d["priority"] + 1))
    return rows.select(
        "doc_id",
        "n_words",
        total.alias("n_base"),
        F.least(*[F.col(f"first{n}") for n in range(len(BASE))]).alias("first_word"),
        F.greatest(*[F.col(f"last{n}") for n in range(len(BASE))]).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union(base_labels, F.transform("detections", lambda d: d["label"]))), ","
        ).alias("labels"),
        F.greatest(F.coalesce(F.array_max(sure), F.lit(0.0)), F.when(total > 0, CONFIDENCE[3]).otherwise(0.0)).alias("score"),
        "detections",
    )
