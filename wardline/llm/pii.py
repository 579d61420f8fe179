"""Personal data by bootstrapped contextual extraction.

Seeds are the base spans: e-mail and IP addresses, card and phone numbers that fit their pattern and their check. The
words around a seed induce lexical patterns (the word before, the word after, both, the two before). A looser pattern
for each kind gives candidates: written-out or defanged addresses, phone numbers without a prefix, card numbers that a
base match swallowed. Patterns and instances form a graph that is scored in rounds: a pattern, for each kind, by the
share of sure instances of that kind among everything with digits that it meets; an instance by the patterns that meet
it. What is not a base span but is met by a pattern of high confidence for its kind, and scores high itself, is added.
A word that stands before all sorts of things is sure of none of them.

Texts are read once, in built-in functions; what goes on is spans and their neighbouring words. Scores are sums by
pattern and by instance that combine on the map side, joined back by equi-joins whose hot keys adaptive execution
splits: the frames of sums are written first, so that both sides of a join are read from a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import between, bound, match_places, pieces, running
from wardline.operators.lookups import broadcast_if_small
from wardline.session import stable

KINDS = ("email", "ip", "card", "phone")

# A run is entered at its start only: elsewhere in it the match would fail in the same way, at the cost of another scan.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++"
    r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-]){1,3}[0-9]{3,4}(?![0-9])",
}

#: Anything else with a digit; never reported, but patterns that meet it are less sure of the kinds.
OTHER = len(KINDS)
OTHER_PATTERN = r"[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"

#: What a text must hold for a pattern to be tried on it.
GATES = {"email": r"@|at[)\]}]", "ip": r"[0-9A-Fa-f][.:\])][0-9A-Fa-f\[(]|[0-9]\[\.|[0-9]\(\.", "card": r"[0-9]", "phone": r"[0-9]"}

ROUNDS = 3
#: Instances a pattern is taken to have met without success before any is counted.
DOUBT = 1.0
#: A pattern of high confidence has this score and this many different seeds; an added instance this score.
SURE_PATTERN, SURE_SEEDS, SURE_INSTANCE = 0.8, 5, 0.8

_SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"
_FOUND = "array<struct<start:int,stop:int,value:string>>"


def _luhn(digits: Column) -> Column:
    doubled = F.array(*[F.lit(n) for n in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def worth(at: Column) -> Column:
        digit = F.substring(digits, -at, F.lit(1)).cast("int")
        return F.when(at % 2 == 0, F.element_at(doubled, digit + 1)).otherwise(digit)

    worths = F.transform(F.sequence(F.lit(1), F.length(digits)), worth)
    return F.aggregate(worths, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return ~F.exists(F.split(value, r"\."), lambda part: F.rlike(part, F.lit("^0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])$")))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _candidate(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.contains(value, F.lit(":")) | _valid("ip", F.regexp_replace(value, r"[\[\]()]", ""))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(7, 15)
    return F.lit(True)


def _found(text: Column, kind: str, pattern: str, check) -> Column:
    places = F.when(F.rlike(text, F.lit(GATES[kind])), match_places(text, F.lit(pattern))).otherwise(F.array().cast(_FOUND))
    return F.transform(
        F.filter(places, lambda m: check(kind, m["value"])),
        lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value")),
    )


def base_spans(text: Column) -> Column:
    """Base spans ``start, kind, stop, value`` by start, then by kind; offsets count code points, the stop is exclusive."""
    return F.array_sort(F.concat(*[_found(text, kind, BASE[kind], _valid) for kind in KINDS]).cast(_SPAN))


#: Words are looked for so far from a span; one that goes on beyond makes no pattern.
REACH = 64
_CUT = "\uffff"


def _context(cut: Column, span: Column, seed: bool) -> Column:
    """The span with its neighbouring words: lower case, digits as 0. ``cut`` is the text in pieces of ``REACH``."""

    def piece(n: Column) -> Column:
        return F.coalesce(F.get(cut, n), F.lit(""))

    start, stop = F.floor(span["start"] / F.lit(REACH)).cast("int"), F.floor(span["stop"] / F.lit(REACH)).cast("int")
    before = F.concat(F.when(start > 1, _CUT).otherwise(""), piece(start - 1), F.substring(piece(start), F.lit(1), span["start"] % REACH))
    after = F.concat(F.substring(piece(stop), span["stop"] % REACH + 1, F.lit(REACH)), piece(stop + 1), F.when(F.size(cut) > stop + 2, _CUT).otherwise(""))

    def word(side: Column, pattern: str) -> Column:
        found = F.regexp_replace(F.lower(F.regexp_extract(side, pattern, 1)), "[0-9]", "0")
        return F.when(F.contains(found, F.lit(_CUT)), "").otherwise(found)

    return F.struct(
        span["start"].alias("start"),
        span["kind"].alias("kind"),
        span["stop"].alias("stop"),
        span["value"].alias("value"),
        F.lit(seed).alias("seed"),
        # Entered at the beginning of a word only and never gone back into.
        word(before, r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z").alias("left"),
        word(before, r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+\z").alias("left2"),
        word(after, r"\A[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)").alias("right"),
    )


def _apart(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of the ``others``: by one pass from the front for those that begin before them and
    one from the back for those that begin after."""

    def marked(array: Column, other: bool) -> Column:
        return F.transform(
            array, lambda s: F.struct(s["start"].alias("start"), F.lit(other).alias("other"), s["kind"].alias("kind"), s["stop"].alias("stop"), s["value"].alias("value"))
        )

    def swept(events: Column) -> Column:
        most = F.lit(2**31 - 1)
        ends = running(F.transform(events, lambda e: F.when(e["other"], e["stop"]).otherwise(0)), F.lit(0), F.greatest, "int")
        starts = F.transform(F.reverse(events), lambda e: F.when(e["other"], e["start"]).otherwise(most))
        nexts = F.reverse(running(starts, most, F.least, "int"))
        zipped = F.zip_with(F.zip_with(events, ends, lambda e, end: F.struct(e.alias("e"), end.alias("end"))), nexts, lambda x, n: F.struct(x["e"].alias("e"), x["end"].alias("end"), n.alias("next")))
        free = F.filter(zipped, lambda x: ~x["e"]["other"] & (x["end"] <= x["e"]["start"]) & (x["next"] >= x["e"]["stop"]))
        return F.transform(
            free, lambda x: F.struct(x["e"]["start"].alias("start"), x["e"]["kind"].alias("kind"), x["e"]["stop"].alias("stop"), x["e"]["value"].alias("value"))
        )

    events = F.array_sort(F.concat(marked(spans, False), marked(others, True)))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), bound(events, swept)).otherwise(spans)


def text_key(text: Column) -> Column:
    """What tells texts apart: their spans depend on nothing else."""
    return F.concat_ws("-", F.length(text), F.hex(F.xxhash64(text)), F.hex(F.crc32(text.cast("binary"))))


def mark(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``key``, ``base`` (spans) and ``instances`` (base spans and candidates in context)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", *keep, text.alias("_text"))
    loose = F.concat(*[_found(F.col("_text"), kind, LOOSE[kind], _candidate) for kind in KINDS]).cast(_SPAN)
    rows = rows.select("*", base_spans(F.col("_text")).alias("base"), loose.alias("_loose"))

    rows = rows.withColumn("_fresh", _apart(F.col("_loose"), F.col("base")))
    anything = F.when(F.rlike("_text", F.lit("[0-9]")), match_places(F.col("_text"), F.lit(OTHER_PATTERN))).otherwise(F.array().cast(_FOUND))
    numbers = F.transform(
        anything, lambda m: F.struct(m["start"].alias("start"), F.lit(OTHER).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value"))
    )
    rows = rows.withColumn("_numbers", numbers).withColumn("_others", _apart(F.col("_numbers"), F.concat("base", "_fresh")))

    def in_context(cut: Column) -> Column:
        seeds = F.transform("base", lambda s: _context(cut, s, True))
        return F.concat(seeds, F.transform(F.concat("_fresh", "_others"), lambda s: _context(cut, s, False)))

    some = F.size("base") + F.size("_fresh") + F.size("_others") > 0
    text = F.when(some, F.col("_text")).otherwise("")
    return rows.select("doc_id", *keep, text_key(F.col("_text")).alias("key"), "base", bound(pieces(text, REACH), in_context).alias("instances"))


def _edges(marked: DataFrame) -> DataFrame:
    """``kind, pattern, instance, seed``: each pattern with each different instance that it meets."""
    rows = marked.select(F.explode("instances").alias("i")).select("i.*")
    patterns = F.array(
        F.when(F.col("left") != "", F.concat(F.lit("L "), "left")),
        F.when(F.col("right") != "", F.concat(F.lit("R "), "right")),
        F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B "), "left", F.lit(" "), "right")),
        F.when(F.col("left2") != "", F.concat(F.lit("T "), "left2")),
    )
    edges = rows.select("kind", F.explode(F.array_compact(patterns)).alias("pattern"), F.xxhash64("value").alias("instance"), "seed")
    return edges.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"))


def discovered(marked: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, instance`` (a hash of the value) of what patterns of high confidence find beyond the seeds."""
    edges = stable(_edges(marked))
    scores = stable(edges.groupBy("kind", "instance").agg(F.max("seed").cast("double").alias("score")))
    unknown = stable(scores.where((F.col("score") == 0) & (F.col("kind") != OTHER)).select("kind", "instance"))
    met = edges.groupBy("pattern").agg(F.count("*").alias("met"))
    for turn in range(rounds):
        sums = edges.join(scores, ["kind", "instance"]).groupBy("kind", "pattern").agg(
            F.sum("score").alias("sum"), F.sum(F.col("seed").cast("int")).alias("seeds")
        )
        sure = sums.where("sum > 0").join(met, "pattern").withColumn("sure", F.col("sum") / (F.col("met") + DOUBT))
        patterns = stable(sure.select("kind", "pattern", "sure", "seeds"))
        high = (F.col("sure") >= SURE_PATTERN) & (F.col("seeds") >= SURE_SEEDS)
        asked = edges.where(~F.col("seed") & (F.col("kind") != OTHER))
        found = stable(
            asked.join(patterns, ["kind", "pattern"])
            .groupBy("kind", "instance")
            .agg((F.lit(1.0) - F.exp(F.sum(F.log1p(-F.col("sure"))))).alias("score"), F.max(high).alias("high"))
            .join(unknown, ["kind", "instance"])
        )
        if turn + 1 < rounds:
            seeds = edges.where("seed").select("kind", "instance", F.lit(1.0).alias("score")).distinct()
            scores = stable(seeds.unionByName(found.select("kind", "instance", "score")))
    return found.where(F.col("high") & (F.col("score") >= SURE_INSTANCE)).select("kind", "instance")


def added_spans(marked: DataFrame) -> DataFrame:
    """``key, added``: the spans that the method adds to the texts it adds any to."""
    known = stable(discovered(marked))
    rows = marked.select("key", F.explode(F.filter("instances", lambda i: ~i["seed"])).alias("i")).select(
        "key", "i.start", "i.kind", "i.stop", "i.value", F.xxhash64("i.value").alias("instance")
    )
    hits = rows.join(known, ["kind", "instance"]).select("key", F.struct("start", "kind", "stop", "value").alias("span")).distinct()
    # As many rows for a text as it has spans.
    return hits.groupBy("key").agg(F.collect_list("span").cast(_SPAN).alias("added"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def find_identifiers(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found`` (and ``keep``) of every row of ``docs``.

    The counts and the checksum are those of the base spans; ``spans`` lists these and the added ones, ``found`` holds
    them as structs with their values. Null text is empty and has no spans (the checksum is that of the empty string).
    Equal texts have equal spans; repeated rows and null ids are rows like any other; an empty table gives an empty
    result; columns not named are not looked at.
    """
    marked = stable(mark(docs, keep))
    added = stable(added_spans(marked))
    rows = marked.drop("instances").join(broadcast_if_small(added), "key", "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(_SPAN))))

    def count(n: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")

    counts = [count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    return rows.select(
        "doc_id",
        *keep,
        *counts,
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(every).alias("spans"),
        every.alias("found"),
    )


#: Texts are put together from pieces of so many code points.
PIECE = 1024


def _masked(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind in brackets."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def put_together(cut: Column, every: Column, ends: Column) -> Column:
        # A span that begins before the furthest end so far belongs to the run of that one.
        before = F.concat(F.array(F.lit(0)), ends)
        begins = F.zip_with(
            every,
            F.slice(before, F.lit(1), F.size(every)),
            lambda s, end: F.when(s["start"] >= end, F.concat(between(cut, PIECE, end, s["start"]), F.element_at(names, s["kind"] + 1))).otherwise(""),
        )
        return F.concat(F.array_join(begins, ""), between(cut, PIECE, F.element_at(ends, -1), F.length(text)))

    def masked(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: s["stop"]), F.lit(0), F.greatest, "int")
        return bound(ends, lambda e: bound(pieces(text, PIECE), lambda cut: put_together(cut, every, e)))

    return F.when(F.size(spans) > 0, bound(spans, masked)).otherwise(text)


def mask_identifiers(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``docs`` with every span masked in ``text``; ``n_chars``, where asked for, follows the text.

    Texts without spans, null ones among them, stay as they are.
    """
    added = stable(added_spans(stable(mark(docs))))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*columns, text_key(text).alias("_key"), base_spans(text).alias("_base"))
    rows = rows.join(broadcast_if_small(added.withColumnRenamed("key", "_key")), "_key", "left")
    rows = rows.withColumn("_spans", F.array_sort(F.concat("_base", F.coalesce("added", F.array().cast(_SPAN)))))
    masked = rows.withColumn("text", F.when(F.col("text").isNotNull(), _masked(F.col("text"), F.col("_spans"))))
    if "n_chars" in columns:
        changed = F.when(F.size("_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        masked = masked.withColumn("n_chars", changed)
    return masked.select(*columns)
