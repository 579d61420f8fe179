"""Document fingerprints by consistent weighted sampling.

A document is a bag of words; the weight of a word is how often it occurs. For each of ``SAMPLES`` draws every word has
two Gamma(2, 1) numbers r and c and a uniform b, all from a hash of the word. With t = floor(ln(weight) / r + b) the
word's key is c * exp(-r * (t - b + 1)), and the word of the smallest key is the sample, together with its t. Two
documents draw the same sample with the probability of their generalised Jaccard similarity, sum of the smaller weights
over sum of the larger ones, so the share of equal samples estimates it.

Everything is built-in functions. Texts are dealt out once by row; the words of a row are counted and sampled where the
row is, as aggregates over a key that is already in place, so words are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import PLACE, SPACES, with_place
from wardline.session import stable

SAMPLES = 32
#: Hexadecimal digits of a sample in a fingerprint.
DIGITS = 4
#: Spreads small whole numbers over 32 bits.
ODD = 2654435761
#: The fingerprint of a text without words.
BLANK = "-"


def _uniform(hashed: Column, shift: int) -> Column:
    """21 bits of a hash as a number strictly between 0 and 1."""
    bits = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << 21) - 1))
    return (bits.cast("double") + 0.5) / float(1 << 21)


def _draws(term: Column, log_weights: list[Column], samples: int) -> list[Column]:
    """For each sample and weight an aggregate: the smallest key in the upper 31 bits, a mark of the word and its t below.

    ``term`` is the hash of the word, which is as good as the word and quicker to hash again.
    """
    found = []
    for n in range(samples):
        one = F.xxhash64(term, F.lit(n))
        two = F.xxhash64(one)
        r = -F.log(_uniform(one, 0) * _uniform(one, 21))
        log_c = F.log(-F.log(_uniform(one, 42) * _uniform(two, 0)))
        b = _uniform(two, 21)
        for log_weight in log_weights:
            t = F.floor(log_weight / r + b)
            key = ((log_c - r * (t - b + 1) + 200) * float(1 << 22)).cast("long")
            mark = two.bitwiseXOR(t * F.lit(ODD)).bitwiseAND(F.lit((1 << 33) - 1))
            found.append(F.min(F.shiftleft(key, 33).bitwiseOR(mark)))
    return found


def _fingerprint(samples: list[Column]) -> Column:
    digits = [F.lower(F.lpad(F.hex(s.bitwiseAND(F.lit((1 << 4 * DIGITS) - 1))), DIGITS, "0")) for s in samples]
    return F.coalesce(F.concat(*digits), F.lit(BLANK))


def likeness(left: Column, right: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints; two texts without words are alike, one without any is like no other."""
    same = [
        (F.substring(left, DIGITS * n + 1, DIGITS) == F.substring(right, DIGITS * n + 1, DIGITS)).cast("int")
        for n in range(samples)
    ]
    total = same[0]
    for one in same[1:]:
        total = total + one
    blank = (left == BLANK) | (right == BLANK)
    return F.when(blank, (left == right).cast("double")).otherwise(total.cast("double") / samples)


def following(rows: DataFrame) -> DataFrame:
    """``row, next_row``: the row after each in descending ``doc_id`` (null ids last, repeated ones by row), the first
    after the last. Ranges of ids are put in order side by side; only the first row of each range meets the others."""
    order = [F.desc_nulls_last("doc_id"), F.col("row")]
    ranged = stable(rows.select("doc_id", "row").repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    # Of the largest id the smallest row. Rows are never negative; the least id has no counterpart of its own size.
    first = ranged.groupBy("part").agg(
        F.max_by("row", F.struct(F.col("doc_id").isNotNull(), F.col("doc_id"), -F.col("row"))).alias("first_row")
    )
    # One row for each range, whatever the number of rows.
    all_parts = Window.partitionBy().orderBy("part")
    wrapped = F.first("first_row").over(all_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = first.select("part", F.coalesce(F.lead("first_row").over(all_parts), wrapped).alias("after"))
    ahead = ranged.withColumn("ahead", F.lead("row").over(Window.partitionBy("part").orderBy(*order)))
    return ahead.join(first, "part").select("row", F.coalesce("ahead", "after").alias("next_row"))


def fingerprint_pairs(texts: DataFrame, columns: list[str], samples: int = SAMPLES) -> DataFrame:
    """``PLACE``, and for each of the text ``columns`` its fingerprint as ``<column>_fingerprint``; ``texts`` must be
    dealt out by ``PLACE`` for the words to stay where they are."""
    sides = F.array(
        *[
            F.struct(*[F.lit(int(c == d)).alias(f"in_{d}") for d in columns], F.split(F.col(c), SPACES).alias("terms"))
            for c in columns
        ]
    )
    counts = [f"in_{c}" for c in columns]
    terms = texts.select(*PLACE, F.explode(sides).alias("side")).select(*PLACE, "side.*")
    terms = terms.select(*PLACE, *counts, F.explode("terms").alias("word")).where("word <> ''")
    terms = terms.select(*PLACE, *counts, F.xxhash64("word").alias("term"))
    weights = terms.groupBy(*PLACE, "term").agg(*[F.log(F.sum(c).cast("double")).alias(c) for c in counts])
    draws = _draws(F.col("term"), [F.col(c) for c in counts], samples)
    drawn = weights.groupBy(*PLACE).agg(*[draw.alias(f"s{n}") for n, draw in enumerate(draws)])
    step = len(columns)
    return drawn.select(
        *PLACE,
        *[
            _fingerprint([F.col(f"s{n}") for n in range(at, samples * step, step)]).alias(f"{c}_fingerprint")
            for at, c in enumerate(columns)
        ],
    )


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The edited text has the last third of the code points replaced by as many from the start of the next document's
    text (or all it has). Null text is empty; a text without words has the fingerprint ``-``. Rows are told apart by
    their place, so repeated rows and ids are documents of their own; with a single row it is its own next one. An empty
    table gives an empty result; columns other than ``doc_id`` and ``text`` are not looked at.
    """
    placed = with_place(docs, ["doc_id", "text"]).withColumn("text", F.coalesce("text", F.lit("")))
    sizes = placed.select("doc_id", *PLACE, F.length("text").cast("long").alias("n_chars"))
    sizes = stable(sizes.withColumn("row", F.monotonically_increasing_id()))
    pairs = stable(following(sizes).join(sizes.select("row", "n_chars"), "row"))
    places = sizes.select("row", *PLACE)
    owners = places.select("row", *[F.col(c).alias(f"for_{c}") for c in PLACE])
    wanted = pairs.select("row", "next_row", F.expr("n_chars div 3").alias("cut")).join(owners, "row").drop("row")
    wanted = wanted.join(places.withColumnRenamed("row", "next_row"), "next_row").drop("next_row")
    dealt = placed.select(*PLACE, "text").repartition(*PLACE)
    heads = dealt.join(wanted, list(PLACE)).select(
        *[F.col(f"for_{c}").alias(c) for c in PLACE], "cut", F.expr("substring(text, 1, cast(cut as int))").alias("head")
    )
    edited = F.concat(F.expr("substring(text, 1, cast(length(text) - cut as int))"), F.col("head"))
    texts = dealt.join(heads, list(PLACE)).select(*PLACE, F.col("text").alias("plain"), edited.alias("edited"))
    # Both sides need the same columns of the shuffled texts and heads, so they read one shuffle of each.
    prints = fingerprint_pairs(texts, ["plain", "edited"], samples)
    hashed = texts.select(*PLACE, F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    found = hashed.join(prints, list(PLACE), "left").select(
        *PLACE,
        "edited_sha256",
        F.coalesce("plain_fingerprint", F.lit(BLANK)).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit(BLANK)).alias("edited_fingerprint"),
    )
    found = stable(found).join(sizes.select(*PLACE, "row", "doc_id"), list(PLACE))
    nexts = found.select(F.col("row").alias("next_row"), F.col("fingerprint").alias("next_fingerprint"))
    return found.join(pairs, "row").join(nexts, "next_row").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
