"""Mixing sources to target weights.

Each source gets a target number of words. Whole passes over the source (epochs) come first; the rest of the target is
drawn without replacement by Efraimidis and Spirakis: every document gets an exponential key divided by its quality
weight, the keys are sorted within the source, and their running word count is cut at what is left of the target. The
document at the cut is taken for a part of its words, so the source meets its target to the word.

A source of any size is sorted in parallel. The keys of a source are cut into ranges that hold about ``BUCKET_ROWS``
rows each; running sums are made within a range and shifted by the sums of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import NOT_SPACES, PLACE, SPACES, unit, with_place, word_count
from wardline.operators.lookups import broadcast_if_small
from wardline.session import stable

BUCKET_ROWS = 4096


def quality_weight(text: Column) -> Column:
    """1 for plain prose, falling to 0.05 as ASCII punctuation takes up more of the text; null and empty text: 1."""
    kept = F.length(F.regexp_replace(text, r"[!-/:-@\[-`{-~]+", ""))
    share = F.lit(1.0) - F.try_divide(kept, F.length(text))
    return F.coalesce(F.greatest(F.lit(0.05), F.lit(1.0) - share * 4), F.lit(1.0))


def source_targets(sized: DataFrame, weights: Sequence[int], cap: float) -> DataFrame:
    """``source_key, source_size, source_rows, target`` from rows of (source, size).

    Weights are given to the sources by code point, null last, and repeat. The targets share the sum of all sizes by
    weight; one that would exceed ``cap`` times its source stops there and the excess goes to the others by weight.
    That ends at min(cap * size, level * weight) with one level for all, found by a running sum over the sources in
    the order in which they stop. One row per source: the frame has as many rows as there are names of sources.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    limited = totals.select("*", share.alias("share")).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_stop = Window.orderBy(F.col("most") / F.col("share"), F.col("source").isNull(), F.col("source"))
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    levelled = limited.withColumn("level", left / F.sum("share").over(onward)).withColumn(
        "stop", F.row_number().over(by_stop)
    )
    # The sources that do not stop are those from the first one on whose level is below its own stop.
    free = F.when(F.col("level") * F.col("share") <= F.col("most"), F.col("stop"))
    level = F.min_by("level", free).over(everything)
    target = F.coalesce(F.least(F.col("most"), level * F.col("share")), F.col("most"))
    return levelled.select(
        source_key(F.col("source")).alias("source_key"),
        "source_size",
        "source_rows",
        F.when(F.col("source_size") == 0, 0.0).otherwise(target).alias("target"),
    )


def source_key(source: Column) -> Column:
    """The source as a key that joins null with null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    cap: float = 3.0,
    weight: Column | None = None,
    seed: int = 9,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and the columns ``keep``) of every row of ``docs``.

    ``taken`` is the number of words the mix takes of the document: its size times the whole passes over its source,
    and once more all, part or none of it. Null text has size 0 and takes nothing; null sources form one source, null
    ids are one more id. Rows with the same key (repeated rows) are taken in order of id and size, so reruns agree on
    the rows of the result. An empty table gives an empty result; columns not named are not looked at.
    """
    text = F.col("text")
    weight = quality_weight(text) if weight is None else weight
    drawn = unit(F.xxhash64("doc_id", "text", F.lit(seed)))
    sized = stable(
        docs.select(
            *dict.fromkeys(["doc_id", *keep, "source"]),
            word_count(text).alias("size"),
            F.greatest(weight, F.lit(1e-6)).alias("weight"),
            drawn.alias("drawn"),
        ).withColumn("race", -F.log("drawn") / F.col("weight"))
    )
    targets = stable(source_targets(sized, weights, cap))
    per_doc = sized.withColumn("source_key", source_key(F.col("source"))).join(broadcast_if_small(targets), "source_key")
    # Whatever the weights are, at most 0.26 of the exponential keys lie between one power of two and the next: those
    # of any weight alone reach that share only around their own mean. So an octave is cut by the rows of its source.
    steps = F.ceil(F.col("source_rows") / (4 * BUCKET_ROWS))
    per_doc = per_doc.withColumn("bucket", F.floor(F.log2("race") * steps))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = per_doc.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    starts = sums.select("source_key", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("source_key", "bucket")
        .orderBy("race", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = per_doc.withColumn("upto", F.sum("size").over(inside)).join(starts, ["source_key", "bucket"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    once_more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - (F.col("base") + F.col("upto") - F.col("size"))))
    return (
        ranked.withColumn("epochs", epochs)
        .withColumn("left", left)
        .select(
            "doc_id",
            *keep,
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + once_more).cast("long").alias("taken"),
        )
    )


def _leading_words(text: Column, number: Column) -> Column:
    """The text up to the end of its ``number``-th word."""

    def characters(pieces: Column) -> Column:
        sizes = F.transform(F.slice(pieces, F.lit(1), number), F.length)
        return F.aggregate(sizes, F.lit(0), lambda done, size: done + size)

    words = F.filter(F.split(text, SPACES), lambda word: word != "")
    return F.substring(text, F.lit(1), characters(words) + characters(F.split(text, NOT_SPACES)))


def apply_mix(docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The documents themselves in the mix: one row per whole copy, and the leading words of a part that is taken.

    ``n_chars``, where asked for, follows the text. A document that is taken for no word has no row.
    """
    placed = with_place(docs, columns)
    plan = mix_sources(placed, keep=PLACE).where("taken > 0").select(*PLACE, "size", "taken")
    whole, part = F.floor(F.col("taken") / F.col("size")), (F.col("taken") % F.col("size")).cast("int")
    copies = F.concat(
        F.when(whole > 0, F.array_repeat(F.lit(0), whole.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")),
    )
    taken = placed.join(plan.select(*PLACE, F.explode(copies).alias("_words")), list(PLACE))
    leading = _leading_words(F.col("text"), F.col("_words"))
    taken = taken.withColumn("text", F.when(F.col("_words") > 0, leading).otherwise(F.col("text")))
    if "n_chars" in columns:
        taken = taken.withColumn("n_chars", F.length("text").cast("long"))
    return taken.select(*columns)
