"""Which parsed rows are the first of their key, found without sorting or sending whole rows.

Only the key and one number travel: the rank of a row's split in landing order, and its place in the split. The first
number of every key is an aggregate of a bounded number of rows a task. What it finds goes back to the rows as bitmaps,
one bit a row, so that the rows themselves stay where they were written. Where few keys repeat, rows of the others send
a hash of their key and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.indexing import with_row_index
from wardline.operators.lookups import BROADCAST_LIMIT_BYTES, broadcast_if_small
from wardline.session import PACKED, stable

FIRST = "_first"

#: So many keys, or chosen rows, meet in a task at most; so few need no more than one. In between some ``TASKS`` share them.
TASK_ROWS, FEW_ROWS, TASKS = 1 << 21, 1 << 18, 128
#: So many splits may be ranked by one task.
FEW_SPLITS = 4096
#: Rows looked at to find keys that hold many rows, and how often such a key occurs among them.
SAMPLE_ROWS, OFTEN = 1 << 17, 512
#: Keys that repeat are few up to so many, if they also are no more than one for so many rows: their hashes go to all tasks.
FEW_REPEATED, SELDOM = 1 << 20, 16

_ROW_BITS = 33  # monotonically_increasing_id: task above, row below
_ROW_MASK = (1 << _ROW_BITS) - 1
_BITMAP_BITS = 15  # bitmap_construct_agg: so many bits count the rows of a bitmap
_BITMAP_MASK = (1 << _BITMAP_BITS) - 1
_BITMAP_BYTES = 1 << (_BITMAP_BITS - 3)


def _tasks(rows: int, task_rows: int) -> int:
    return max(min(-(-rows // FEW_ROWS), TASKS), -(-rows // task_rows), 1)


def _ranked_splits(parsed: DataFrame) -> tuple[DataFrame, bool]:
    """``file, split, task, rank`` in landing order, and whether they are few."""
    order, seq = ["landed", "page", "file", "split", "task"], F.col("ingest_seq")
    splits = stable(parsed.select(*[seq[c].alias(c) for c in order[:-1]], F.shiftright(seq["row"], _ROW_BITS).alias("task")).distinct())
    few = splits.count() <= FEW_SPLITS
    rank = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    ranked = stable(splits.withColumn("rank", rank)) if few else with_row_index(splits, order, "rank")
    return ranked.select("file", "split", "task", "rank"), few


def _frequent(parsed: DataFrame, key: Sequence[str], total: int) -> list[int]:
    """Hashes of the keys that hold so many rows that these should not meet in one task; at most some hundreds."""
    step = max(total // SAMPLE_ROWS, 1)
    some = parsed.where(F.pmod(F.xxhash64("ingest_seq.row"), F.lit(step)) == 0).groupBy(F.xxhash64(*key).alias("_key"))
    return [r["_key"] for r in some.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > OFTEN).orderBy(F.desc("n")).limit(OFTEN).collect()]


def _repeated(parsed: DataFrame, key: Sequence[str], total: int) -> DataFrame | None:
    """``_key``, written: hashes of the keys held by more than one row, and of some keys that share one. None if they are many."""
    hashed = parsed.select(F.xxhash64(*key).alias("_key"))
    again = F.count(F.lit(1)) > 1
    few, step, parts = min(FEW_REPEATED, total // SELDOM), max(total // SAMPLE_ROWS, 1), _tasks(total, TASK_ROWS)
    # All rows of one key in so many tell whether it is worth the while.
    some = hashed.where(F.pmod("_key", F.lit(step)) == 0).groupBy("_key").agg(again.alias("_again")).where("_again")
    if step > 1 and some.count() * step > few:
        return None
    often = _frequent(parsed, key, total) if parts > 1 else []
    rows = hashed.where(~F.col("_key").isin(often)) if often else hashed
    found = rows.repartition(parts, "_key").groupBy("_key").agg(again.alias("_again")).where("_again").select("_key")
    if often:
        listed = F.explode(F.array(*[F.lit(h).cast("bigint") for h in often])).alias("_key")
        found = found.unionByName(parsed.sparkSession.range(1).select(listed))
    found = stable(found)
    return found if found.count() <= few else None


def tell_first(parsed: DataFrame, key: Sequence[str], total: int) -> DataFrame | None:
    """``parsed``, which has been written and has ``total`` rows, with ``_first``; None if no key repeats.

    Keys are counted by their hash, eight bytes a row. Where few come more than once, only their rows are compared by key
    and place, and the bitmaps are those of the rows that lose; a key that shares its hash with another is merely compared
    as well. Otherwise every row is compared.
    """
    repeated = _repeated(parsed, key, total)
    if repeated is None:
        chosen = first_of_keys(parsed, key, total, named=False)
        count = chosen.count()
        return mark_rows(parsed, chosen, count) if count < total else None
    if repeated.isEmpty():
        return None
    named = parsed.select(*key, "ingest_seq").withColumn("_key", F.xxhash64(*key))
    met = stable(named.join(F.broadcast(repeated), "_key", "left_semi").drop("_key"), **PACKED)
    rows = met.count()
    chosen = first_of_keys(met, key, rows, named=False)
    count = chosen.count()
    if count == rows:
        return None
    lost = stable(mark_rows(met, chosen, count).where(~F.col(FIRST)).select("ingest_seq.row"), **PACKED)
    return mark_rows(parsed, lost, rows - count).withColumn(FIRST, ~F.col(FIRST))


def first_of_keys(parsed: DataFrame, key: Sequence[str], total: int, task_rows: int = TASK_ROWS, named: bool = True) -> DataFrame:
    """``key, row``, written: of every key the ``ingest_seq.row`` of its first row. ``parsed`` has ``total`` rows.

    Rows are dealt out by key before they are aggregated, so that no task holds more keys than ``task_rows`` or so.
    Keys with many rows are aggregated where these are first, one row for each task goes on. ``named=False`` leaves the
    key out of what is written.
    """
    splits, few = _ranked_splits(parsed)
    seq, place = F.col("ingest_seq"), ["file", "split", "task"]
    rows = parsed.select(*key, seq["file"].alias("file"), seq["split"].alias("split"), seq["row"].alias("_row"))
    rows = rows.withColumn("task", F.shiftright("_row", _ROW_BITS)).join(F.broadcast(splits) if few else broadcast_if_small(splits), place)
    rows = rows.select(*key, F.shiftleft("rank", _ROW_BITS).bitwiseOR(F.col("_row").bitwiseAND(F.lit(_ROW_MASK))).alias("_at"))
    least, parts = F.min("_at").alias("_at"), _tasks(total, task_rows)
    if parts == 1:
        first = rows.groupBy(*key).agg(least)
    else:
        often = _frequent(parsed, key, total)
        is_often = F.xxhash64(*key).isin(often) if often else F.lit(False)
        first = rows.where(~is_often).repartition(parts, *key).groupBy(*key).agg(least)
        if often:
            first = first.unionByName(rows.where(is_often).groupBy(*key).agg(least))
    tasks = splits.select("task", "rank")
    placed = first.withColumn("rank", F.shiftright("_at", _ROW_BITS)).join(F.broadcast(tasks) if few else broadcast_if_small(tasks), "rank")
    row = F.shiftleft("task", _ROW_BITS).bitwiseOR(F.col("_at").bitwiseAND(F.lit(_ROW_MASK)))
    return stable(placed.select(*(key if named else []), row.alias("row")))


def mark_rows(parsed: DataFrame, chosen: DataFrame, count: int, limit: int = BROADCAST_LIMIT_BYTES, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add ``_first``: whether the ``ingest_seq.row`` is one of the ``count`` distinct ``row`` of ``chosen``.

    The bitmaps are sent to all tasks up to ``limit`` bytes; beyond, rows and bitmaps meet by a shuffle that sorts neither.
    """
    dealt = chosen.select(F.shiftright("row", _BITMAP_BITS).alias("_bitmap"), F.col("row").bitwiseAND(F.lit(_BITMAP_MASK)).alias("_bit"))
    built = dealt.repartition(_tasks(count, task_rows), "_bitmap").groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    # Eight bytes of a bitmap make a word, the first of them its highest.
    word = F.transform(F.sequence(F.lit(0), F.lit(_BITMAP_BYTES // 8 - 1)), lambda n: F.conv(F.hex(F.substring("_bits", n * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    bitmaps = stable(built.select("_bitmap", word.alias("_words")))
    small = bitmaps.count() * _BITMAP_BYTES <= limit
    seq = F.col("ingest_seq.row")
    bit = seq.bitwiseAND(F.lit(_BITMAP_MASK)).cast("int")
    at = (F.lit(7) - F.shiftright(bit, 3).bitwiseAND(F.lit(7))) * 8 + bit.bitwiseAND(F.lit(7))
    rows = parsed.withColumn("_bitmap", F.shiftright(seq, _BITMAP_BITS))
    if not small:
        rows = rows.repartition(TASKS, "_bitmap")
    met = rows.join(F.broadcast(bitmaps) if small else bitmaps.hint("shuffle_hash"), "_bitmap", "left")
    first = F.coalesce(F.getbit(F.get("_words", F.shiftright(bit, 6)), at) == 1, F.lit(False))
    return met.select(*parsed.columns, first.alias(FIRST))
