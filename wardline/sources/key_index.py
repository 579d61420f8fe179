"""Which files of a table may hold a key: for each part a range of keys and a Bloom filter.

Keys are dealt into parts by the leading bits of their hash, as many parts for a batch as its rows need, so a part stays
about the same size however large batches are. A lookup asks the parts of all batches that begin with a key's bits. Of
these it drops first the ones whose range of keys ends before or begins after the wanted ones, from a few bytes a part,
then the ones whose filter lacks every wanted key. At 32 bits and 16 positions a key, some three in ten million absent
keys pass a filter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH, PART = "ingest_batch", "key_part"
PART_KEYS = 1 << 16
BITS_A_KEY = 32
POSITIONS = 16

INDEX_SCHEMA = f"{PART} string, depth int, prefix bigint, least string, most string, words array<bigint>, {BATCH} int"


def key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*key)


def depth_for(keys: int, part_keys: int = PART_KEYS) -> int:
    """Leading bits that cut so many keys into parts of at most about ``part_keys``."""
    return max(keys - 1, 0).bit_length() - (part_keys.bit_length() - 1) if keys > part_keys else 0


def prefix(hashed: Column, depth: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - depth) if depth else F.lit(0).cast("long")


def part_name(hashed: Column, depth: int) -> Column:
    return F.concat(F.lit(f"{depth}-"), prefix(hashed, depth).cast("string"))


def filter_bits(keys: int, depth: int) -> int:
    """Size of the filters of a batch, the same for all its parts: a power of two."""
    return 1 << max(BITS_A_KEY * max(keys >> depth, 1) - 1, 1023).bit_length()


def _positions(hashed: Column, bits: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(hashed, F.lit(n)), bits) for n in range(POSITIONS)]


def index_rows(keys: DataFrame, key: Sequence[str], depth: int, bits: int) -> DataFrame:
    """One row for each part of ``keys`` (distinct rows of ``key``)."""
    hashed = key_hash(key)
    rows = keys.select(part_name(hashed, depth).alias(PART), prefix(hashed, depth).alias("prefix"), hashed.alias("hash"), F.col(key[0]).alias("first"))
    dealt = rows.repartition(1 << depth, PART).sortWithinPartitions(PART)
    dealt = dealt.select(PART, "prefix", "first", F.array(*_positions(F.col("hash"), F.lit(bits).cast("long"))).alias("at"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None

        def done() -> pa.RecordBatch:
            words = np.packbits(held, bitorder="little").view("<i8")
            values = [[part[0]], [depth], [part[1]], [least], [most], [words]]
            types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=[PART, "depth", "prefix", "least", "most", "words"])

        for batch in batches:
            names = batch.column(PART).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(names)]):
                if start == stop:
                    continue
                rows = batch.slice(start, stop - start)
                if part is None or part[0] != names[start]:
                    if part is not None:
                        yield done()
                    part, held, least, most = (names[start], rows.column("prefix")[0].as_py()), np.zeros(bits, bool), None, None
                held[rows.column("at").flatten().to_numpy()] = True
                firsts = [x for x in rows.column("first").to_pylist() if x is not None]
                # Code points sort like the bytes that Spark compares.
                least = min([*firsts, *([least] if least is not None else [])], default=None)
                most = max([*firsts, *([most] if most is not None else [])], default=None)
        if part is not None:
            yield done()

    schema = f"{PART} string, depth int, prefix bigint, least string, most string, words array<bigint>"
    return dealt.mapInArrow(build, schema)


def parts_that_may_hold(index: DataFrame, wanted: DataFrame, key: Sequence[str]) -> list[tuple[int, str]]:
    """``(batch, part)`` of the parts that may hold any key of ``wanted``.

    What comes to the driver is at most the list of the parts, which are folders of the table.
    """
    depths = [r["depth"] for r in index.select("depth").distinct().collect()]
    if not depths:
        return []
    hashed = key_hash(key)
    probes = F.array(*[F.struct(F.lit(d).alias("depth"), prefix(hashed, d).alias("prefix")) for d in depths])
    asked = wanted.select(hashed.alias("hash"), F.col(key[0]).alias("first"), F.explode(probes).alias("p")).select("hash", "first", "p.depth", "p.prefix")
    ranges = asked.groupBy("depth", "prefix").agg(F.min("first").alias("low"), F.max("first").alias("high"))
    meets = (F.col("least") <= F.col("high")) & (F.col("most") >= F.col("low"))
    # A key without its first column has no place in a range.
    near = index.select(BATCH, PART, "depth", "prefix", "least", "most").join(ranges, ["depth", "prefix"]).where(F.coalesce(meets, F.lit(True)))
    rows = near.select(BATCH, PART).collect()
    if not rows:
        return []
    filters = index.where(F.col(BATCH).isin(sorted({r[BATCH] for r in rows})) & F.col(PART).isin(sorted({r[PART] for r in rows})))
    filters = filters.select(BATCH, PART, F.col("depth").alias("_depth"), F.col("prefix").alias("_prefix"), "words")
    places = _positions(F.col("hash"), F.size("words").cast("long") * 64)
    set_bits = [F.getbit(F.get("words", F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1 for at in places]
    same = (F.col("depth") == F.col("_depth")) & (F.col("prefix") == F.col("_prefix"))
    hits = asked.join(filters, same & reduce(lambda a, b: a & b, set_bits)).select(BATCH, PART).distinct()
    found = {(r[BATCH], r[PART]) for r in hits.collect()}
    return sorted(found & {(r[BATCH], r[PART]) for r in rows})


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)
