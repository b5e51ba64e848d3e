"""Joins on keys of which one may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartoria.functions.lineage import cut, shuffles_removed


#: A side of at most so many short rows is broadcast.
SMALL = 50_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df`` marked for broadcast if a count shows at most ``rows`` rows, else as it is. Rows must be short."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unique(df: DataFrame) -> DataFrame:
    """``df``, of which no key has many rows, marked to be hashed in a join after the shuffle, so that neither side is sorted."""
    return df.hint("shuffle_hash")


#: Bits of a sieve, 4 MB at least and 16 MB at most, and bits for each value between.
SIEVE_BITS, MOST_BITS, BITS_EACH = 1 << 25, 1 << 27, 4


def most_sought() -> int:
    """So many values the largest sieve still tells from others; more are best sought in parts."""
    return MOST_BITS // BITS_EACH


def sieve_of(values: DataFrame, column: str = "value"):  # noqa: ANN201
    """A broadcast of bits, a power of two by the count of rows, with those of the values of a bigint column set.

    Where few values are sought among many, a sieve saves the shuffle of the others; what it lets through has to be joined exactly.
    ``values`` is read twice: give it as a written table.
    """
    size = min(MOST_BITS, max(SIEVE_BITS, 1 << (BITS_EACH * values.count()).bit_length()))
    bit = F.pmod(F.col(column), F.lit(size)) + 1
    with shuffles_removed(values.sparkSession):
        pieces = values.groupBy(F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")).collect()  # at most MOST_BITS / 32768 rows
    bits = bytearray(size // 8)
    for r in pieces:
        bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = r["m"]
    return values.sparkSession.sparkContext.broadcast(bytes(bits))


def passing(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values a sieve's bytes let through."""
    bit = values.view(np.uint64) % np.uint64(8 * len(bits))
    return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def sifted(df: DataFrame, column: str, sieve) -> DataFrame:  # noqa: ANN001
    """The rows of ``df`` whose bigint ``column`` the sieve lets through; nulls don't pass."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sieve.value, dtype=np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(passing(np.asarray(batch.column(at).to_numpy(zero_copy_only=False), dtype=np.int64), bits)))

    return df.filter(F.col(column).isNotNull()).mapInArrow(run, df.schema)


def hot_keys(df: DataFrame, on: list[str], most: int, buckets: int = 1 << 16) -> DataFrame | None:
    """Keys with more than ``most`` rows and their ``count``, or None if there are none.

    Rows are first counted by ``buckets`` hashes of the key, combined where they are, so that this costs hardly any shuffle; a hot key
    makes a hot bucket, and only the rows of hot buckets are counted by key. The counts are exact. Null keys aren't counted.
    """
    bucket = F.pmod(F.xxhash64(*on), F.lit(buckets)).cast("int")
    known = df
    for c in on:
        known = known.filter(F.col(c).isNotNull())
    full = cut(known.groupBy(bucket.alias("_b")).count().filter(F.col("count") > most).select("_b"))
    if not full.limit(1).count():
        return None
    found = cut(known.withColumn("_b", bucket).join(F.broadcast(full), "_b", "left_semi").groupBy(*on).count().filter(F.col("count") > most))  # at most `buckets` ints
    return found if found.limit(1).count() else None


def blocked_join(left: DataFrame, right: DataFrame, on: list[str], block: int) -> DataFrame:
    """The inner join ``left.join(right, on)``, its hot keys spread over many tasks.

    A key with more than ``block`` rows on the left is split into blocks of about that size; its rows on the right go to
    each block. Without hot keys it is the plain join. ``left`` is read twice: give it as a written table. Null keys match nothing.
    """
    found = hot_keys(left, on, block)
    if found is None:
        return left.join(right, on)
    hot = small(found.select(*on, F.ceil(F.col("count") / block).cast("int").alias("_blocks")))
    own = F.when(F.col("_blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.col("_blocks")).cast("int"))
    spread = left.join(hot, on, "left").withColumn("_block", own).drop("_blocks")
    repeated = right.join(hot, on, "left").withColumn("_block", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))).drop("_blocks")
    return spread.join(repeated, [*on, "_block"]).drop("_block")
