"""Rows of a large table that some keys ask for, found in the scan's own stage.

Documents and pages are costly to read into values and too wide to shuffle, so
neither can wait for a join. The keys that are asked for are hashed into a
bitmap of fixed size, which a scalar subquery hands to every task: each row is
tested where it lies, before anything of it is parsed, whatever the number of
keys and whether or not Spark may broadcast a side of a join. The test lets a
few rows through that nobody asks for; the join that follows is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of the bitmap, 8 MB at most: 6 million keys let one other row in eleven through, and
#: where there are very many more all rows pass, which is then what most of them should.
BITS = 1 << 26
#: Fewest positions, and bytes of a table, as Spark estimates them, to one position.
FEW, BYTES = 1 << 18, 8
#: Positions that one of Spark's bitmaps holds.
BUCKET = 32_768


def _position(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def positions(table: DataFrame) -> int:
    """A number of positions that suits a table, by Spark's estimate of its size; no job runs for it."""
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(BITS, max(FEW, 1 << (size // BYTES).bit_length()))


def bitmap(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """One row with the bitmap of the keys in the only column of ``keys``, cut into buckets.

    Set bits combine before the shuffle, so a frequent key costs nothing, and
    only buckets, not keys, meet in one place.
    """
    key = F.col(keys.columns[0])
    placed = keys.filter(key.isNotNull()).select(_position(key, bits).alias("_at"))
    filled = placed.groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )
    every = keys.sparkSession.range(1, -(-bits // BUCKET) + 1).select(F.col("id").alias("_bucket"))
    parts = every.join(filled, "_bucket", "left").select(F.struct("_bucket", "_bits").alias("_part"))
    listed = F.array_sort(F.collect_list("_part"))
    return parts.agg(F.transform(listed, lambda part: part["_bits"]).alias("bitmap"))


def may_be_in(key: Column, bitmap: DataFrame, bits: int = BITS) -> Column:
    """Whether a key may be in a bitmap; never false for one that is."""
    at = _position(key, bits)
    place = F.bitmap_bit_position(at)
    bucket = F.get(bitmap.scalar(), F.bitmap_bucket_number(at).cast("int") - 1)
    byte = F.conv(F.hex(bucket.substr(F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    found = F.getbit(byte.cast("bigint"), F.pmod(place, F.lit(8)).cast("int")) == 1
    return key.isNotNull() & F.coalesce(found, F.lit(False))


def only_wanted(table: DataFrame, key: Column, keys: DataFrame, bits: int | None = None) -> DataFrame:
    """The rows whose key may be one of ``keys``, a table of one column; a missing key is never wanted."""
    bits = bits or positions(table)
    return table.filter(may_be_in(key, bitmap(keys, bits), bits))
