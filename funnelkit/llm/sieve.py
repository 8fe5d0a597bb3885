"""Rows without a match left out before they are exchanged.

The hashed keys of the smaller side set bits in a table of ``BITS`` bits, which
is broadcast (8 MB at most, whatever the input).  A row whose bit is not set
matches no key and need not be shuffled to find that out; the others, few of
them by chance, go on to the join that decides.  With more keys than bits every
row goes on, and only time is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def _spot(key: Column) -> Column:
    return F.pmod(key, F.lit(BITS))


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """(part, bits): the bits that column ``key`` (a 64-bit hash) of ``keys``
    sets, 4 KB a row."""
    spots = keys.select(F.bitmap_bucket_number(_spot(F.col(key))).alias("part"),
                        F.bitmap_bit_position(_spot(F.col(key))).alias("at")).distinct()
    # whole parts are built in one place: only positions are exchanged
    return spots.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))


def sifted(rows: DataFrame, key: str, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose ``key`` may be one of the sieve's keys, and
    those whose ``key`` is none of them."""
    own = [F.col(f"`{c}`") for c in rows.columns]
    at = F.bitmap_bit_position(_spot(F.col(key))).cast("int")
    parts = F.broadcast(bits.select(F.col("part").alias("__part"), F.col("bits").alias("__bits")))
    joined = rows.join(parts, F.bitmap_bucket_number(_spot(F.col(key))) == F.col("__part"), "left")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), at % 8 + 1)) != 0, F.lit(False))
    return joined.filter(may).select(*own), joined.filter(~may).select(*own)
