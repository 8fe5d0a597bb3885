"""Operator 4: sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; rank r of n becomes
the fraction (2r + 1) / 2n; all rows sorted by fraction (ties: source, rank)
are cut into shards of equal length, so each shard holds every source in the
proportion of the whole mixture and shard counts differ by at most one
(law ``rows``).

Scale: both orders are computed with ``order.running_sums``: buckets of the
hash (or of the fraction) whose number follows the number of rows, so neither
a hot source nor the global order lands in one task; texts are reduced to
size and crc32 before the first shuffle.

Defined results: null text has size 8 and the crc32 of no bytes (0); a null
source is a source of its own; a null doc_id is hashed as such; rows that are
repeated are placed each; an empty table gives no rows; other columns are
ignored.  The method knows no groups of equal texts: with counts at most one
apart a group larger than a shard could not stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .order import bucket_count, running_sums
from .storage import written

SHARDS = 24
SEED = 42
_HASH_BITS = 56


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of every row of
    ``docs`` (doc_id, text, source)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", text), 64 - _HASH_BITS).alias("hash"))
    rows = written(rows, "rows")
    total = rows.count()
    buckets = bucket_count(total)
    tie = [F.col(c) for c in ("hash", "doc_id", "text_crc32", "size")]
    ranked = running_sums(rows, {"rank": F.lit(1)}, F.floor(F.col("hash") / F.lit((1 << _HASH_BITS) // buckets)), tie,
                          ["source"])
    ranked = ranked.withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("rank_total"))).drop("rank_total")
    placed = running_sums(ranked, {"place": F.lit(1)}, F.floor(F.col("fraction") * buckets),
                          [F.col(c) for c in ("fraction", "source", "rank")])
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    # the first place of shard s is the least p with p * shards >= s * total
    slot = F.col("place") - F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))
            .select("doc_id", "source", "size", "text_crc32", "shard", "slot"))


def op4_interleave_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return interleave(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")
