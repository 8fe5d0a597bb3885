"""Operator 3: substring dedup by super-k-mer partitioning.

Every window of ``window`` words has a minimiser: the smallest hash of its
``MINIMISER``-word grams.  Consecutive windows of a document with the same
minimiser travel together, as one packed string of words, to the bucket of
that minimiser.  In a bucket the windows are sorted by minimiser and words, and
equal ones stream past: the smallest doc_id of each decides which other places
are repeats.

Scale: a minimiser found in one document only has no window to count, so its
strings stay where they are.  A first pass sends (minimiser, doc_id) alone, a
few bytes in place of the string, and nominates the minimisers of two or more
documents; only their strings travel.  A task that meets a minimiser, or later
a packed string, in several documents sends one of them on; the others are
known already, so a passage that a third of all documents hold reaches its
bucket once per task.  The windows of a minimiser that more than ``split``
documents hold go to buckets of their own, by the hash of the window's words:
no bucket grows with a frequent phrase.  The buffers of a task are bounded and
emptied when full, which changes no result.  The texts are shuffled once, by
doc_id: the join with the nominated minimisers and the one with the repeats
found have the same columns and filter of the documents and share the exchange.

Defined results: null or empty text has no words; a document with fewer words
than a window has no window; within one document a repeat is no repeat; rows
equal in doc_id are not repeats of each other; a row without doc_id neither
removes nor loses words; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .near import WordHashes
from .storage import discard, written
from .text import space_words, utf8

WINDOW = 13
MINIMISER = 5
SPLIT = 4096  # documents of a minimiser above which its windows part
TABLE_BYTES = 64 << 20
BUFFER = 1 << 20
_NAMES = ["bucket", "doc_id", "key", "start", "n", "packed"]
_SCHEMA = "bucket long, doc_id long, key long, start long, n long, packed binary"


def super_kmers(words: list[bytes], window: int, known: WordHashes) -> Iterator[tuple[int, int, int]]:
    """(minimiser, first window, number of windows) of the runs of windows."""
    windows = len(words) - window + 1
    if windows < 1:
        return
    size = min(MINIMISER, window)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    grams = np.zeros(n, np.uint64)
    for k in range(size):
        grams = (grams ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(31)
    least = grams[:windows].copy()
    for k in range(1, window - size + 1):
        np.minimum(least, grams[k:k + windows], out=least)
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([starts, [windows]]))
    yield from zip(least[starts].view(np.int64).tolist(), starts.tolist(), sizes.tolist())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], _NAMES)


def _pairs(buckets: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
    """(part, bucket, doc_id) without repeats.  ``part`` is the bucket for the
    smallest and the largest doc_id of each; those between are known to be
    shared and get a part that spreads them."""
    bucket, doc = np.concatenate(buckets), np.concatenate(docs)
    order = np.lexsort((doc, bucket))
    bucket, doc = bucket[order], doc[order]
    new = np.ones(len(bucket), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1])
    bucket, doc = bucket[new], doc[new]
    outer = np.ones(len(bucket), bool)
    outer[1:-1] = (bucket[1:-1] != bucket[:-2]) | (bucket[1:-1] != bucket[2:])
    spread = (doc.view(np.uint64) | np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    part = np.where(outer, bucket, bucket ^ spread.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (part, bucket, doc)], ["part", "bucket", "doc_id"])


def shared_minimisers(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(bucket, doc_id): the minimisers of each document that another document
    also has; ``docs`` has doc_id and text."""

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, buckets, owners, held = WordHashes(), [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                found = [run[0] for run in super_kmers(space_words(text), window, known)]
                buckets.append(np.array(found, np.int64))
                owners.append(np.full(len(found), doc, np.int64))
                held += len(found)
                if held > BUFFER:
                    yield _pairs(buckets, owners)
                    buckets, owners, held = [], [], 0
        if held:
            yield _pairs(buckets, owners)

    pairs = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(
        fingerprints, "part long, bucket long, doc_id long")
    part = W.partitionBy("part")
    shared = (F.min("doc_id").over(part) < F.max("doc_id").over(part)) | (F.col("part") != F.col("bucket"))
    return pairs.select("*", shared.alias("shared")).filter("shared").select("bucket", "doc_id")


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, key, start, n): runs of windows that also start in a document
    with a smaller id; ``docs`` has doc_id, key (a hash of the text), text,
    buckets (its shared minimisers) and parted (those whose windows part)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows to a bucket carry their packed string; rows without one are decided
        known, out = WordHashes(), []
        first: dict[bytes, tuple] = {}
        held = 0
        for batch in batches:
            for doc, key, text, buckets, parted in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)),
                    batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                words, buckets, parted = space_words(text), set(buckets), set(parted)
                for bucket, start, n in super_kmers(words, window, known):
                    if bucket not in buckets:
                        continue
                    size = 1 if bucket in parted else n
                    for at in range(start, start + n, size):
                        packed = b" ".join(words[at:at + size + window - 1])
                        if bucket in parted:
                            row = (xxhash.xxh3_64_intdigest(packed) - (1 << 63), doc, key, at, 1, packed)
                        else:
                            row = (bucket, doc, key, at, n, packed)
                        other = first.get(packed)
                        if other is None:
                            first[packed] = row
                            held += len(packed) + 200
                        elif doc == other[1]:
                            out.append(row)
                        else:
                            if doc < other[1]:
                                first[packed], row = row, other
                            out.append((row[2] ^ row[3], *row[1:5], None))
                if held > TABLE_BYTES:
                    out += first.values()
                    first, held = {}, 0
                while len(out) > 8192:
                    yield _batch(out[:8192])
                    out = out[8192:]
        out += first.values()
        for at in range(0, len(out), 8192):
            yield _batch(out[at:at + 8192])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, group in groupby(rows_of(batches), key=lambda r: r[0]):
            windows = []
            for bucket, doc, key, start, n, packed in group:
                if packed is None:
                    out.append((bucket, doc, key, start, n, None))
                    continue
                words = packed.split(b" ")
                windows += [(b" ".join(words[k:k + window]), doc, key, start + k) for k in range(n)]
            windows.sort()
            gone, last, least = [], None, None
            for words, doc, key, place in windows:
                if words != last:
                    last, least = words, doc
                elif doc > least:
                    gone.append((doc, key, place))
            gone.sort()
            at = 0
            for k, (doc, key, place) in enumerate(gone):
                if k + 1 == len(gone) or gone[k + 1] != (doc, key, place + 1):
                    out.append((0, doc, key, gone[at][2], k + 1 - at, None))
                    at = k + 1
            while len(out) > 8192:
                yield _batch(out[:8192])
                out = out[8192:]
        yield _batch(out)

    packed = docs.select("doc_id", "key", "text", "buckets", "parted").mapInArrow(pack, _SCHEMA)
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(decide, _SCHEMA).select(
        "doc_id", "key", "start", "n")


def remove_repeats(docs: DataFrame, window: int = WINDOW, split: int = SPLIT) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one space, as UTF-8
    bytes) and its sha256 per row of ``docs`` (doc_id, text)."""
    if dict(docs.dtypes)["doc_id"] != "bigint":  # an alias without a cast would tell the two exchanges apart
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    owned = docs.filter("doc_id IS NOT NULL")
    shared = written(shared_minimisers(docs, window), "shared")
    frequent = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > split).select(
        "bucket", F.col("bucket").alias("parted"))
    nominated = written(shared.join(frequent, "bucket", "left").groupBy("doc_id").agg(
        F.collect_set("bucket").alias("buckets"), F.collect_set("parted").alias("parted")), "nominated")
    discard(shared)
    spans = repeats(owned.join(nominated, "doc_id"), window).groupBy(
        F.col("doc_id").alias("s_id"), F.col("key").alias("s_key")).agg(
        F.collect_list("start").alias("starts"), F.collect_list("n").alias("sizes"))
    # the key is compared as a condition: as a join key it would ask for another exchange of the texts
    same = (F.col("doc_id") == F.col("s_id")) & (F.col("key").bitwiseXOR(F.col("s_key")) == 0)
    none = F.lit(None).cast("array<long>")
    joined = owned.join(spans, same, "left").select("doc_id", "text", "starts", "sizes").unionAll(
        docs.filter("doc_id IS NULL").select("doc_id", "text", none.alias("starts"), none.alias("sizes")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                for text, starts, sizes in zip(utf8(part.column(1)), part.column(2).to_pylist(),
                                               part.column(3).to_pylist()):
                    words, gone = space_words(text), 0
                    n = len(words)
                    if starts:
                        steps = np.zeros(n + 1, np.int64)
                        np.add.at(steps, starts, 1)
                        np.add.at(steps, np.array(starts) + np.array(sizes) + window - 1, -1)
                        stay = np.flatnonzero(np.cumsum(steps)[:n] == 0).tolist()
                        words, gone = [words[k] for k in stay], n - len(stay)
                    kept = b" ".join(words)
                    out.append((n, gone, kept, hashlib.sha256(kept).hexdigest()))
                n, gone, kept, sha = zip(*out) if out else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()),
                     pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return joined.mapInArrow(rows, "doc_id long, n_words long, n_removed long, kept binary, kept_sha256 string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, doc_id, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') AS k
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM d)),
f AS (SELECT k, min(doc_id) AS first FROM p GROUP BY k),
g AS (SELECT DISTINCT r, unnest(range(p, p + {WINDOW})) AS q FROM p JOIN f USING (k) WHERE first < doc_id),
a AS (SELECT r, list(q) AS gone FROM g GROUP BY r),
x AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN a USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(gone, i)], ' ')) AS kept_sha256 FROM x
"""
