"""Operator 7: packing by cutting-stock column generation.

A document's ids (with its end id) fill as many whole sequences as they can;
the rest, shorter than a sequence, is the item to pack.  Items fall into
length classes of ``CLASS_TOKENS`` (rounded up).  The classes' histogram is the
demand of a cutting-stock problem: a linear program chooses how often to use
each pattern (how many items of each class share a sequence), and an unbounded
knapsack by dynamic programming prices new patterns until none helps.  The
solution is rounded down, the k-th item of a class goes to the k-th slot that
the patterns offer, and what is left (rounding, and patterns filled less than
``LEAST_FILL``) is laid end to end and cut at sequence ends, so the padding of
all but one sequence stays small whatever the lengths are.

Scale: the linear program sees at most ``length / CLASS_TOKENS`` numbers.
Ranks and running sums come from ``order.running_sums`` (hot classes are
split); ids move once, joined by row to their piece list.

Defined results: null or empty text is the end id alone; repeated documents
are packed each; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .order import bucket_count, running_sums
from .storage import written
from .text import utf8
from .tokens import encode, shared_tokenizer

LENGTH = 2048
CLASS_TOKENS = 16
LEAST_FILL = 0.97
END_ID = 1
_GAP = 2e-3  # column generation stops when the bound is this close,
_STEPS = 20  # or after so many columns per class
_SMOOTH = 0.8


# -- the cutting-stock problem (driver, sizes bounded by the sequence length) --


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: per room the highest value
    and the item taken last (-1: none, the room stays empty by one)."""
    worth = np.full(capacity + 1, -np.inf)
    item = np.full(capacity + 1, -1)
    worth[sizes], item[sizes] = values, np.arange(len(sizes))
    back = worth[::-1].copy()  # back[capacity - size] is the worth of size
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        got = best[:room] + back[capacity - room:capacity]
        k = int(got.argmax())
        best[room] = best[room - 1]
        if got[k] > best[room] + 1e-12:
            best[room], taken[room] = got[k], item[room - k]
    return best, taken


def pattern_for(room: int, taken: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many of each item the best filling of ``room`` holds."""
    pattern = np.zeros(len(sizes))
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= sizes[taken[room]]
    return pattern


def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """matrix @ vector.  Like ``inverted`` without BLAS, whose threads can
    block for good in a driver process that has started a JVM."""
    return np.einsum("ij,j->i", matrix, vector)


def inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by Gauss-Jordan elimination with row pivots."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        top = k + int(np.abs(both[k:, k]).argmax())
        both[[k, top]] = both[[top, k]]
        both[k] /= both[k, k]
        factor = both[:, k].copy()
        factor[k] = 0
        both -= np.outer(factor, both[k])
    return both[:, n:].copy()


def cutting_patterns(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], float]]:
    """Patterns {size: how many} and how often to use each (LP optimum within
    ``_GAP``) so that every item of ``demand`` {size: how many} is covered.

    One knapsack table prices many columns: the best pattern that holds a
    given item, for every item.  Each enters the basis if it still improves
    the solution at the prices of that moment."""
    sizes = np.array(sorted(demand), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[s] for s in sizes], float)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    least, center = 0.0, inverse.sum(axis=0)
    for step in range(_STEPS * len(sizes)):
        duals, entered = inverse.sum(axis=0), False
        # prices smoothed towards the best bound's; the plain ones if that finds nothing
        for prices in (_SMOOTH * center + (1 - _SMOOTH) * duals, duals):
            prices = np.maximum(prices, 0)
            best, taken = knapsack(prices, sizes, capacity)
            if prices @ need / best[capacity] > least:
                least, center = prices @ need / best[capacity], prices
            tried = set()
            for k in np.argsort(-(prices + best[capacity - sizes]), kind="stable"):
                pattern = pattern_for(capacity - sizes[k], taken, sizes)
                pattern[k] += 1
                if inverse.sum(axis=0) @ pattern <= 1 + 1e-7 or pattern.tobytes() in tried:
                    continue
                tried.add(pattern.tobytes())
                use, direction = times(inverse, need), times(inverse, pattern)
                limit = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
                out = int(np.argmin(limit))
                columns[:, out] = pattern
                row = inverse[out] / direction[out]
                inverse -= np.outer(direction, row)
                inverse[out] = row
                entered = True
            if entered:
                break
        else:
            break
        if step % 10 == 9:
            inverse = inverted(columns)
        if times(inverse, need).sum() <= least * (1 + _GAP):
            break
    use = np.maximum(times(inverse, need), 0)
    return [({int(s): int(a) for s, a in zip(sizes, columns[:, k]) if a}, float(use[k])) for k in range(len(sizes))]


def slots(patterns: list[tuple[dict[int, int], float]], capacity: int, least_fill: float):
    """Rounded patterns as slots: number of sequences, and per class the arrays
    (first rank, items per sequence, first sequence, first position)."""
    sequences, offered = 0, {}
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    for pattern, use in patterns:
        times = int(use + 1e-6)
        if not times or sum(s * a for s, a in pattern.items()) < least_fill * capacity:
            continue
        position = 0
        for size in sorted(pattern, reverse=True):
            many = pattern[size]
            table.setdefault(size, []).append((offered.get(size, 0), many, sequences, position))
            offered[size] = offered.get(size, 0) + times * many
            position += many
        sequences += times
    return sequences, {s: (np.array(rows, np.int64).T, offered[s]) for s, rows in table.items()}


# -- documents ----------------------------------------------------------------


def token_table(docs: DataFrame, vocabulary: str, spaces: bool = True, end_id: int = END_ID) -> tuple[DataFrame, int]:
    """Written table (row_id, doc_id, n_tokens, ids) and the bytes per id."""
    spark = docs.sparkSession
    shared = shared_tokenizer(spark, vocabulary, spaces)
    with open(vocabulary, encoding="utf-8") as f:
        known = json.load(f)
    most = max([end_id, *known["model"]["vocab"].values(), *(t["id"] for t in known.get("added_tokens", ()))])
    wide = 2 if most < 1 << 16 else 4

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_id = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [(t or b"").decode("utf-8", "replace") for t in utf8(part.column(1))]
                ids = [np.append(r, np.uint32(end_id)) for r in encode(shared.value, texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row_id, row_id + len(ids)), pa.int64()), part.column(0),
                     pa.array([len(r) for r in ids], pa.int64()),
                     pa.array([r.astype(f"<u{wide}").tobytes() for r in ids], pa.binary())],
                    ["row_id", "doc_id", "n_tokens", "ids"])
                row_id += len(ids)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(plain.mapInArrow(rows, "row_id long, doc_id long, n_tokens long, ids binary"), "tokens"), wide


def piece_plan(rows: DataFrame, length: int = LENGTH, class_tokens: int = CLASS_TOKENS,
               least_fill: float = LEAST_FILL) -> DataFrame:
    """Per row of ``rows`` (row_id, n_tokens): ``pieces``, an array of structs
    (start, length, sequence_id, offset)."""
    items = rows.select(
        "row_id", F.expr(f"n_tokens div {length}").alias("whole"), F.expr(f"n_tokens % {length}").alias("rest"),
        F.expr(f"(n_tokens % {length} + {class_tokens - 1}) div {class_tokens}").alias("size"))
    histogram = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = bucket_count(sum(histogram.values()))
    histogram.pop(0, None)
    capacity = length // class_tokens
    sequences, table = slots(cutting_patterns(histogram, capacity), capacity, least_fill)
    spot = F.pmod(F.xxhash64("row_id"), F.lit(buckets))

    @F.arrow_udf("struct<sequence:bigint,position:bigint>")
    def place(size: pa.Array, rank: pa.Array) -> pa.Array:
        size, rank = size.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, position = np.full(len(size), -1, np.int64), np.zeros(len(size), np.int64)
        for s in np.unique(size):
            if s not in table:
                continue
            (first, many, where, begins), offered = table[s]
            at = np.flatnonzero((size == s) & (rank < offered))
            k = np.searchsorted(first, rank[at], side="right") - 1
            past = rank[at] - first[k]
            sequence[at] = where[k] + past // many[k]
            position[at] = begins[k] + past % many[k]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(position)], names=["sequence", "position"])

    ranked = running_sums(items, {"rank": F.lit(1)}, spot, [F.col("row_id")], ["size"])
    placed = written(ranked.select("row_id", "whole", "rest", place.asNondeterministic()("size", "rank").alias("at"))
                     .select("row_id", "whole", "rest", "at.sequence", "at.position"), "placed")
    loose = F.col("sequence") < 0
    placed = running_sums(placed, {"whole_at": F.col("whole"), "loose_at": F.when(loose, F.col("rest")).otherwise(0)},
                          spot, [F.col("row_id")])
    together = (W.partitionBy(F.when(loose, -1 - F.col("row_id")).otherwise(F.col("sequence"))).orderBy("position")
                .rowsBetween(W.unboundedPreceding, -1))
    placed = placed.withColumn("offset", F.coalesce(F.sum("rest").over(together), F.lit(0)))

    def piece(start, size, sequence, offset):
        return F.struct(start.cast("long").alias("start"), size.cast("long").alias("length"),
                        sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))

    full, rest = F.lit(length).cast("long"), F.col("rest")
    first_whole = F.expr(f"{sequences} + (loose_at_total + {length - 1}) div {length}")
    wholes = F.when(F.col("whole") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("whole") - 1),
        lambda k: piece(k * full, full, first_whole + F.col("whole_at") + k, F.lit(0))))
    begin = F.col("whole") * full
    offset = F.expr(f"loose_at % {length}")
    sequence = F.expr(f"{sequences} + loose_at div {length}")
    ahead = F.least(rest, full - offset)
    cut = F.when(~loose, F.array(piece(begin, rest, F.col("sequence"), F.col("offset")))) \
        .when(rest > ahead, F.array(piece(begin, ahead, sequence, offset),
                                    piece(begin + ahead, rest - ahead, sequence + 1, F.lit(0)))) \
        .otherwise(F.array(piece(begin, rest, sequence, offset)))
    none = F.expr("CAST(array() AS array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>)")
    return placed.select("row_id", F.concat(F.coalesce(wholes, none), F.when(rest > 0, cut).otherwise(none))
                         .alias("pieces"))


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, class_tokens: int = CLASS_TOKENS,
         spaces: bool = True, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset (and the ids themselves)."""
    tokens, wide = token_table(docs, vocabulary or public_tokenizers.path("byte_bpe_50k.json"), spaces, end_id)
    plan = piece_plan(tokens.select("row_id", "n_tokens"), length, class_tokens)

    @F.arrow_udf("array<struct<ids_crc32:bigint,ids:binary>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("ids_crc32", pa.int64()), ("ids", pa.binary())]))
        for ids, starts, sizes in batches:
            out = []
            for data, at, n in zip(ids, starts.to_pylist(), sizes.to_pylist()):
                own = np.frombuffer(data.as_buffer(), f"<u{wide}").astype("<u4")
                cuts = [own[a:a + k].tobytes() for a, k in zip(at, n)]
                out.append([{"ids_crc32": zlib.crc32(c), "ids": c if with_ids else None} for c in cuts])
            yield pa.array(out, kind)

    joined = tokens.join(plan, "row_id").withColumn(
        "made", cut.asNondeterministic()("ids", "pieces.start", "pieces.length"))
    each = joined.select("doc_id", F.col("n_tokens").alias("doc_tokens"),
                         F.explode(F.arrays_zip("pieces", "made")).alias("p"))
    return each.select(
        "doc_id", "p.pieces.start", "p.pieces.length", "p.made.ids_crc32", "doc_tokens", "p.pieces.sequence_id",
        "p.pieces.offset", *(["p.made.ids"] if with_ids else []))


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
