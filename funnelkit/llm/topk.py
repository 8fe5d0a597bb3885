"""Operator 6: exact top-k search by distributed histogram selection.

Queries are scored against all rows; each query keeps an interval of scores
that holds its k-th best.  A pass counts the scores of the interval in
``BINS`` equal bins, the counts of all tasks are added, and the bin in which
the k-th falls becomes the interval, until it is one score wide.  Then rows at
or above the k-th score are filtered and ranked, ties to the smaller id.

A task sends a query's bins from the top only until they hold k scores: lower
bins cannot hold the k-th best.  In the last pass it sends its own best k.
Both are exact, so a query costs at most (k + 1) rows per task however many
scores are equal.

Scale: queries are taken in blocks of ``BLOCK_BYTES`` of vectors, the only
thing broadcast; candidates are scored in place, without a shuffle of vectors.

Defined results: vectors that are null, empty, or hold null or non-finite
components, and rows without an id, take no part; vectors of different length
are not compared; rows with the query's id are its own; a query with no
candidate has no rows; where the norm of a query times the largest norm
reaches 2**62, so that a score may not fit 64 bits, an error is raised; rows that repeat an id are each a candidate, and equal
query rows are one query; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import written

K = 5
EVERY = 50
SCALE = 256
BINS = 64
BLOCK_BYTES = 4 << 20
_ROWS = 2048


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): components as floor(scale * component), usable rows only."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    ok = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                  & (F.abs(c.cast("double")) < float("inf")))
    rows = table.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ok)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("x"))


def _scores(block: dict, ids: np.ndarray, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query numbers, scores, usable) for a candidate matrix."""
    found = block["by_length"].get(x.shape[1])
    if found is None:
        return
    numbers, own, q = found
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2.0**53
    scores = (q.astype(float) @ x.T.astype(float)).astype(np.int64) if exact else q @ x.T
    yield numbers, scores, own[:, None] != ids[None, :]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, x = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    lengths = x.value_lengths().to_numpy(zero_copy_only=False)
    flat, starts = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()[:-1]
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        for k in range(0, len(at), _ROWS):
            part = at[k:k + _ROWS]
            yield ids[part], flat[starts[part][:, None] + np.arange(n)]


def _histograms(rows: DataFrame, shared, low: np.ndarray, width: np.ndarray, k: int, bins: int) -> DataFrame:
    """(q, bin, n) over the intervals [low, low + bins * width)."""
    edges = rows.sparkSession.sparkContext.broadcast((low, width))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, (low, width) = shared.value, edges.value
        sums = np.zeros((len(low), bins + 1), np.int64)  # the last bin: scores above the interval
        for batch in batches:
            for ids, x in _matrices(batch):
                for numbers, scores, usable in _scores(block, ids, x):
                    place = (scores - low[numbers][:, None]) // width[numbers][:, None]
                    usable &= place >= 0
                    place = np.minimum(place, bins) + numbers[:, None] * (bins + 1)
                    sums += np.bincount(place[usable], minlength=sums.size).reshape(sums.shape)
        above = np.cumsum(sums[:, ::-1], axis=1)[:, ::-1] - sums
        q, b = np.nonzero((sums > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(b, pa.int64()), pa.array(sums[q, b])],
                                         ["q", "bin", "n"])

    return rows.mapInArrow(count, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _best(rows: DataFrame, shared, least: np.ndarray, k: int) -> DataFrame:
    """(query_id, q, vec_id, score) at or above ``least``, the best k of each task."""
    bound = rows.sparkSession.sparkContext.broadcast(least)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least = shared.value, bound.value
        best: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            for ids, x in _matrices(batch):
                for numbers, scores, usable in _scores(block, ids, x):
                    r, c = np.nonzero(usable & (scores >= least[numbers][:, None]))
                    for row, score, vec in zip(r.tolist(), scores[r, c].tolist(), ids[c].tolist()):
                        own = best.setdefault(int(numbers[row]), [])
                        own.append((-score, vec))
                        if len(own) > 16 * k:
                            own.sort()
                            del own[k:]
        found = [(block["ids"][q], q, vec, -score) for q, own in best.items() for score, vec in sorted(own)[:k]]
        columns = list(zip(*found)) if found else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         ["query_id", "q", "vec_id", "score"])

    return rows.mapInArrow(pick, "query_id long, q long, vec_id long, score long")


def _block(rows: list) -> dict:
    by_length: dict[int, tuple[list, list, list]] = {}
    for number, (own, x) in enumerate(rows):
        a, b, c = by_length.setdefault(len(x), ([], [], []))
        a.append(number), b.append(own), c.append(x)
    return {"ids": [r[0] for r in rows],
            "by_length": {n: tuple(np.array(v, np.int64) for v in parts) for n, parts in by_length.items()}}


def top_k(table: DataFrame, is_query: Column, k: int = K, bins: int = BINS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer inner products
    of every query row of ``table`` (vec_id, embedding)."""
    spark = table.sparkSession
    rows = written(whole_vectors(table), "vectors")
    queries = written(rows.filter(is_query).distinct(), "queries")
    stats = queries.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    blocks = max(1, -(-stats[0] * (stats[1] or 1) * 8 // BLOCK_BYTES))
    largest = rows.agg(F.max(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c))).first()[0] or 0.0
    out = None
    for number in range(blocks):
        part = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)) == number)
        block = _block([(r[0], r[1]) for r in part.collect()])
        n = len(block["ids"])
        if not n:
            continue
        reach = np.zeros(n, np.int64)  # no score lies beyond the product of the norms
        for numbers, _, q in block["by_length"].values():
            far = np.ceil(np.sqrt((q.astype(float) ** 2).sum(axis=1)) * np.sqrt(largest) * 1.000001 + 1)
            if far.max() >= 2.0**62:
                raise OverflowError("a score may not fit 64 bits: scaled norms multiply to 2**62 or more")
            reach[numbers] = far.astype(np.int64)
        shared = spark.sparkContext.broadcast(block)
        low, width = -reach, -(-(2 * reach + 1) // bins)
        while True:
            counts = np.zeros((n, bins + 1), np.int64)
            for q, b, c in _histograms(rows, shared, low, width, k, bins).collect():
                counts[q, b] = c
            upto = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]  # scores in this bin or above
            place = np.where((upto >= k).any(axis=1), bins - (upto[:, ::-1] >= k).argmax(axis=1), 0)
            low = low + np.minimum(place, bins - 1) * width
            if (width == 1).all():
                break
            width = np.maximum(1, -(-width // bins))
        least = np.where(upto[:, 0] >= k, low, np.iinfo(np.int64).min)  # fewer than k candidates: all of them
        found = written(_best(rows, shared, least, k), "best")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], "query_id long, q long, vec_id long, score long")
    order = W.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"),
                 F.col("vec_id") % EVERY == 0)


OP6_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
