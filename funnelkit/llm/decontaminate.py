"""Operator 2: benchmark decontamination by Wu-Manber multi-pattern search.

The patterns are the ``window``-word windows of the benchmark items (an item
with fewer words is one shorter window).  Patterns of one length form one
Wu-Manber table over *words*: the shift table maps a block of two words to the
distance the search may skip (a block that no pattern holds skips the whole
pattern length but one), the suffix buckets list the patterns that end in a
block, parted by the block they begin with, and a direct comparison of the
words confirms an occurrence.

Scale: a benchmark above ``max_block_bytes`` is cut into segments of
``SEGMENT_WINDOWS`` windows (an item of any length parts), and running sums of
their sizes put them into blocks of at most ``max_block_bytes`` and one segment;
a block's table is the only thing broadcast.  Documents are scanned in place,
one pass per block.  Each pass but the last writes only what it found, once per
text that holds a window; the last one joins that to the documents by the hash
of the text, so no document is rewritten between passes.  One block needs no
shuffle at all.

Defined results: null or empty text has no words and no hits; a null
benchmark text has no windows; an item whose ``item_id`` is null marks words
but is not listed; repeated documents are each scanned; other columns pass
through (a clashing column named like the result column is replaced).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .order import bucket_count, running_sums
from .storage import written
from .text import TERM_WORD, TERM_WORDS_SQL, term_words, utf8

WINDOW = 10
MAX_BLOCK_BYTES = 4 << 20
SEGMENT_WINDOWS = 4096
RESULT = "struct<n_words:bigint,starts:array<int>,ends:array<int>,items:array<string>>"
_ARROW = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                    ("items", pa.list_(pa.string()))])


class PatternTable:
    """Wu-Manber tables for the windows of one length."""

    def __init__(self, length: int, flat: list[bytes] | None = None, shift: dict | None = None,
                 bucket: dict | None = None):
        self.length, self.block = length, min(2, length)
        self.flat = flat or []  # the items' words, one item after the other
        self.shift: dict[tuple, int] = shift or {}
        # by the last block, then by the first one
        self.bucket: dict[tuple, dict[tuple, list[tuple[int, str | None]]]] = bucket or defaultdict(dict)

    def parts(self) -> tuple:
        """Plain values for a broadcast."""
        return self.length, self.flat, self.shift, dict(self.bucket)

    def add(self, item: str | None, words: list[bytes]) -> None:
        base, m, b = len(self.flat), self.length, self.block
        self.flat += words
        for first in range(len(words) - m + 1):
            for end in range(b, m + 1):
                key = tuple(words[first + end - b:first + end])
                self.shift[key] = min(self.shift.get(key, m - b + 1), m - end)
            begins = self.bucket[tuple(words[first + m - b:first + m])]
            begins.setdefault(tuple(words[first:first + b]), []).append((base + first, item))

    def search(self, words: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        m, b, flat, bucket = self.length, self.block, self.flat, self.bucket
        shift, skip, n, end = self.shift.get, m - b + 1, len(words), m
        while end <= n:
            key = (words[end - 2], words[end - 1]) if b == 2 else (words[end - 1],)
            step = shift(key, skip)
            if step:
                end += step
                continue
            here, found = words[end - m:end], False
            for at, item in bucket[key].get(tuple(here[:b]), ()):
                if flat[at:at + m] == here:
                    found = True
                    if item is not None:
                        items.add(item)
            if found:
                if spans and spans[-1][1] >= end - m and spans[-1][0] <= end - m:
                    spans[-1] = (spans[-1][0], end)
                else:
                    spans.append((end - m, end))
            end += 1


def pattern_tables(rows: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> list[PatternTable]:
    tables: dict[int, PatternTable] = {}
    for item, text in rows:
        words = term_words(text)
        if words:
            m = min(window, len(words))
            tables.setdefault(m, PatternTable(m)).add(item, words)
    return list(tables.values())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _segments(items: DataFrame, window: int, segment_windows: int) -> DataFrame:
    """(item, text): every item's words in pieces of at most
    ``segment_windows`` windows, which share ``window - 1`` words."""
    words = F.regexp_extract_all(F.translate("text", ascii_uppercase, ascii_lowercase), F.lit(TERM_WORD), F.lit(0))
    rows = items.select("item", words.alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(segment_windows))
    return rows.select("item", "w", F.explode(starts).alias("at")).select(
        "item", F.array_join(F.slice("w", F.col("at") + 1, segment_windows + window - 1), " ").alias("text")).distinct()


def _blocks(benchmark: DataFrame, max_block_bytes: int, window: int,
            segment_windows: int) -> Iterator[tuple[list[tuple[str | None, bytes | None]], bool]]:
    """The benchmark as lists of (item_id, text), each of bounded size and
    collected when it is asked for, with whether it is the last."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text"))
    total, n = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    parts, last = items.distinct(), 0
    if (total or 0) > max_block_bytes:
        spot = F.pmod(F.xxhash64("item", "text"), F.lit(bucket_count(n)))
        sized = running_sums(_segments(items, window, segment_windows), {"at": F.octet_length("text")}, spot,
                             [F.col("item"), F.col("text")])
        parts = written(sized.select("item", "text", F.expr(f"at div {max_block_bytes}").alias("block")), "segments")
        last = parts.agg(F.max("block")).first()[0] or 0
    for k in range(last + 1):
        part = parts.filter(F.col("block") == k) if "block" in parts.columns else parts
        yield [(r[0], r[1].encode() if r[1] is not None else None) for r in part.collect()], k == last


def mark_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                       into: str = "contamination", max_block_bytes: int = MAX_BLOCK_BYTES,
                       segment_windows: int = SEGMENT_WINDOWS) -> DataFrame:
    """``docs`` with a struct column ``into``: number of words, the spans
    [start, end) of words inside benchmark windows (merged within a block,
    ascending) and the sorted ids of the items that have an occurring window."""
    spark = docs.sparkSession
    own, earlier = [c for c in docs.columns if c != into], []
    for rows, last in _blocks(benchmark, max_block_bytes, window, segment_windows):
        tables = spark.sparkContext.broadcast([t.parts() for t in pattern_tables(rows, window)])
        del rows  # the next block is collected without this one
        if not last:
            hits = docs.select(F.col(text).alias("t")).withColumn("found", _search(tables)("t"))
            hits = hits.filter(F.size("found.starts") > 0).select(F.sha2("t", 256).alias("__key"), "found")
            earlier.append(written(hits.dropDuplicates(["__key"]), "hits"))
            tables.unpersist()
    if not earlier:
        return docs.withColumn(into, _search(tables)(F.col(text)))
    hits = earlier[0]
    for more in earlier[1:]:
        hits = hits.unionByName(more)
    # at most one row per block and text; the written size decides whether the join broadcasts
    before = written(hits.groupBy("__key").agg(F.collect_list("found").alias("before")), "earlier")
    # the documents' own columns travel in a struct, away from the names used here
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), F.sha2(F.col(text), 256).alias("hash"),
                         _search(tables)(F.col(text)).alias("found"))
    marked = marked.join(before, F.col("hash") == F.col("__key"), "left")
    every = F.concat(F.coalesce("before", F.array().cast(f"array<{RESULT}>")), F.array("found"))
    return marked.withColumn("every", every).select(*[F.col(f"own.`{c}`") for c in own], F.struct(
        F.col("found.n_words").alias("n_words"), F.flatten("every.starts").alias("starts"),
        F.flatten("every.ends").alias("ends"),
        F.array_sort(F.array_distinct(F.flatten("every.items"))).alias("items")).alias(into))


def _search(tables):
    @F.arrow_udf(RESULT)
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        all_tables = [PatternTable(*parts) for parts in tables.value]
        for column in batches:
            rows = []
            for text in utf8(column):
                words, spans, items = term_words(text), [], set()
                for table in all_tables:
                    own: list[tuple[int, int]] = []
                    table.search(words, own, items)
                    spans += own
                spans = _merged(spans)
                rows.append((len(words), [s for s, _ in spans], [e for _, e in spans], sorted(items)))
            n, starts, ends, items = zip(*rows) if rows else ((), (), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                fields=list(_ARROW))

    return search.asNondeterministic()  # keeps Catalyst from running it once per use


def n_hit(into: str = "contamination"):
    """Number of words in the union of the spans (spans of several blocks may
    overlap, so they are counted over the sorted ends and starts)."""
    spans = F.array_sort(F.arrays_zip(F.col(f"{into}.starts"), F.col(f"{into}.ends")))
    step = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["ends"] - F.greatest(s["starts"], acc["upto"]))).cast("long").alias("n"),
            F.greatest(acc["upto"], s["ends"]).alias("upto")))
    return step["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    marked = mark_contamination(docs, benchmark, window, into="__contamination")
    return marked.filter(F.size("__contamination.starts") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = mark_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ","), 256).alias("items_sha256"),
        (F.size("contamination.starts") > 0).alias("contaminated"))


OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERM_WORDS_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {TERM_WORDS_SQL} AS w FROM benchmark),
pat AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS m, array_to_string(w[p:p + least({WINDOW}, len(w)) - 1], ' ') AS k
        FROM (SELECT item, w, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
pos AS (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM pat)),
hit AS (SELECT r, p, pos.m AS m, item FROM pos JOIN pat ON pat.m = pos.m AND pat.k = array_to_string(w[p:p + pos.m - 1], ' ')),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
