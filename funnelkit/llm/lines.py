"""Operator 8: line dedup by content-defined chunks of lines (native).

A text is cut into lines at ``\\n``.  A rolling hash over the hashes of the
last ``WINDOW`` lines ends a chunk where it is 0 modulo ``MEAN_LINES``; the cut
depends on nothing but those lines, so chunks of a passage are found again
wherever it stands.  Chunks with at least two non-blank lines whose bytes
occur elsewhere are removed, but for the first occurrence by (doc_id, place).
Equal hashes only nominate a chunk; grouping by its whole text compares bytes.
That is operator 8, whose rows its SQL twin fixes; a shared passage goes there
only as far as whole chunks reach.

The pipeline removes shared passages whole (``drop_passages``).  The same kind
of rolling hash, there over the non-blank lines, cuts chunks of two lines at
least; a chunk whose bytes occur earlier goes.  These chunks are the seeds:
line by line, every two non-blank lines in a row (with the blank ones between)
that do not lie in a chunk that goes are then compared as well, so a passage
grows past the ends of its chunks and one without a whole chunk is found too.
Such a pair goes if its bytes occur earlier, in another document or in the
same one without sharing a line.  Each line that goes has an equal one before
it, and a run of one repeated line keeps two.

Scale: DataFrame functions only.  Three passes over the documents: hashes of
all chunks (partial counts, so a chunk that a third of all documents hold is
folded before it moves), texts of the nominated chunks, and the removal.  Only
the nominated chunks' texts are written.  A pair inside a chunk that goes is
not compared: all it could match is also in the chunk's first occurrence.
Joins on chunk hashes and texts are left to the adaptive skew split.

Defined results: null text stays null and has no lines; an empty text is one
blank line; a text that loses all its chunks becomes empty and its row stays;
rows equal in doc_id and text are one document (they lose the same lines); a
null doc_id comes before all others; an empty table gives no rows; other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import discard, written

WINDOW = 3
BASE = 31
MEAN_LINES = 4
SEED_WINDOW = 1
SEED_LINES = 2
BLANK = " \t\n\f\r"


def _rolling(hashes: str, i: Column, window: int) -> Column:
    """The rolling hash of the last ``window`` lines up to place ``i``."""
    return sum(F.coalesce(F.get(hashes, i - k), F.lit(0)) * BASE**k for k in range(window))


def chunked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__chunks``, an array of line chunks (null for null)."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    lines = F.split(F.col(text), "\n", -1)
    hashes = F.transform(lines, lambda line: F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long"))
    # inline() keeps the arrays materialised: inside a lambda they are read, not computed again
    step = docs.select(*own, F.inline_outer(F.array(F.struct(lines.alias("__lines"), hashes.alias("__hashes")))))

    def ends_chunk(i: Column) -> Column:
        return (_rolling("__hashes", i, WINDOW) % MEAN_LINES == 0) | (i == F.size("__lines") - 1)

    ends = F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), ends_chunk)
    step = step.select(*own, F.inline_outer(F.array(F.struct(
        "__lines", F.when(F.col("__lines").isNotNull(), ends).alias("__ends")))))

    def chunk(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("__ends", k - 1) + 1, F.lit(0))
        return F.array_join(F.slice("__lines", start + 1, end - start + 1), "\n")

    return step.select(*own, F.explode(F.array(F.transform("__ends", chunk))).alias("__chunks"))


def filled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__lines`` and ``__filled``, the places of the non-blank
    ones (both null for null)."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.select(*own, F.inline_outer(F.array(F.struct(F.split(F.col(text), "\n", -1).alias("__lines")))))
    places = F.filter(_places("__lines"), lambda i: F.btrim(F.get("__lines", i), F.lit(BLANK)) != "")
    return step.select(*own, F.inline_outer(F.array(F.struct("__lines", places.alias("__filled")))))


def seeded(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__lines``, ``__filled`` and ``__spans`` (null for null):
    (seed, place, last, home), the first and last of some non-blank lines in a
    row, counted in ``__filled``.  Seeds are the content-defined chunks of two
    such lines or more; the others are all pairs.  ``home`` is the place of
    the chunk that a pair lies in, null between two chunks."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    step = filled(docs, text)
    hashes = F.transform("__filled", lambda i: F.xxhash64(F.get("__lines", i)).bitwiseAND(F.lit(0x7FFFFFFF)))
    step = step.select(*own, F.inline_outer(F.array(F.struct("__lines", "__filled", hashes.alias("__hashes")))))

    def zero(i: Column) -> Column:
        return _rolling("__hashes", i, SEED_WINDOW) % SEED_LINES == 0

    def ends_chunk(i: Column) -> Column:
        # no cut next to another one: a chunk has two lines, and a run of one line is not cut
        return ((i > 0) & zero(i) & ~zero(i - 1)) | (i == F.size("__hashes") - 1)

    ends = F.filter(F.sequence(F.lit(0), F.size("__hashes") - 1), ends_chunk)
    step = step.select(*own, F.inline_outer(F.array(F.struct(
        "__lines", "__filled", F.when(F.size("__hashes") > 0, ends).alias("__ends")))))

    def span(seed: bool, place: Column, last: Column, home: Column) -> Column:
        return F.struct(F.lit(seed).alias("seed"), place.cast("int").alias("place"), last.cast("int").alias("last"),
                        home.cast("int").alias("home"))

    def spans(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("__ends", k - 1) + 1, F.lit(0))
        inner = F.transform(F.sequence(start, end - 1), lambda i: span(False, i, i + 1, start))
        whole = F.concat(F.array(span(True, start, end, start)), inner)
        between = F.array(span(False, end, end + 1, F.lit(None)))
        none = F.slice(between, 1, 0)
        return F.concat(F.when(end > start, whole).otherwise(none),
                        F.when(k < F.size("__ends") - 1, between).otherwise(none))

    return step.select(*own, "__lines", "__filled", F.explode(F.array(
        F.flatten(F.transform("__ends", spans)))).alias("__spans"))


def _passage(place: Column, last: Column) -> Column:
    start = F.get("__filled", place)
    return F.array_join(F.slice("__lines", start + 1, F.get("__filled", last) - start + 1), "\n")


def _places(lines: str) -> Column:
    return F.when(F.col(lines).isNotNull(), F.sequence(F.lit(0), F.size(lines) - 1))


def _key() -> list[Column]:
    return [F.col("doc_id").alias("k_id"), F.xxhash64("text").alias("k_text")]


def _multi_line(chunk: str) -> Column:
    """At least two non-blank lines."""
    return F.contains(F.btrim(chunk, F.lit(BLANK)), F.lit("\n"))


def _with_places(rows: DataFrame, nominated: DataFrame) -> DataFrame:
    """k_id, k_text, ``__chunks`` and the like of the nominated documents, a row for each ``place``."""
    own = [c for c in rows.columns if c.startswith("__")]
    texts = rows.select(*_key(), *own).join(
        nominated.select(F.col("k_id").alias("o_id"), F.col("k_text").alias("o_text"), "places"),
        F.col("k_id").eqNullSafe(F.col("o_id")) & (F.col("k_text") == F.col("o_text")))
    return texts.select("k_id", "k_text", *own, F.explode("places").alias("place"))


def _nominated(found: DataFrame) -> DataFrame:
    """(k_id, k_text, places): the places whose hash h occurs more than once."""
    often = written(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "often")
    return found.join(often, "h").groupBy("k_id", "k_text").agg(F.collect_set("place").alias("places"))


def _later(texts: DataFrame, apart: int) -> DataFrame:
    """The rows of ``texts`` (k_id, k_text, place, chunk, ...) whose chunk
    occurs earlier; in the document of its first occurrence only those
    ``apart`` places behind it."""
    order = F.struct("k_id", "k_text", "place")
    firsts = texts.groupBy("chunk").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    # equal rows are one document: a chunk with one place alone occurs once
    firsts = written(firsts.filter(~F.col("first").eqNullSafe(F.col("last"))).select("chunk", "first"), "firsts")
    own = F.col("k_id").eqNullSafe(F.col("first.k_id")) & (F.col("k_text") == F.col("first.k_text"))
    return texts.join(firsts, "chunk").filter(~own | (F.col("place") - F.col("first.place") >= apart))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(k_id, k_text, gone): per document the places of its chunks to remove;
    ``docs`` has doc_id and text."""
    docs = docs.select(F.col("doc_id"), "text")
    chunks = chunked(docs).select(*_key(), F.posexplode("__chunks").alias("place", "chunk"))
    found = chunks.filter(_multi_line("chunk")).select("k_id", "k_text", "place", F.xxhash64("chunk").alias("h"))
    found = written(found, "found")
    texts = _with_places(chunked(docs), _nominated(found)).select(
        "k_id", "k_text", "place", F.get("__chunks", F.col("place")).alias("chunk"))
    texts = written(texts, "nominated")
    return _later(texts, 1).groupBy("k_id", "k_text").agg(F.collect_set("place").alias("gone"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(k_id, k_text, seed, place, last): the spans of ``seeded`` that occur
    earlier; pairs inside such a chunk are left out.  ``docs`` has doc_id and
    text."""
    docs = docs.select(F.col("doc_id"), "text")
    # a span is known by its place in __spans; seeds and pairs have hashes of their own
    found = seeded(docs).select(*_key(), F.posexplode(F.transform("__spans", lambda s: F.xxhash64(
        s.seed, _passage(s.place, s.last)))).alias("place", "h"))
    found = written(found, "found")
    texts = _with_places(seeded(docs), _nominated(found)).select(
        "k_id", "k_text", F.get("__spans", F.col("place")).alias("span"), "__lines", "__filled").select(
        "k_id", "k_text", "span.*", _passage(F.col("span.place"), F.col("span.last")).alias("chunk"))
    texts = written(texts, "nominated")
    discard(found)
    seeds = written(_later(texts.filter("seed"), 1).select("k_id", "k_text", "seed", "place", "last"), "seeds")
    homes = seeds.select(F.col("k_id").alias("o_id"), F.col("k_text").alias("o_text"), F.col("place").alias("o_home"))
    pairs = texts.filter("NOT seed").join(
        homes, F.col("k_id").eqNullSafe(F.col("o_id")) & (F.col("k_text") == F.col("o_text"))
        & (F.col("home") == F.col("o_home")), "left_anti")
    pairs = written(pairs, "pairs")
    discard(texts)
    return seeds.unionAll(_later(pairs, 2).select(seeds.columns))


def _with_gone(docs: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.col("k_id").alias("__id"), F.col("k_text").alias("__text"), F.col("gone").alias("__gone"))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text")), "left")


def drop_passages(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the passages of two or more
    non-blank lines that occur earlier."""
    gone = repeated_passages(docs).groupBy("k_id", "k_text").agg(F.collect_set(F.struct("place", "last")).alias("gone"))
    rows = filled(_with_gone(docs, gone))
    lost = F.flatten(F.transform("__gone", lambda s: F.sequence(F.get("__filled", s.place), F.get("__filled", s.last))))
    kept = F.transform(F.array_except(_places("__lines"), lost), lambda i: F.get("__lines", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    return rows.select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(docs: DataFrame, with_counts: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the repeated chunks taken out of
    ``text``; ``with_counts`` adds n_lines and n_removed (lines)."""
    # a later chunking of the same text gives the same chunks
    rows = chunked(_with_gone(docs, repeated_chunks(docs)))
    kept = F.filter("__chunks", lambda c, k: ~F.array_contains("__gone", k))
    lost = F.filter("__chunks", lambda c, k: F.array_contains("__gone", k))

    def lines(chunks: Column) -> Column:
        return F.aggregate(chunks, F.lit(0).cast("long"),
                           lambda n, c: n + F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1)

    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    counts = [F.coalesce(lines(F.col("__chunks")), F.lit(0)).cast("long").alias("n_lines"),
              F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(lines(lost)).cast("long").alias("n_removed")]
    return rows.select(*[text if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                       *(counts if with_counts else []))


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where it has that column, set anew from the
    text (left as it is for null text)."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, with_counts=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM d),
h AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM l),
e AS (SELECT *, (h + {BASE} * coalesce(lag(h, 1) OVER w, 0) + {BASE**2} * coalesce(lag(h, 2) OVER w, 0)) % {MEAN_LINES} = 0 AS ends
      FROM h WINDOW w AS (PARTITION BY r ORDER BY p)),
g AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM e),
c AS (SELECT r, doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS chunk,
             count(*) FILTER (regexp_matches(line, '\S')) AS filled FROM g GROUP BY r, doc_id, k),
o AS (SELECT *, filled >= 2 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, k) > 1 AS gone FROM c)
SELECT d.doc_id, coalesce(sum(n), 0)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN o USING (r) GROUP BY d.r, d.doc_id
"""
