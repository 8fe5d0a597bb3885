"""Operator 9: near-duplicate documents by MinHash.

A document's set holds its distinct ``shingle``-word shingles (64-bit hashes of
the lower-cased words).  Equal sets form one class; classes are compared, so
copies are never paired with each other.  A class's signature holds the minima
of ``bands * rows`` universal hashes (multiply-shift with odd multipliers);
classes that agree in one band of ``rows`` minima are candidates, those whose
signatures agree often enough are compared on their full sets.  With 40 bands
of 5 a pair at similarity 0.8 escapes with probability (1 - 0.8**5)**40, about
1e-7, and the signature filter sits six standard deviations lower.

Candidates come in two rounds, so that a bucket never emits all its pairs.
First each member meets its bucket's hub: the member that shares most buckets,
which for edited copies is the text they were made from.  The components of
those links are known then.  The classes of buckets that still hold several
components go through an exact prefix-filter join on their full sets: shingles
are ordered by how rare they are among these classes, and two sets at the
threshold share one of the first n - ceil(t * n) + 1, at places that leave room
for the overlap they need.  The members of a shingle's list outside its largest
component meet the members of other components; sizes and places are part of
the join's condition, so only pairs that can still hold leave it.  Pairs inside
one component can change nothing and are never compared.
Components are found by alternating large-star and small-star until the links
stay as they are.

Scale: buckets, hubs and star minima are salted partial aggregates, so a
group that holds a third of all rows is split over ``SALTS`` tasks or more;
sets are built again from the text for candidate classes only.  Texts and
bucket rows that no join can match are left out by ``sieve`` before the exchange,
so whole texts move for candidates and doubles only.  Shingles are
counted in 2**20 hashed counters, whose table has that size for any input.
Every round is written to the shared folder, which cuts lineage; a table is
deleted when what reads it is written.

Defined results: null or empty text, or one without words, has an empty set,
is linked with nothing and is its own component; a text with fewer words than
a shingle is one shingle; a component's id is its smallest doc_id (null only
if all are); rows that repeat a doc_id take part each, with their own text; an
empty table gives no rows; other columns are ignored.  ``one_of_each`` keeps of
each component the row of the smallest (doc_id, hash of the text), nulls last,
and one of the rows that are equal in both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sieve import sieve, sifted
from .storage import discard, written
from .text import space_words, utf8

BANDS, ROWS = 40, 5
_COUNTERS = 1 << 20
SALTS = 32
LARGE = 256
SEED = 11
_WORDS_KEPT = 1 << 18
_STEP = 2048


class WordHashes(dict):
    """Word -> 64-bit hash; a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORDS_KEPT:
            self[word] = found
        return found


def shingle_set(words: list[bytes], shingle: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 1 << 63, (2, n), np.int64).astype(np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minimum of every universal hash, as 32 bits."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at:at + _STEP, None] * a + b
        least = np.minimum(least, part.min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


def band_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit bucket keys (documents, bands) of signatures (documents, bands, rows)."""
    key = np.broadcast_to(np.arange(1, sig.shape[1] + 1, dtype=np.uint64), sig.shape[:2]).copy()
    for k in range(sig.shape[2]):
        key = (key ^ sig[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key


def _signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, place, text): set size, class, band keys, and
    the low byte of every minimum (equal minima have equal bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (a, b) = WordHashes(), multipliers(bands * rows)
        none = np.zeros(bands * rows, "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingle_set(space_words(t, lower=True), shingle, known) for t in utf8(part.column(2))]
                sig = np.stack([signature(s, a, b) if len(s) else none for s in sets])
                keys = band_keys(sig.reshape(-1, bands, rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([k.tobytes() for k in keys], pa.binary()),
                     pa.array([x.tobytes() for x in sig.astype(np.uint8)], pa.binary())],
                    ["doc_id", "place", "n", "cls", "keys", "sig"])

    return docs.mapInArrow(run, "doc_id long, place long, n long, cls binary, keys binary, sig binary")


def _band_rows(classes: DataFrame, bands: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i8")
            who = pa.array(np.repeat(np.arange(batch.num_rows), bands))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), batch.column(0).take(who), batch.column(1).take(who)], ["bucket", "cls", "n"])

    return classes.select("cls", "n", "keys").mapInArrow(cut, "bucket long, cls binary, n long")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, cls, n) of buckets with more than one class, with their
    number, ``many``.  The counts are partial sums, so a hot bucket is read by
    many tasks; the rows join them in the salted key."""
    many = written(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("many")).filter("many > 1"), "buckets")
    rows, _ = sifted(rows, "bucket", sieve(many, "bucket"))
    parts = many.withColumn("salt", F.explode(F.sequence(
        F.lit(0), F.least(F.lit(SALTS - 1), F.expr("cast(many div 64 as int)")))))
    # rows do not know whether their bucket is hot: salt 0 unless it is
    hot = many.filter("many >= 64").select("bucket", F.least(F.lit(SALTS), F.expr("cast(many div 64 as int) + 1"))
                                           .alias("salts"))
    rows = rows.join(hot, "bucket", "left") if hot.head(1) else rows.withColumn("salts", F.lit(None).cast("int"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("cls"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    found = written(rows.join(parts, ["bucket", "salt"]).select("bucket", "cls", "n", "many"), "shared")
    discard(many)
    return found


def _copies() -> Column:
    return F.least(F.lit(SALTS).cast("long"), F.expr(f"many div {LARGE} + 1"))


def dealt_join(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``groups`` in ``keys``.  Both know the number of
    rows of their group, ``many`` (any number below LARGE is as good): the rows
    of a large group are dealt over up to SALTS tasks, each with its copy of the
    other side; a small group is not copied."""
    salt = F.pmod(F.xxhash64(*rows.columns), _copies()).alias("__salt")
    spread = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), _copies() - 1))).drop("many")
    return rows.select("*", salt).join(spread, [*keys, "__salt"]).drop("__salt")


def with_many(rows: DataFrame, groups: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``many`` of its group for the large ones of ``groups``, 1
    for the others, and the written table it comes from."""
    large = written(groups.filter(f"many >= {LARGE}").select(*keys, "many"), "large")
    if not large.head(1):
        return rows.withColumn("many", F.lit(1).cast("long")), large
    return rows.join(large, keys, "left").withColumn("many", F.coalesce("many", F.lit(1).cast("long"))), large


def hub_pairs(shared: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of every member with its bucket's hub: the member whose
    buckets hold most members together, ties by a fixed hash."""
    degree = shared.groupBy("cls").agg(F.sum("many").alias("degree"))
    rows = shared.join(degree, "cls").select("bucket", "cls", "n", "degree", "many")
    hubs = rows.groupBy("bucket", "many").agg(F.max(F.struct("degree", F.xxhash64("cls").alias("h"), "cls", "n")).alias("hub"))
    return dealt_join(rows, hubs, ["bucket"]).filter("cls <> hub.cls").select(
        F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b"),
        F.col("n").alias("n_a"), F.col("hub.n").alias("n_b")).filter(_alike(similarity)).select("a", "b").distinct()


def _alike(similarity: int) -> str:
    """Set sizes that allow 100 * intersection >= similarity * union."""
    return f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"


def class_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(cls, items): the sets of the ``wanted`` classes (cls), built again from
    the text of one row of each."""
    first = written(classes.join(wanted, "cls").select("cls", F.col("doc_id").alias("rep"), "place"), "firsts")
    docs, _ = sifted(docs, "place", sieve(first, "place"))
    texts = docs.join(first, (docs["place"] == first["place"]) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("cls", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [shingle_set(space_words(t, lower=True), shingle, known).tobytes() for t in utf8(part.column(1))]
                same = [k for k, (x, s) in enumerate(zip(part.column(0).to_pylist(), found)) if x == xxhash.xxh3_128_digest(s)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(same, pa.int64())), pa.array([found[k] for k in same], pa.binary())],
                    ["cls", "items"])

    # rows that are equal in id and text give the same set more than once
    found = written(texts.mapInArrow(sets, "cls binary, items binary").dropDuplicates(["cls"]), "sets")
    discard(first)
    return found


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, similarity: int,
              hashes: int, sets: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) that hold on signatures and then on full sets, written."""
    share = similarity / 100
    least = hashes * (share - 6 * (share * (1 - share) / hashes) ** 0.5)

    @F.arrow_udf("boolean")
    def agree(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y in batches:
            same = [int((np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)).sum()) >= least
                    for p, q in zip(x.to_pylist(), y.to_pylist())]
            yield pa.array(same, pa.bool_())

    @F.arrow_udf("boolean")
    def near(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, y in batches:
            out = []
            for p, q in zip(x.to_pylist(), y.to_pylist()):
                p, q = np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8")
                both = len(np.intersect1d(p, q, assume_unique=True))
                out.append(100 * both >= similarity * (len(p) + len(q) - both))
            yield pa.array(out, pa.bool_())

    def joined(rows: DataFrame, table: DataFrame, value: str) -> DataFrame:
        for side in ("a", "b"):
            rows = rows.join(table.select(F.col("cls").alias(side), F.col(value).alias(f"v_{side}")), side)
        return rows

    likely = written(joined(pairs, classes, "sig").filter(agree.asNondeterministic()("v_a", "v_b")).select("a", "b"),
                     "likely")
    own = sets is None
    if own:
        sets = class_sets(likely.select(F.col("a").alias("cls")).union(likely.select("b")).distinct(), classes, docs, shingle)
    links = written(joined(likely, sets, "items").filter(near.asNondeterministic()("v_a", "v_b")).select("a", "b"), "links")
    discard(likely, *([sets] if own else []))
    return links


# -- the exact join of what the hubs left apart -----------------------------------


def _counter(items: np.ndarray) -> np.ndarray:
    return (items * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(44)).astype(np.int64)


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many sets of ``sets`` (cls, items) hold a shingle of each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_COUNTERS, np.int64)
        for batch in batches:
            for items in batch.column(0).to_pylist():
                np.add.at(sums, _counter(np.frombuffer(items, "<u8")), 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], ["counter", "n"])

    table = sets.select("items").mapInArrow(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_COUNTERS, np.int64)
    counts[table["counter"].to_numpy()] = table["n"].to_numpy()
    return counts


def _prefixes(sets: DataFrame, similarity: int) -> DataFrame:
    """(token, cls, place): the rarest shingles of each set, as many as the
    threshold asks for, with their place in its order."""
    shared = sets.sparkSession.sparkContext.broadcast(shingle_counts(sets))  # _COUNTERS numbers

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                firsts = []
                for items in part.column(1).to_pylist():
                    items = np.frombuffer(items, "<u8")
                    order = np.lexsort((items, counts[_counter(items)]))
                    least = -(-similarity * len(items) // 100)
                    firsts.append(items[order[:len(items) - least + 1]])
                who = pa.array(np.repeat(np.arange(part.num_rows), [len(f) for f in firsts]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts).view(np.int64)), part.column(0).take(who),
                     pa.array(np.concatenate([np.arange(len(f)) for f in firsts]))], ["token", "cls", "place"])

    return sets.select("cls", "items").mapInArrow(cut, "token long, cls binary, place long")


def apart_links(apart: DataFrame, known: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int,
                similarity: int, hashes: int) -> DataFrame:
    """``known`` (cls, root) with all links between the classes of ``apart``
    (cls, n, root) that lie in different components."""
    sets = class_sets(apart.select("cls"), classes, docs, shingle)
    lists = written(_prefixes(sets, similarity).join(apart, "cls").select(
        "token", "cls", F.col("n").alias("n_a"), F.col("place").alias("place_a"), "root"), "lists")
    # lists of several components, with the one that has most members there
    top = written(lists.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("k").alias("many"), F.max(F.struct("k", "root")).alias("top")).filter(
        "roots > 1").select("token", "many", F.col("top.root").alias("top")), "top")
    listed, large = with_many(lists, top, ["token"])
    mixed = written(dealt_join(listed, top, ["token"]), "mixed")
    other = mixed.filter("root <> top").select("token", "many", F.col("cls").alias("other"), F.col("n_a").alias("n_b"),
                                               F.col("place_a").alias("place_b"), F.col("root").alias("root_b"))
    # sizes that allow the similarity, and an overlap from these places on that does
    fits = f"{_alike(similarity)} AND {100 + similarity} * least(n_a - place_a, n_b - place_b) >= {similarity} * (n_a + n_b)"
    pairs = dealt_join(mixed, other, ["token"]).filter(
        f"root <> root_b AND (root = top OR cls < other) AND {fits}").select(
        F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()
    pairs = written(pairs, "pairs")
    links = confirmed(pairs, classes, docs, shingle, similarity, hashes, sets)
    discard(sets, lists, top, large, mixed, pairs)
    if links.head(1):
        before, known = known, components(known.select(F.col("cls").alias("a"), F.col("root").alias("b")).union(links))
        discard(before)
    discard(links)
    return known


def _star(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m``, the least v of each u; salted, so that the
    edges of a hub are spread."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    part = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    part = part.withColumn("m", F.min("m").over(W.partitionBy("u")))
    return salted.join(part, ["u", "salt"]).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """(cls, root) of every class in ``links`` (a, b) by alternating
    large-star and small-star; the root is the least class."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, seen = written(edges, "edges"), None
    while True:
        print_ = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if print_ == seen or not print_[0]:
            found = written(edges.select(F.col("u").alias("cls"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()), "components")
            discard(edges)
            return found
        seen = print_
        both = edges.select("u", "v").union(edges.select("v", "u"))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = _star(large)
        small = small.select("u", F.col("m").alias("v")).union(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        before, edges = edges, written(small.distinct(), "edges")
        discard(before)


def judged(docs: DataFrame, shingle: int = 5, similarity: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, place, n, root, component_id) of every row of ``docs`` (doc_id,
    text): ``place`` is a hash of its text, ``root`` its component (null without
    words)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("place"), "text")
    hashes = bands * rows
    full = written(_signatures(docs, shingle, bands, rows), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("first")
    classes = written(full.filter("n > 0").groupBy("cls").agg(
        first, F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig")).select(
        "cls", "first.doc_id", "first.place", "n", "keys", "sig"), "classes")
    members = written(full.select("doc_id", "place", "n", "cls"), "members")
    discard(full)
    shared = shared_buckets(_band_rows(classes, bands))
    links = confirmed(hub_pairs(shared, similarity), classes, docs, shingle, similarity, hashes)
    known = components(links)
    labelled = shared.join(known, "cls", "left").select("bucket", "cls", "n", "many", F.coalesce("root", "cls").alias("root"))
    mixed = labelled.groupBy("bucket", "many").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter(
        "low <> high").select("bucket", "many")
    apart = written(dealt_join(labelled, mixed, ["bucket"]).select("cls", "n", "root").distinct(), "apart")
    discard(shared, links)
    if apart.head(1):
        known = apart_links(apart, known, classes, docs, shingle, similarity, hashes)
    discard(apart)
    whole = classes.select("cls", "doc_id").join(known, "cls").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = known.join(whole, "root").select("cls", "root", "component_id")
    own = classes.select("cls", F.col("doc_id").alias("first_id")).join(linked, "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("root"), F.coalesce("component_id", "first_id").alias("component_id"))
    found = members.filter("n > 0").join(own, "cls").select("doc_id", "place", "n", "root", "component_id")
    return found.union(members.filter("n = 0").select("doc_id", "place", "n", F.lit(None).cast("binary"), "doc_id"))


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)
    of every row of ``docs`` (doc_id, text)."""
    return judged(docs, shingle, similarity, bands, rows).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group (five words, 0.8); rows
    without words stay; columns as they are."""
    rows = written(judged(docs.select("doc_id", "text")).filter("n > 0").groupBy("root", "doc_id", "place").agg(
        F.count(F.lit(1)).alias("k")), "judged")
    # one row per component, the key that stays; a component of one row has nothing to tell
    stays = written(rows.groupBy("root").agg(
        F.count(F.lit(1)).alias("many"), F.max("k").alias("most"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("s")).filter(
        "many > 1 OR most > 1").select("root", "many", F.col("s.doc_id").alias("__id"), F.col("s.place").alias("__place")), "stays")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("place") == F.col("__place"))
    rows, _ = with_many(rows, stays, ["root"])
    named = dealt_join(rows, stays, ["root"]).select(
        F.col("doc_id").alias("__id"), F.col("place").alias("__at"), "k", same.alias("stays"))
    named = written(named.filter("NOT stays OR k > 1"), "named")
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__at"))
    # rows of other texts stay where they are
    left, others = sifted(docs.withColumn("__key", F.xxhash64("text")), "__key", sieve(named, "__at"))
    left = left.join(named.filter("NOT stays"), match, "left_anti")
    again = named.filter("stays")
    if again.head(1):
        equal = left.join(again, match, "left_semi").dropDuplicates(["doc_id", "__key"])
        left = left.join(again, match, "left_anti").unionByName(equal)
    return others.unionByName(left).select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=2).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
