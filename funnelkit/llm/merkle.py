"""Operator 12: a Merkle manifest of a dataset, as a tree of SHA-256 midstates.

Every row is a leaf, ``sha256`` of its fields (``-`` for null, else UTF-8 byte
count, ``:``, value).  The leaves of a group ascend by id; every ``FAN``
consecutive nodes become their parent (the hash of their digests as hex text)
until one node, the group's subroot, remains; the subroots, ordered by group,
give the root in the same way.

A parent keeps a copy of its hash state from before each child slot.  To fold
a changed leaf upwards, the state of its slot is copied and fed only the
replacement and the siblings to its right; the left ones are in the state
already.  Hash states cannot be shipped, so a subtree of ``SPAN`` leaves
(``DEPTH`` levels) is one array row and keeps its states while its task works
on it; for the levels above, the subtree rebuilds one state per level from the
left siblings on its path, and all its leaves copy that.

Scale: the digests are made by the JVM in one scan; texts are never shuffled.
Ranks come from a range partitioning by (group, id) with per-partition bases,
so a group that holds most rows is spread over tasks.  Each level table has a
1/SPAN of the rows of the one below; no task holds more than SPAN nodes, and
only the highest node count of a level reaches the driver.  Every level is
written to the shared folder, which cuts the lineage.

Defined results: null ids come first, rows that repeat an id ascend by leaf
digest; a null group is a group of its own, before all others; a lone leaf is
its subroot and a lone subroot the root; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written
from .text import crc32_sql

FAN, DEPTH = 8, 4
SPAN = FAN ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:binary,right:binary>"
_STEP = T.StructType().add("left", "binary").add("right", "binary")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def row_digest(values: dict[str, Column]) -> Column:
    """SHA-256 (binary) of the values, each ``-`` or its byte count, ``:`` and itself."""
    parts = []
    for value in values.values():
        text = value.cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


# -- the hash tree inside one array of nodes -----------------------------------


def levels_of(nodes: int) -> int:
    """Levels above ``nodes`` nodes, at most DEPTH."""
    n = 0
    while nodes > 1 and n < DEPTH:
        nodes, n = -(-nodes // FAN), n + 1
    return n


class Parent:
    """A parent of up to FAN nodes: its digest, the copied states before each
    child slot, and the children's digests as hex text in one string."""

    __slots__ = ("children", "digest", "states")

    def __init__(self, children: list[bytes]):
        state, self.states = sha256(), []
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.children, self.digest = b"".join(children), state.hexdigest().encode()

    def left(self, slot: int) -> bytes:
        return self.children[:64 * slot]

    def right(self, slot: int) -> bytes:
        return self.children[64 * slot + 64:]

    def fold(self, slot: int, child: bytes) -> bytes:
        return _finish(self.states[slot], child, self.right(slot))


def _finish(state, child: bytes, right: bytes) -> bytes:
    own = state.copy()
    own.update(child + right)
    return own.hexdigest().encode()


def parents(digests: list[bytes], total: int) -> list[list[Parent]]:
    """The parents, level by level, of the nodes (raw digests) of one subtree
    in a group of ``total`` nodes."""
    nodes, out = [d.hex().encode() for d in digests], []
    for _ in range(levels_of(total)):
        out.append([Parent(nodes[k:k + FAN]) for k in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in out[-1]]
    return out


def top(digests: list[bytes], total: int) -> bytes:
    made = parents(digests, total)
    return bytes.fromhex(made[-1][0].digest.decode()) if made else digests[0]


def steps(digests: list[bytes], total: int) -> list[list[tuple[bytes, bytes]]]:
    """For every node, its siblings to the left and right at each level of its subtree."""
    made, out = parents(digests, total), []
    for place in range(len(digests)):
        path = []
        for level in made:
            run, slot = divmod(place, FAN)
            path.append(tuple(bytes.fromhex(x(slot).decode()) for x in (level[run].left, level[run].right)))
            place = run
        out.append(path)
    return out


def proofs(digests: list[bytes], changed: list[bytes | None], total: int,
           above: list[dict]) -> Iterator[tuple[str, str]]:
    """For every leaf of a subtree with the path ``above`` it: the hash of all
    siblings up to the root, and the root folded from the changed digest (the
    leaf's own where there is none)."""
    made = parents(digests, total)
    higher, siblings = [], b""
    for step in above:
        left, right = step["left"].hex().encode(), step["right"].hex().encode()
        higher.append((sha256(left), right))
        siblings += left + right
    for place, (own, other) in enumerate(zip(digests, changed)):
        node, proof = (own if other is None else other).hex().encode(), sha256()
        for level in made:
            place, slot = divmod(place, FAN)
            parent = level[place]
            proof.update(parent.left(slot) + parent.right(slot))
            node = parent.fold(slot, node)
        for state, right in higher:
            node = _finish(state, node, right)
        proof.update(siblings)
        yield proof.hexdigest(), node.decode()


@F.arrow_udf(T.BinaryType())
def _top(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for digests, total in batches:
        yield pa.array([top(d, n) for d, n in zip(digests.to_pylist(), total.to_pylist())], pa.binary())


@F.arrow_udf(T.ArrayType(T.ArrayType(_STEP)))
def _steps(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())])))
    for digests, total in batches:
        yield pa.array([[[{"left": a, "right": b} for a, b in path] for path in steps(d, n)]
                        for d, n in zip(digests.to_pylist(), total.to_pylist())], kind)


@F.arrow_udf(T.ArrayType(T.StructType().add("proof", "string").add("folded", "string")))
def _proofs(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("proof", pa.string()), ("folded", pa.string())]))
    for columns in batches:
        rows = zip(*(c.to_pylist() for c in columns))
        yield pa.array([[{"proof": p, "folded": f} for p, f in proofs(*row)] for row in rows], kind)


# -- the tree over the whole table ----------------------------------------------


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with their 0-based ``place`` in ``group`` by ``order`` (nulls
    first) and the group's ``total``.

    One range partitioning sorts the rows over all tasks; a row's number in its
    partition plus the base of (group, partition) is its place, so no task sees
    a whole group.  Rows that are equal in ``order`` are spread by row number.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)] + [F.col("__row")]
    dealt = written(rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*keys)
                    .sortWithinPartitions(*keys).drop("__row").withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    runs = dealt.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    # one row for each partition that holds rows of the group
    whole = W.partitionBy("__group")
    before = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    bases = runs.select("__group", "__part", F.sum("__n").over(whole).alias("total"),
                        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return dealt.join(bases, F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__part"))).select(
        *rows.columns, (F.col("__at") + F.col("__shift")).alias("place"), "total")


def _subtrees(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    members = F.array_sort(F.collect_list(F.struct("place", "digest", *payload)))
    cut = nodes.groupBy("grp", F.expr(f"place div {SPAN}").alias("subtree")).agg(
        F.first("total").alias("total"), members.alias("members"))
    return written(cut.withColumn("top", _top(F.col("members.digest"), F.col("total"))), name)


def grown(nodes: DataFrame, payload: list[str], name: str) -> list[DataFrame]:
    """The tables of subtrees, lowest first, over ``nodes`` (grp, place, total,
    digest, payload); in the last one every group is one subtree, whose ``top``
    is the group's root."""
    levels = [_subtrees(nodes, payload, f"{name}_0")]
    while (levels[-1].agg(F.max("total")).first()[0] or 0) > SPAN:
        above = levels[-1].select("grp", F.col("subtree").alias("place"),
                                  F.expr(f"(total + {SPAN - 1}) div {SPAN}").alias("total"), F.col("top").alias("digest"))
        levels.append(_subtrees(above, [], f"{name}_{len(levels)}"))
    return levels


def _meet(subtrees: DataFrame, paths: DataFrame) -> DataFrame:
    paths = paths.withColumnsRenamed({"grp": "__grp", "subtree": "__subtree"})
    return subtrees.join(paths, F.col("grp").eqNullSafe(F.col("__grp")) & (F.col("subtree") == F.col("__subtree"))).drop(
        "__grp", "__subtree")


def descended(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The lowest subtrees with the path above each (``above``), from
    ``paths`` (grp, subtree 0, above, more columns) of the highest ones."""
    own = [c for c in paths.columns if c not in ("grp", "subtree", "above")]
    for level in reversed(levels[1:]):
        met = _meet(level, paths).withColumn("__steps", _steps(F.col("members.digest"), F.col("total")))
        paths = met.select("grp", "above", *own, F.explode(F.arrays_zip(F.col("members.place").alias("place"), F.col("__steps").alias("steps"))).alias("m")).select(
            "grp", F.col("m.place").alias("subtree"), F.concat("m.steps", "above").alias("above"), *own)
    return _meet(levels[0], paths)


def manifest(docs: DataFrame, changes: dict[str, Column] | None = None, changed: Column | None = None,
             fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """The manifest of ``docs``: one row per document with its key, the group,
    its ``place`` there, and as lowercase hex its leaf, the group's subroot and
    the root; ``path``, the siblings left and right of the path at every level
    above its subtree of SPAN leaves; ``proof``, the hash of all siblings of
    the whole path; and ``folded``, the root recomputed from the document with
    ``changes`` (new values of fields) where ``changed`` holds, else from the leaf.
    """
    values = {f: F.col(f"`{f}`") for f in fields}
    other = F.when(changed, row_digest(values | changes)) if changes else F.lit(None).cast("binary")
    leaves = docs.select(values[key].alias("key"), F.col(f"`{group}`").alias("grp"),
                         row_digest(values).alias("digest"), other.alias("changed"))
    levels = grown(ranked(leaves, "grp", ["key", "digest"], "leaves"), ["key", "changed"], "subtrees")
    # the subroots are the leaves of one more tree
    subroots = levels[-1].select(F.lit("").alias("all"), "grp", F.col("top").alias("digest"))
    numbered = ranked(subroots, "all", ["grp"], "subroots").withColumnsRenamed({"grp": "lang", "all": "grp"})
    upper = grown(numbered, ["lang"], "upper")
    root = upper[-1].select("grp", F.col("subtree"), F.expr(f"cast(array() as array<{STEP}>)").alias("above"),
                            F.lower(F.hex("top")).alias("root"))
    met = descended(upper, root).withColumn("__steps", _steps(F.col("members.digest"), F.col("total")))
    paths = met.select("above", "root", F.explode(F.arrays_zip(F.col("members").alias("node"), F.col("__steps").alias("steps"))).alias("m")).select(
        F.col("m.node.lang").alias("grp"), F.lit(0).cast("long").alias("subtree"),
        F.concat("m.steps", "above").alias("above"), F.lower(F.hex("m.node.digest")).alias("subroot"), "root")
    proven = descended(levels, paths).withColumn("__proofs", _proofs(
        F.col("members.digest"), F.col("members.changed"), F.col("total"), F.col("above")))
    return proven.select("grp", "subroot", "root", F.col("above").alias("path"), F.explode(
        F.arrays_zip(F.col("members").alias("leaf"), F.col("__proofs").alias("proof"))).alias("m")).select(
        F.col("m.leaf.key").alias(key), F.col("grp").alias(group), F.col("m.leaf.place").alias("place"),
        F.lower(F.hex("m.leaf.digest")).alias("leaf"), "subroot", "root", "path",
        F.col("m.proof.proof").alias("proof"), F.col("m.proof.folded").alias("folded"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id counts as the empty string for the choice of tampered rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    rows = manifest(docs, {"text": F.translate("text", _UPPER, _LOWER)}, tampered)
    return rows.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


_SQL_LEVELS = 7  # 8 ** 7 leaves a group, and as many groups


def _tree_sql(name: str, leaves: str) -> list[str]:
    """WITH steps ``name``_0 (grp, place, d) from ``leaves``, then a level each."""
    made = [f"{name}_0 AS ({leaves})"]
    for k in range(_SQL_LEVELS):
        made.append(f"""{name}_{k + 1} AS (
      SELECT grp, place // {FAN} AS place, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY place)) END AS d
      FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}_{k}) x GROUP BY grp, place // {FAN})""")
    return made


def _climb_sql(name: str, tree: str, start: str) -> list[str]:
    """WITH steps that carry (row, grp, place, proof, folded) of ``start`` up a tree."""
    made, last = [], start
    for k in range(_SQL_LEVELS):
        made.append(f"""{name}_{k + 1} AS (
      SELECT x.row, x.grp, x.place // {FAN} AS place, x.proof || coalesce(string_agg(t.d, '' ORDER BY t.place) FILTER (t.place <> x.place), '') AS proof,
             CASE WHEN (SELECT count(*) FROM {tree}_{k} c WHERE c.grp IS NOT DISTINCT FROM x.grp) = 1 THEN x.folded
                  ELSE sha256(string_agg(CASE WHEN t.place = x.place THEN x.folded ELSE t.d END, '' ORDER BY t.place)) END AS folded
      FROM {last} x JOIN {tree}_{k} t ON t.grp IS NOT DISTINCT FROM x.grp AND t.place // {FAN} = x.place // {FAN}
      GROUP BY x.row, x.grp, x.place, x.proof, x.folded)""")
        last = f"{name}_{k + 1}"
    return made


def _leaf_sql(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" if c != "text" else
             f"CASE WHEN text IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END" for c in FIELDS]
    return f"sha256({' || '.join(parts)})"


OP12_SQL = "WITH " + ",\n".join([
    f"""leaf AS (
      SELECT row_number() OVER () AS row, doc_id, lang AS grp, {_leaf_sql('text')} AS leaf,
             {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS lower_leaf FROM documents)""",
    f"""doc AS (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
             CASE WHEN {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 3 = 0 THEN lower_leaf ELSE leaf END AS changed FROM leaf)""",
    *_tree_sql("low", "SELECT grp, place, leaf AS d FROM doc"),
    f"""subroot AS (
      SELECT grp AS lang, d, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place FROM low_{_SQL_LEVELS})""",
    *_tree_sql("high", "SELECT 0 AS grp, place, d FROM subroot"),
    "lifted_0 AS (SELECT row, grp, place, '' AS proof, changed AS folded FROM doc)",
    *_climb_sql("lifted", "low", "lifted_0"),
    f"""raised_0 AS (
      SELECT row, 0 AS grp, s.place, proof, folded FROM lifted_{_SQL_LEVELS} x JOIN subroot s ON s.lang IS NOT DISTINCT FROM x.grp)""",
    *_climb_sql("raised", "high", "raised_0"),
]) + f"""
SELECT doc.doc_id, doc.leaf, subroot.d AS subroot, high_{_SQL_LEVELS}.d AS root, sha256(r.proof) AS proof_sha256,
       r.folded AS folded_root, r.folded = high_{_SQL_LEVELS}.d AS verified
FROM doc JOIN raised_{_SQL_LEVELS} r ON r.row = doc.row JOIN subroot ON subroot.lang IS NOT DISTINCT FROM doc.grp
     JOIN high_{_SQL_LEVELS} ON TRUE"""
