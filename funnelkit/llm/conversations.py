"""Operator 13: repair of conversation structure by prefix-doubling path ranking.

The rows of a conversation, by turn, are edited (Keep, Rerole, Delete, Insert)
until their role initials read ``(s?(ua)+)?``.  A node is (rows read, last role
kept); an arc is one edit.  A cost DP from the end gives each node its cost to
go; the arcs on cheapest paths are the nodes of the ranking.  An arc's rank
among audits of one letter is its letter; the rank for twice the length pairs
its rank with that of the arc its pointer leads to, and the pointer is doubled.
Ranks choose the first arc of each entry, and the letter at audit place t is
found through the pointers of the bits of t.  The DP and the ranking are numpy
over a whole batch of conversations.

Scale: one range shuffle by (conversation, turn) sorts the rows over all tasks;
each task then cuts its sorted rows into segments of at most ``ROWS`` rows and
``BYTES`` of text.  A conversation that lies inside one partition and one
segment (``whole``) is solved where it lies.  The others, at most two for each
partition and the long ones, are solved segment by segment: a segment is a 4 x 4
matrix of costs between last roles, one pass from the end over these small rows
gives the cost to go behind each segment, one pass from the start its entry.
So no task holds more than a segment, whatever a conversation holds; only the
last pass, the hash over a conversation's text, which has one order by
definition, streams a long conversation through one task, and its audit, one
letter a row, is part of its result row.

Defined results: a null role or text is one space; null turns come first; rows
of one turn ascend by role and text (``TIE`` characters of each, then a digest of
both); equal rows stay apart and are duplicates; a null conversation id is a
conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from .storage import written
from .text import crc32_sql

ROWS, BYTES, TIE = 4096, 8 << 20, 64
KEEP, REROLE, TRUNCATED, DELETE, INSERT = 0, 3, 3, 4, 3
SPACES = " \t\n\x0b\x0c\r"
#: faults of a row
FINE, BLANK, DUPLICATE, CUT = range(4)
#: last role kept: none yet, system, user, assistant
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: the role that an inserted or reroled row takes after each last role
NEXT = np.array([USER, USER, ASSISTANT, USER])
NAMES = {USER: "user", ASSISTANT: "assistant"}
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)  # the end of a path and the edits, ascending
END, DEL, INS, KEPT, REROLED = range(5)
FAR = np.int64(1) << 40
#: cost to go behind a conversation's last row: what must still be inserted
ACCEPT = [0, 2 * INSERT, INSERT, 0]


def initials(roles: list[str]) -> list[int]:
    """Role classes by initial: system, user, assistant, or 0 for any other."""
    return [{"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(r[:1], 0) for r in roles]


# -- one batch of segments in numpy ------------------------------------------------
# A code is a byte for each row: role class + 4 * fault.


def _kept(role: np.ndarray, state: int) -> np.ndarray:
    """Which rows of these role classes may follow the last role ``state``."""
    return (role == NEXT[state]) | ((role == SYSTEM) if state == NONE else False)


class Lattice:
    """The cheapest arcs of a batch of segments: ``codes`` (one array each) and
    the cost to go behind each (``after``); ``last``: the conversation ends there."""

    def __init__(self, codes: list[np.ndarray], after: np.ndarray, last: np.ndarray):
        lengths = np.array([len(c) for c in codes], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.ends = self.starts + lengths
        places = int(lengths.sum() + len(codes))
        flat = np.zeros(places, np.uint8)
        for start, c in zip(self.starts, codes):
            flat[start:start + len(c)] = c
        self.role, fault = flat & 3, flat >> 2
        self.cost = np.full((places, 4), FAR, np.int64)
        self.optimal = np.zeros((places, 4, 5), bool)  # by letter
        # behind the last row: end the path, or insert if the conversation ends here
        self.cost[self.ends] = after
        inserting = last[:, None] & (np.array(ACCEPT) > 0)
        self.optimal[self.ends, :, END] = ~inserting
        self.optimal[self.ends, :, INS] = inserting
        by_length = np.argsort(-lengths, kind="stable")
        longest = lengths[by_length]
        for back in range(1, int(longest[0]) + 1 if len(codes) else 0):
            at = self.ends[by_length[:np.searchsorted(-longest, -back, side="right")]] - back
            self._row(at, self.role[at], fault[at])

    def _row(self, at: np.ndarray, role: np.ndarray, fault: np.ndarray) -> None:
        behind = self.cost[at + 1]
        delete = DELETE + behind
        lost = (fault == BLANK) | (fault == DUPLICATE)
        extra = np.where(fault == CUT, TRUNCATED, 0) + np.where(lost, FAR, 0)
        rerole = behind[:, NEXT] + (REROLE + extra)[:, None]
        keep = np.empty_like(behind)
        for state in range(4):
            target = np.where(role == SYSTEM, SYSTEM, NEXT[state])
            keep[:, state] = np.where(_kept(role, state), behind[np.arange(len(at)), target] + extra, FAR)
        best = np.minimum(np.minimum(delete, rerole), keep)
        cost = best.copy()
        # an insertion leads to USER or ASSISTANT at the same place
        cost[:, USER] = np.minimum(best[:, USER], INSERT + best[:, ASSISTANT])
        cost[:, ASSISTANT] = np.minimum(best[:, ASSISTANT], INSERT + best[:, USER])
        for state in (NONE, SYSTEM):
            cost[:, state] = np.minimum(best[:, state], INSERT + cost[:, USER])
        self.cost[at] = cost
        for letter, value in ((DEL, delete), (INS, INSERT + cost[:, NEXT]), (KEPT, keep), (REROLED, rerole)):
            self.optimal[at, :, letter] = (value == cost) & (cost < FAR)

    def arcs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Source node, letter and target node of every arc, by source and letter."""
        place, state, letter = np.nonzero(self.optimal)
        target = np.where((letter == DEL) | (letter == END), state, NEXT[state])
        target = np.where((letter == KEPT) & (self.role[place] == SYSTEM), SYSTEM, target)
        onward = place + ((letter == DEL) | (letter == KEPT) | (letter == REROLED))
        return place * 4 + state, letter, onward * 4 + target

    def audits(self, entries: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
        """For each segment and each last role in ``entries`` (segments, k): the
        least of the cheapest audits, and the last role behind it."""
        source, letter, target = self.arcs()
        first = np.searchsorted(source, np.arange(len(self.cost) * 4 + 1))
        rank, pointers = letter.astype(np.int64), []
        # the least arc of a node: its arcs ascend by letter, and no two share one
        pointer = np.where(letter == END, np.arange(len(letter)), first[target])
        while True:
            pointers.append(pointer)
            if (letter[pointer] == END).all():
                break
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        nodes = (self.starts[:, None] * 4 + entries).ravel()
        chosen = np.array([lo + np.argmin(rank[lo:hi]) for lo, hi in zip(first[nodes], first[nodes + 1])], np.int64)
        # length of a path: the greatest t at which its letter is not the end's
        arc, length = chosen.copy(), np.zeros(len(chosen), np.int64)
        for k in reversed(range(len(pointers))):
            onward = pointers[k][arc]
            go = letter[onward] != END
            arc, length = np.where(go, onward, arc), length + (go.astype(np.int64) << k)
        length += letter[chosen] != END
        path = np.repeat(chosen, length)
        place = np.arange(len(path)) - np.repeat(np.cumsum(length) - length, length)
        for k, doubled in enumerate(pointers):
            path = np.where(place >> k & 1, doubled[path], path)
        text = LETTERS[letter[path]].tobytes().decode()
        cuts = np.cumsum(length)
        parts = [text[b - n:b] for b, n in zip(cuts.tolist(), length.tolist())]
        exits = np.where(letter[arc] == END, source[arc], target[arc]) % 4
        k = entries.shape[1]
        return [parts[j:j + k] for j in range(0, len(parts), k)], exits.reshape(entries.shape)


def matrix(codes: np.ndarray) -> list[int]:
    """Least costs from every last role before a segment to every one behind it."""
    behind = np.where(np.eye(4, dtype=bool), 0, FAR)  # one segment for each last role behind
    lattice = Lattice([codes] * 4, behind, np.zeros(4, bool))
    return lattice.cost[lattice.starts].T.ravel().tolist()


def repaired(audit: str, entry: int, roles: list[str], texts: list[str]) -> tuple[list[tuple[str, str]], int]:
    """The rows that ``audit`` makes of a segment, and the last role behind it."""
    out, at = [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text, entry = roles[at], texts[at], initials(roles[at:at + 1])[0]
        else:
            entry = int(NEXT[entry])
            role, text = NAMES[entry], texts[at] if letter == "R" else ""
        at += letter != "I"
        out.append((role, text))
    return out, entry


# -- segments ------------------------------------------------------------------------


def _cut(rows: int, size: int, kind: pa.DataType) -> Callable:
    """Cuts a sorted partition into segments."""
    schema = pa.schema([("conv_id", kind), ("part", pa.int32()), ("piece", pa.int64()), ("whole", pa.bool_()),
                        ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                        ("codes", pa.binary()), ("same", pa.list_(pa.binary()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, ready, ready_bytes = TaskContext.get().partitionId(), 0, [], 0
        conv, held, held_bytes, closed, first = None, None, 0, False, True

        def segment(whole: bool) -> tuple:
            nonlocal piece
            turns, roles, texts, faults, same = ([r[k] for r in held] for k in range(5))
            if whole:
                seen: set = set()
                for k, s in enumerate(same):
                    if s in seen and faults[k] != BLANK:
                        faults[k] = DUPLICATE
                    seen.add(s)
            codes = bytes(c + 4 * f for c, f in zip(initials(roles), faults))
            piece += 1
            return conv, part, piece, whole, turns, roles, texts, codes, [] if whole else same

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), schema)], schema=schema)

        for b in batches:
            for own, present, turn, role, text, fault, same in zip(*(c.to_pylist() for c in b.columns)):
                if held is None or own != conv:
                    if held is not None:
                        ready.append(segment(not first and not closed))
                        ready_bytes, first = ready_bytes + held_bytes, False
                    conv, held, held_bytes, closed = own, [], 0, False
                elif present and (len(held) >= rows or held_bytes >= size):
                    ready.append(segment(False))
                    ready_bytes += held_bytes
                    held, held_bytes, closed = [], 0, True
                if ready_bytes >= size or len(ready) >= rows:
                    yield batch()
                    ready, ready_bytes = [], 0
                if present:
                    held.append((turn, role, text, fault, same))
                    held_bytes += len(text)
        if held is not None:
            ready.append(segment(False))
        if ready:
            yield batch()

    return cut


def _codes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint8) for c in column.to_pylist()]


def _in_chunks(lengths: list[int], rows: int = 1 << 14) -> Iterator[slice]:
    """Slices of about ``rows`` rows in all."""
    lo, n = 0, 0
    for k, length in enumerate(lengths):
        n += length + 1
        if n >= rows or k + 1 == len(lengths):
            yield slice(lo, k + 1)
            lo, n = k + 1, 0


@F.arrow_udf(StructType().add("audits", ArrayType(StringType())).add("exits", ArrayType(IntegerType())).add("cost", "long"))
def _solve(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Audits of segments: from every last role, or from none for whole conversations."""
    kind = pa.struct([("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())), ("cost", pa.int64())])
    for codes, after, last, whole in batches:
        codes, out = _codes(codes), []
        after, last, whole = np.array(after.to_pylist(), np.int64).reshape(-1, 4), np.array(last.to_pylist(), bool), whole.to_pylist()
        for part in _in_chunks([len(c) for c in codes]):
            lattice = Lattice(codes[part], after[part], last[part])
            entries = np.tile(np.arange(1 if all(whole[part]) else 4), (part.stop - part.start, 1))
            audits, exits = lattice.audits(entries)
            out += [{"audits": a, "exits": e, "cost": int(c)}
                    for a, e, c in zip(audits, exits.tolist(), lattice.cost[lattice.starts, NONE])]
        yield pa.array(out, kind)


@F.arrow_udf(ArrayType(LongType()))
def _matrix(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        yield pa.array([matrix(c) for c in _codes(column)], pa.list_(pa.int64()))


@F.arrow_udf(BinaryType())
def _marked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Codes with the rows outside ``firsts`` (places) as duplicates."""
    for column, firsts in batches:
        out = []
        for codes, places in zip(_codes(column), firsts.to_pylist()):
            codes, first = codes.copy(), np.zeros(len(codes), bool)
            first[np.array(places or [], np.int64)] = True
            again = ~first & (codes >> 2 != BLANK)
            codes[again] = (codes[again] & 3) + 4 * DUPLICATE
            out.append(codes.tobytes())
        yield pa.array(out, pa.binary())


def _passed(rows: DataFrame, back: bool, schema: str, step: Callable) -> DataFrame:
    """One pass over the segments of each conversation in order (or from the
    end): ``step(row, state)`` gives the output row and the next state, which is
    None at a conversation's first segment.  Constant memory."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        for batch in batches:
            out = []
            for values in batch.to_pylist():
                if values["conv_id"] != conv:
                    conv, state = values["conv_id"], None
                made, state = step(values, state)
                out.append(made)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=kinds)

    order = [F.col(c).desc() if back else F.col(c) for c in ("part", "piece")]
    frame = rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return frame.mapInArrow(run, schema)


def _from_the_end(row: dict, state):
    after, last = (ACCEPT, True) if state is None else (state, False)
    costs = row.pop("matrix")
    before = [min(costs[4 * a + b] + after[b] for b in range(4)) for a in range(4)]
    return row | {"after": after, "last": last}, before


def _from_the_start(row: dict, state):
    entry = NONE if state is None else state
    solved = row["solved"]
    made = {"part": row["part"], "piece": row["piece"], "codes": row["codes"], "entry": entry,
            "audit": solved["audits"][entry], "cost": solved["cost"] if state is None else 0}
    return made, solved["exits"][entry]


def repair(rows: DataFrame, present: Column | None = None, segment_rows: int = ROWS, segment_bytes: int = BYTES) -> DataFrame:
    """The repaired ``rows`` (conv_id, turn, role, text) as segments: conv_id,
    (part, piece) in order, whole, the segment's turns, roles, texts and codes
    (role class + 4 * fault a row), the last role before it (``entry``), its
    ``audit`` and the conversation's ``cost`` (at its first segment, else 0).
    Rows where ``present`` does not hold only name their conversation."""
    one = lambda c: F.coalesce(F.col(c), F.lit(" "))
    role, text = one("role"), one("text")
    ending = F.rtrim(text, F.lit(SPACES))
    fault = F.when(ending == "", BLANK).when(~F.right(ending, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(FINE)
    same = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    full = rows.select("conv_id", (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
                       F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                       fault.alias("fault"), same.alias("same"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "__role", "__text", "same", "__row"]
    ordered = full.select("*", F.substring("role", 1, TIE).alias("__role"), F.substring("text", 1, TIE).alias("__text"),
                          F.monotonically_increasing_id().alias("__row")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    kind = rows.schema["conv_id"].dataType
    cut = written(ordered.select(*full.columns).mapInArrow(
        _cut(segment_rows, segment_bytes, to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, part int, piece bigint, whole boolean, turns array<bigint>, "
        "roles array<string>, texts array<string>, codes binary, same array<binary>"), "segments")
    accept = F.array(*[F.lit(x).cast("long") for x in ACCEPT])
    alone = cut.filter("whole").drop("same").withColumn("solved", _solve("codes", accept, F.lit(True), "whole")).select(
        "*", F.lit(NONE).alias("entry"), F.col("solved.audits")[0].alias("audit"), F.col("solved.cost").alias("cost")).drop("solved")
    return alone.unionByName(_joined(cut.filter("not whole"), kind.simpleString()))


def _joined(cut: DataFrame, kind: str) -> DataFrame:
    """The segments of conversations that may have several of them, solved."""
    rows = cut.select("conv_id", "part", "piece", F.posexplode("same").alias("at", "same"))
    firsts = (rows.groupBy("conv_id", "same").agg(F.min(F.struct("part", "piece", "at")).alias("f"))
              .groupBy("f.part", "f.piece").agg(F.collect_list("f.at").alias("firsts")))
    marked = cut.select("conv_id", "part", "piece", "codes").join(firsts, ["part", "piece"], "left").select(
        "conv_id", "part", "piece", _marked("codes", "firsts").alias("codes"))
    costed = written(marked.withColumn("matrix", _matrix("codes")), "costs")
    key = f"conv_id {kind}, part int, piece bigint, codes binary"
    behind = _passed(costed, True, f"{key}, after array<bigint>, last boolean", _from_the_end)
    solved = behind.select("conv_id", "part", "piece", "codes",
                           _solve("codes", "after", "last", F.lit(False)).alias("solved"))
    chosen = written(_passed(solved, False, "part int, piece bigint, codes binary, entry int, audit string, cost bigint",
                             _from_the_start), "entries")
    return cut.drop("same", "codes").join(chosen, ["part", "piece"])


def repaired_turns(segments: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, part, piece, position
    (these three in order), role, text."""

    @F.arrow_udf("array<struct<role:string,text:string>>")
    def rows(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for columns in batches:
            yield pa.array([[{"role": r, "text": t} for r, t in repaired(*x)[0]] for x in zip(*(c.to_pylist() for c in columns))], kind)

    return segments.select("conv_id", "part", "piece", F.posexplode(rows("audit", "entry", "roles", "texts")).alias("position", "turn")).select(
        "conv_id", "part", "piece", "position", "turn.role", "turn.text")


REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")


class _Report:
    """Counts, audit and hash of one conversation, segment by segment."""

    def __init__(self, conv):
        self.conv, self.turns, self.faults, self.illegal, self.cost = conv, [], np.zeros(4, np.int64), 0, 0
        self.least = self.most = self.role = None
        self.distinct, self.audit, self.hash, self.any = 0, [], hashlib.sha256(), False

    def add(self, turns, roles, texts, codes, entry, audit, cost) -> None:
        known = [t for t in turns if t is not None]
        if known:
            self.distinct += len(set(known)) - (known[0] == self.most)
            self.least, self.most = known[0] if self.least is None else self.least, known[-1]
        codes = np.frombuffer(codes, np.uint8)
        self.faults += np.bincount(codes >> 2, minlength=4)
        classes = (codes & 3).tolist()
        for a, b in zip(([] if self.role is None else [self.role]) + classes, classes if self.role is not None else classes[1:]):
            self.illegal += (a, b) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
        self.role = classes[-1] if classes else self.role
        self.cost += cost
        self.audit.append(audit)
        for role, text in repaired(audit, entry, roles, texts)[0]:
            self.hash.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        _, blank, duplicate, cut = self.faults.tolist()
        return (self.conv, gaps, blank, duplicate, cut, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def reports(segments: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turn gaps, rows by first fault, illegal
    neighbours, cost, audit, and the hash of its repaired ``role:text`` lines."""
    kind = segments.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, {REPORT}"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

        for b in batches:
            out = []
            for conv, *segment in zip(*(c.to_pylist() for c in b.columns)):
                if own is None or own.conv != conv:
                    if own is not None:
                        out.append(own.row())
                    own = _Report(conv)
                own.add(*segment)
            if out:
                yield batch(out)
        if own is not None:
            yield batch([own.row()])

    used = ["conv_id", "turns", "roles", "texts", "codes", "entry", "audit", "cost"]
    alone = segments.filter("whole").select(*used).mapInArrow(run, schema)
    several = segments.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").select(
        *used).mapInArrow(run, schema)
    return alone.unionByName(several)


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: conv_id, turn, role, text, present."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", how.alias("how"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(one("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate(one("text"), ".!?", "")).otherwise(one("text")).alias("text"),
        (F.col("how") != 0).alias("present"),
        F.explode(F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return reports(repair(damaged(conversations), F.col("present")))


_SPACE_SQL = r"[\x20\x09-\x0D]"
OP13_SQL = rf"""WITH RECURSIVE raw AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS how FROM conversations),
    live AS (
      SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
             CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN how = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM raw WHERE how <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
             NOT regexp_matches(text, '[^ 	-
]') AS blank,
             NOT regexp_matches(text, '[.!?]{_SPACE_SQL}*$') AS cut,
             CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial FROM live),
    line AS (
      SELECT *, CASE WHEN blank THEN 'blank' WHEN again THEN 'duplicate' WHEN cut THEN 'truncated' ELSE 'fine' END AS fault,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM placed),
    count_of AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM line GROUP BY conv_id),
    -- last role kept ('' none), what may be inserted there: role reached, cost, letters, lines
    filled(was, now, c, a, t) AS (VALUES
      ('', '', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
      ('', 'u', 3, 'I', ['user:']), ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'u', 3, 'I', ['user:']),
      ('s', 'a', 6, 'II', ['user:', 'assistant:']), ('u', 'a', 3, 'I', ['assistant:']), ('a', 'u', 3, 'I', ['user:'])),
    next_role(was, now) AS (VALUES ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
    path AS (
      SELECT conv_id, 0::BIGINT AS pos, '' AS role, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM count_of
      UNION ALL
      SELECT conv_id, pos, role, min(o.c), min(o).a, arg_min(lines, o) FROM (
        SELECT p.conv_id, l.pos, e.now AS role,
               {{'c': p.cost + f.c + e.c, 'a': p.audit || f.a || e.a}} AS o, list_concat(list_concat(p.lines, f.t), e.t) AS lines
        FROM path p JOIN line l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.pos = p.pos + 1
        JOIN filled f ON f.was = p.role JOIN next_role x ON x.was = f.now,
        LATERAL (SELECT f.now AS now, 4 AS c, 'D' AS a, []::VARCHAR[] AS t
          UNION ALL SELECT x.now, 3 + (l.fault = 'truncated')::INT * 3, 'R',
                           [CASE x.now WHEN 'u' THEN 'user:' ELSE 'assistant:' END || l.text] WHERE l.fault NOT IN ('blank', 'duplicate')
          UNION ALL SELECT l.initial, (l.fault = 'truncated')::INT * 3, 'K', [l.role || ':' || l.text]
                    WHERE l.fault NOT IN ('blank', 'duplicate') AND (l.initial = x.now OR (l.initial = 's' AND f.now = ''))) e) s
      GROUP BY conv_id, pos, role),
    ended AS (
      SELECT p.conv_id, min({{'c': p.cost + f.c, 'a': p.audit || f.a}}) AS best,
             arg_min(list_concat(p.lines, f.t), {{'c': p.cost + f.c, 'a': p.audit || f.a}}) AS lines
      FROM path p JOIN count_of k ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND k.n = p.pos
      JOIN filled f ON f.was = p.role WHERE f.now IN ('', 'a') GROUP BY p.conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
           coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN count_of k ON k.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""
