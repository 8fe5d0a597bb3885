"""Operator 13 against brute force over all edit sequences, and on edge rows."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import pytest

from funnelkit.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, part string, piece int"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def _damage(rows):
    out = []
    for c, t, role, text, *_ in rows:
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(how, 1)
    return out


def _cheapest(rows, faults):
    """Least (cost, audit, lines) by search over whole edit sequences, in order
    of cost and audit; states are (rows read, initials so far)."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        last = roles[-1:]
        if at == len(rows) and LEGAL.match(roles):
            return cost, audit, lines
        if (at, last) in done:
            continue
        done.add((at, last))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for r in set(follow) - {"s"}:
            heapq.heappush(heap, (cost + 3, audit + "I", at, roles + r, (*lines, {"u": "user:", "a": "assistant:"}[r])))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, lines))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 * (faults[at] == "truncated")
                if role[:1] and role[:1] in follow:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + role[:1], (*lines, f"{role}:{text}")))
                for r in set(follow) - {"s"}:
                    name = {"u": "user", "a": "assistant"}[r]
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, roles + r, (*lines, f"{name}:{text}")))


def _report(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "fine" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = _cheapest(rows, faults)
    return (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _expected(rows):
    damaged = _damage(rows)
    return [_report(c, [r for r in damaged if r[0] == c]) for c in {r[0] for r in rows}]


def _rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "uno"])
            text = rng.choice(["Yes.", "no", "why?", None, "", " \n", "A long one.\n", f"{t}!", f"é {t}"])
            rows.append((c, rng.choice([t, t, t, t, t + 3, None]), role, text, "x", 1))
    return rows


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def _found(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return cv.reports(cv.repair(cv.damaged(docs), cv.F.col("present"), **sizes))


@pytest.mark.parametrize("size", [4096, 3])
def test_repair_matches_brute_force(spark, size):
    rows = _rows(size, 120, 14) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes.")]
    rows = [(*r, "x", 1)[:6] for r in rows]
    assert _sorted(_found(spark, rows, segment_rows=size).collect()) == _sorted(_expected(rows))


def test_a_hot_conversation_in_many_segments(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "b", f"{t}?", f"{t}."]), "x", 1) for t in range(700)]
    rows += [(8, 0, "user", "same.", "x", 1)] * 40
    whole = _sorted(_found(spark, rows).collect())
    assert whole == _sorted(_found(spark, rows, segment_rows=16).collect()) == _sorted(_expected(rows))
    assert whole == _sorted(_found(spark, rows, segment_bytes=50).collect())


def test_sql_twin_and_edge_tables(spark, tmp_path):
    rows = [(*r, "x", 1)[:6] for r in _rows(5, 60, 9)] + [(99, 20, "user", "gone", "x", 1)]
    rows += [(98, None, "user", "Long text. " * 20_000, "x", 1), (98, None, "assistant", "End.", "x", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    found = _sorted(cv.op13_conversation_repair(spark, str(tmp_path)).collect())
    assert found == _sorted(con.sql(cv.OP13_SQL).fetchall()) == _sorted(_expected(rows))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert cv.op13_conversation_repair(spark, f"{tmp_path}/none").count() == 0


def test_dropped_conversations_stay_as_zeros(spark):
    gone = [(c, t) for c in range(60) for t in range(30) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:5]
    rows = [(c, t, "user", "Hi.", "x", 1) for c, t in gone]
    empty = hashlib.sha256(b"").hexdigest()
    assert _sorted(_found(spark, rows).collect()) == _sorted([(c, 0, 0, 0, 0, 0, 0, "", empty) for c in {c for c, _ in gone}])


def test_repaired_rows_read_as_turns(spark):
    docs = spark.createDataFrame(_rows(9, 40, 12), SCHEMA)
    turns = cv.repaired_turns(cv.repair(docs, segment_rows=4)).collect()
    by = {}
    for r in sorted(turns, key=lambda r: (r["conv_id"], r["part"], r["piece"], r["position"])):
        by[r["conv_id"]] = by.get(r["conv_id"], "") + r["role"][0]
    assert by and all(LEGAL.match(x) for x in by.values())
