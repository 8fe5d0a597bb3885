"""Operator 9 and its pipeline stage: links that hubs miss, linear candidates,
null and repeated ids."""

import os
import random

import pytest

from pyspark.sql import functions as F

from funnelkit.llm import near
from funnelkit.llm.sieve import sieve, sifted
from funnelkit.storage import shared_folder

SCHEMA = "doc_id long, text string, lang string"


def _words(rng, n, kinds=10**6):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def _brute(rows, shingle, similarity=80):
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        k = min(shingle, len(w))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    least = {}
    for k, r in enumerate(rows):
        least.setdefault(top(k), []).append(r[0])
    ids = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(r[0], len(s), ids[top(k)]) for k, (r, s) in enumerate(zip(rows, sets))]


def _template(n, seed=1):
    """A shared template, different bodies: alike below the threshold."""
    rng = random.Random(seed)
    shared = _words(rng, 120)
    return [(k, " ".join(shared + _words(rng, 55)), None) for k in range(n)]


def _edited(n, seed=2):
    """Copies of one text, each edited on its own: linked through that text only."""
    rng = random.Random(seed)
    base = _words(rng, 400)
    rows = [(0, " ".join(base), None)]
    for k in range(1, n):
        own = [w if rng.random() > 0.045 else f"e{k}x{j}" for j, w in enumerate(base)]
        rows.append((k, " ".join(own), None))
    return rows


def _candidates(spark, monkeypatch, rows):
    counts = []

    def counted(pairs, *args, _real=near.confirmed):
        counts.append(pairs.count())
        return _real(pairs, *args)

    monkeypatch.setattr(near, "confirmed", counted)
    found = near.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3).cache(), shingle=2)
    got = sorted(map(tuple, found.collect()), key=repr)
    monkeypatch.undo()
    return got, sum(counts)


@pytest.mark.parametrize("make, least", [(_template, 10), (_edited, 42)])
def test_candidates_grow_with_the_rows(spark, monkeypatch, make, least):
    n = 200
    found, pairs = _candidates(spark, monkeypatch, make(n))
    assert found == sorted(_brute(make(n), 2), key=repr)
    assert pairs <= least * n < n * (n - 1) / 2  # a hub for each band at most, then what the prefixes leave


def test_links_the_hubs_miss_are_found_by_prefixes(spark):
    rng = random.Random(5)
    rows = _template(40)
    for k in range(40, 60):  # near copies of template documents, far from every hub
        words = rows[k - 40][1].split()
        words[rng.randrange(len(words))] = "edit"
        rows.append((k, " ".join(words), None))
    rows += [(70, " ".join(f"c{j}" for j in range(30)), None), (71, None, None), (72, "", None), (73, "lone", None)]
    want = sorted(_brute(rows, 2), key=repr)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, near.near_duplicates(frame, shingle=2).collect()), key=repr) == want


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(_words(rng, 60)) for _ in range(3))
    rows = [(1, a, "x"), (None, a, "y"), (None, a, "z"), (2, a, "x"), (2, b, "y"), (2, b, "z"), (5, c, "x"), (5, c, "x"),
            (None, c + " tail", "q"), (7, None, "n"), (7, None, "n"), (8, "", "n"), (None, "  ", "n")]
    kept = near.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    found = sorted(((r["doc_id"], r["text"]) for r in kept), key=repr)
    assert found == sorted([(1, a), (2, b), (5, c), (7, None), (7, None), (8, ""), (None, "  ")], key=repr)
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang"}
    nulls = [(None, a, "x"), (None, b, "x"), (None, b, "y")]
    left = near.one_of_each(spark.createDataFrame(nulls, SCHEMA)).collect()
    assert sorted(r["text"] for r in left) == sorted([a, b])
    assert near.one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_consumed_tables_are_deleted(spark):
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    near.near_duplicates(spark.createDataFrame(_template(30), SCHEMA), shingle=2).count()
    kept = sorted(os.listdir(f"{folder}/{x}")[0] for x in set(os.listdir(folder)) - before)
    assert kept == ["classes", "components", "members"]  # what the result reads


def test_a_sieve_splits_rows_without_an_exchange_of_them(spark):
    rows = spark.range(20000).select("id", F.xxhash64("id").alias("h")).unionByName(
        spark.createDataFrame([(-1, None), (-2, 0), (-3, -1), (-4, 1 << 26)], "id long, h long"))
    keys = rows.filter("id % 50 = 0 OR id IN (-2, -3)").select("h")
    may, others = sifted(rows, "h", sieve(keys, "h"))
    found = {r["id"] for r in may.select("id").collect()}
    wanted = set(range(0, 20000, 50)) | {-2, -3}
    assert wanted <= found and len(found) < len(wanted) + 40 and -1 not in found
    assert sorted(r["id"] for r in others.collect()) == sorted({*range(20000), -1, -2, -3, -4} - found)
    assert [k.count() for k in sifted(rows, "h", sieve(keys.limit(0), "h"))] == [0, 20004]
    assert "SortMergeJoin" not in may._jdf.queryExecution().executedPlan().toString()


def test_texts_move_for_candidates_only(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(k, " ".join(_words(rng, 40)), "x") for k in range(400)]
    rows += [(k, rows[k - 400][1] + " tail", "x") for k in range(400, 403)]
    moved = []

    def counted(table, key, bits, _real=sifted):
        may, others = _real(table, key, bits)
        if "text" in table.columns:
            moved.append(may.count())
        return may, others

    monkeypatch.setattr(near, "sifted", counted)
    kept = near.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(400))
    assert moved and max(moved) <= 8


def test_a_large_group_is_dealt_out_and_small_ones_are_not_copied(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("g"), "id")
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("many"), F.min("id").alias("least"))
    known, large = near.with_many(rows, groups, ["g"])
    assert [tuple(r) for r in large.collect()] == [(0, 700)]
    joined = near.dealt_join(known, groups, ["g"]).select("g", "id", "least").collect()
    assert sorted(tuple(r) for r in joined) == [(0 if k < 700 else k, k, 0 if k < 700 else k) for k in range(1000)]
    assert groups.select(F.sum(near._copies())).first()[0] == 300 + 3
