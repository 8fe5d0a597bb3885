"""The corpus operators against brute force on small fixtures, on edge rows
(nulls, empty and long texts, ties, repeated rows, empty tables, clashing
extra columns) and, where SQL can say it, against DuckDB on the given tables."""

import hashlib
import os
import random
import sys
import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from funnelkit.llm import (decontaminate, language, licenses, lines, near, packing, shards,  # noqa: E402
                           substrings, topk)
from funnelkit.llm.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, chunk string"


def _text(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def _rows():
    rng = random.Random(5)
    base, passage = _text(rng, 120), _text(rng, 60)
    block = "\n".join(_text(rng, 6) for _ in range(30))
    texts = [None, "", " \n\t ", "one", base, base, base.upper(), base + " tail", "x " + passage + " y", "z " + passage,
             block, "head line\n" + block + "\nlast line", _text(rng, 9000), "\n" * 500, "a b", "éè ü\x1c ok"]
    texts += [" ".join(w if rng.random() > 0.03 else "edit" for w in base.split()) for _ in range(8)]
    rows = [(k, t, ("en", "de", None)[k % 3], ("hot", None)[k % 5 == 0], len(t or ""), k, t) for k, t in enumerate(texts)]
    return [*rows, rows[4], rows[1]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


def _lower(text):
    return (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()


def test_near_duplicates_match_brute_force(docs):
    sets = []
    for r in _rows():
        w = _lower(r[1])
        k = min(2, len(w))
        sets.append((r[0], {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()))
    least = [d for d, _ in sets]
    for _ in sets:
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    least[a] = least[b] = min(least[a], least[b])
    found = near.near_duplicates(docs.select("doc_id", "text"), shingle=2).collect()
    assert sorted(map(tuple, found)) == sorted((d, len(s), c) for (d, s), c in zip(sets, least))


def test_components_of_a_chain_and_a_star(spark):
    ids = [bytes([k]) for k in range(60)]
    links = [(ids[k], ids[k + 1]) for k in range(20)] + [(ids[30], ids[k]) for k in range(31, 60)]
    found = near.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    assert {bytes(r[0])[0]: bytes(r[1])[0] for r in found} == {k: 0 for k in range(21)} | {k: 30 for k in range(30, 60)}
    assert near.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_substring_repeats_match_brute_force(docs):
    first, rows = {}, [(r[0], (r[1] or "").encode().split()) for r in _rows()]
    for d, w in rows:
        for k in range(len(w) - 12):
            first[tuple(w[k:k + 13])] = min(d, first.get(tuple(w[k:k + 13]), d))
    expected = []
    for d, w in rows:
        gone = {q for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < d for q in range(k, k + 13)}
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        expected.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    found = substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert sum(r[2] for r in expected) > 100


@pytest.mark.parametrize("split", [0, 2, 100])
def test_windows_of_a_frequent_phrase_part(spark, split):
    rng, phrase = random.Random(5), _text(random.Random(2), 6)
    rows = [(k, " ".join([_text(rng, 15), phrase, _text(rng, 15)])) for k in range(40)]
    rows += [(100 + k, rows[k][1] + " " + _text(rng, 20)) for k in range(0, 40, 3)] + [(200, rows[0][1]), (200, rows[1][1])]
    found = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), split=split)
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {
        k: 36 if k >= 100 else 0 for k in [r[0] for r in rows]}


def test_a_row_without_doc_id_keeps_its_words(spark):
    t = _text(random.Random(1), 40)
    found = substrings.remove_repeats(spark.createDataFrame([(None, t), (1, t), (2, t)], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {None: 0, 1: 0, 2: 40}


def test_texts_are_shuffled_once(spark):
    rng, base = random.Random(3), _text(random.Random(4), 30)
    rows = [(k, f"{_text(rng, 15, 10**6)} {base}") for k in range(30)] + [(7, f"{base} tail"), (None, base), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = tempfile.mkdtemp(prefix="funnelkit-texts-") + "/documents"
    docs.write.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = substrings.remove_repeats(spark.read.parquet(path)).select("doc_id", "n_words", "n_removed")
        got = sorted(map(tuple, found.collect()), key=str)
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == sorted([(k, 45, 30 if k else 0) for k in range(30)] + [(7, 31, 30), (None, 30, 0), (None, 1, 0)], key=str)
    # the texts with an id are scanned and exchanged once, those without are only scanned
    scans = [x for x in final.splitlines() if "FileScan parquet" in x and "text#" in x]
    assert len(scans) == 2 and len([x for x in final.splitlines() if "ReusedExchange" in x and "text#" in x]) == 1


def test_repeated_line_chunks_go_but_for_the_first(docs):
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = lines.dedup_lines(docs, with_counts=True)
    assert after.columns == [*docs.columns, "n_lines", "n_removed"]
    rows = {r["doc_id"]: r for r in after.collect()}
    assert len(rows) == len(before) and after.count() == docs.count()
    assert rows[0]["text"] is None and rows[1]["text"] == "" and rows[10]["n_removed"] == 0
    assert rows[11]["n_removed"] > 15 and rows[11]["text"].startswith("head line")
    assert rows[13]["text"] == before[13] and rows[13]["n_lines"] == 501


def _without_passages(rows):
    """Brute force over (doc_id, text) with distinct doc_ids."""
    cut, first = {}, {}
    for d, text in sorted(rows):
        cut[d] = [x for x in text.split("\n")]
        filled = [i for i, x in enumerate(cut[d]) if x.strip(" \t\f\r")]
        for k, (i, j) in enumerate(zip(filled, filled[1:])):
            first.setdefault(tuple(cut[d][i:j + 1]), (d, k))
    out = {}
    for d, text in rows:
        filled, gone = [i for i, x in enumerate(cut[d]) if x.strip(" \t\f\r")], set()
        for k, (i, j) in enumerate(zip(filled, filled[1:])):
            e, q = first[tuple(cut[d][i:j + 1])]
            if e != d or k - q >= 2:
                gone |= set(range(i, j + 1))
        out[d] = "\n".join(x for i, x in enumerate(cut[d]) if i not in gone)
    return out


def test_shared_passages_of_two_lines_and_more_go_whole(spark):
    rng = random.Random(7)
    line = lambda: _text(rng, 7, 10**6)
    rows, expected = [], {}
    for k in range(40):
        passage = [line() for _ in range(2 + k % 4)]
        if k % 3 == 0:
            passage.insert(1, " ")
        for d in (2 * k, 2 * k + 1):
            head, tail = [line() for _ in range(k % 3)], [line() for _ in range(k % 2)]
            rows.append((d, "\n".join([*head, *passage, *tail])))
            expected[d] = "\n".join([*head, *(passage if d == 2 * k else []), *tail])
    rows += [(90, "\n".join(["a"] * 9)), (91, "b\nc\n" * 5), (92, "x\na\na\ny"), (93, "one\n\n"), (94, "lone\none")]
    expected |= {90: "a\na", 91: "b\nc\n", 92: "x\ny", 93: "one\n\n", 94: "lone\none"}
    found = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert dict(map(tuple, found)) == expected == _without_passages(rows)


def test_passages_are_found_by_content_defined_chunks(spark):
    rng = random.Random(9)
    block = [_text(rng, 6, 10**6) for _ in range(60)]
    rows = [(d, "\n".join([_text(rng, 5, 10**6) for _ in range(3 * d)] + block[d:60 - d])) for d in range(4)]
    rows += [(9, "\n".join(["same"] * 20)), (10, "one"), (11, "\n \n"), (12, ""), (13, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunks, pairs = {}, {}
    for r in lines.seeded(docs).collect():
        for s in r["__spans"] or []:
            (chunks if s["seed"] else pairs).setdefault(r["doc_id"], []).append((s["place"], s["last"], s["home"]))
    assert set(chunks) == set(pairs) == {0, 1, 2, 3, 9} and chunks[9] == [(0, 19, 0)]
    for d, text in rows[:5]:
        n = len(text.split("\n"))
        assert sorted(p[:2] for p in pairs[d]) == [(k, k + 1) for k in range(n - 1)]
        inside = {k: a for a, b, _ in chunks[d] for k in range(a, b)}
        assert all(home == inside.get(k) for k, _, home in pairs[d]) and len(chunks[d]) > 5 or d == 9
        assert all(b > a for a, b, _ in chunks[d])
    inner = {tuple(block[a:b + 1]) for a, b, _ in chunks[0] if a > 5 and b < 54}
    for d in (1, 2, 3):  # the cuts follow the lines, wherever the block stands
        text = rows[d][1].split("\n")
        assert inner <= {tuple(text[a:b + 1]) for a, b, _ in chunks[d]}
    gone = {}
    for r in lines.repeated_passages(docs).collect():
        gone.setdefault((r["k_id"], r["seed"]), set()).update(range(r["place"], r["last"] + 1))
    for d in (1, 2, 3):  # chunks take most of the block, pairs carry it on to its ends
        assert len(gone[d, True]) >= 40 and gone[d, True] | gone[d, False] == set(range(3 * d, 60 + d))
    assert not any(d == 0 for d, _ in gone)


def test_passages_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(d, "\n".join(rng.choice(["a", "b", "c", "d", "e", "", " "]) for _ in range(rng.randrange(9)))) for d in range(60)]
    docs = spark.createDataFrame([*rows, rows[5], (None, None)], "doc_id long, text string").repartition(3)
    found = lines.drop_passages(docs).collect()
    assert {r[0]: r[1] for r in found} == _without_passages(rows) | {None: None} and len(found) == 62


def test_exact_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=8).round(1).tolist()) for k in range(140)] + [(k, [0.5] * 8) for k in range(140, 300)]
    rows += [(400, None), (450, []), (500, [1.0, None] * 4), (550, [float("nan")] * 8), (600, [1.0, 2.0]), (None, [1.0] * 8)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    usable = [(i, np.floor(256 * np.array(v))) for i, v in rows if i is not None and i < 300]
    expected = []
    for q, x in usable:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in usable if i != q)[:5]
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_pieces_hold_every_id_once(docs):
    rows = packing.pack(docs.select("doc_id", "text"), with_ids=True).collect()
    per_doc, per_sequence = {}, {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
        per_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    repeated = {4, 1}
    for doc, pieces in per_doc.items():
        assert sum(n for _, n, _ in pieces) == pieces[0][2] * (2 if doc in repeated else 1)
    for pieces in per_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(per_doc) == len({r[0] for r in _rows()})


def test_pieces_hold_the_library_ids(docs):
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in _rows()}
    for r in packing.pack(docs.select("doc_id", "text"), with_ids=True).collect():
        ids = np.array(whole[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert len(ids) == 4 * r["length"] > 0 and r["doc_tokens"] == len(whole[r["doc_id"]])
        assert bytes(r["ids"]) == ids and r["ids_crc32"] == zlib.crc32(ids)


def test_interleaving_matches_brute_force(docs):
    import zlib

    rows = docs.select("doc_id", "text", "source", F.shiftrightunsigned(
        F.xxhash64(F.lit(shards.SEED), "doc_id", F.coalesce("text", F.lit(""))), 8).alias("h")).collect()
    sources, order = {}, []
    for r in rows:
        data = (r["text"] or "").encode()
        sources.setdefault(r["source"], []).append((r["h"], r["doc_id"], zlib.crc32(data), len(data) + 8))
    for source, own in sources.items():
        order += [((2 * k + 1) / (2 * len(own)), source is not None, source or "", k, own[k]) for k in range(len(own)) if own.sort() is None]
    order.sort()
    expected, next_slot = [], {}
    for place, (*_, (_, doc, crc, size)) in enumerate(order):
        shard = place * 5 // len(order)
        next_slot[shard] = next_slot.get(shard, -1) + 1
        expected.append((doc, size, crc, shard, next_slot[shard]))
    found = shards.interleave(docs.select("doc_id", "text", "source"), shards=5)
    assert sorted(map(tuple, found.select("doc_id", "size", "text_crc32", "shard", "slot").collect())) == sorted(expected)


def test_interleaving_is_gapless_and_even(docs):
    rows = shards.interleave(docs.select("doc_id", "text", "source"), shards=4).collect()
    counts = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1 and len(rows) == docs.count()


def test_language_is_learned_and_texts_without_letters_are_und(spark):
    rng = random.Random(3)
    words = {"aa": ["hala", "malana", "lahama"], "bb": ["strix", "krost", "xprit"]}
    rows = [(k, " ".join(rng.choices(words[x], k=12)), x) for k in range(80) for x in [("aa", "bb")[k % 2]]]
    rows += [(90, None, "aa"), (91, "12 !", "bb"), (92, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.filter(~language.held_out()))
    found = {r["doc_id"]: r["language"]["lang"] for r in language.predict(docs, model).collect()}
    assert [found[k] for k in (90, 91, 92)] == ["und"] * 3
    assert all(found[r[0]] == r[2] for r in rows[:80])


def test_held_out_accuracy(spark):
    found = QUERIES["op5_language_id"][0](spark, "/root/testdata/sf0.01").filter("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    share = found.join(truth.filter("lang is not null"), "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.9


def test_benchmark_in_blocks_equals_one_block(docs, spark):
    rows = _rows()
    benchmark = spark.createDataFrame([("i1", rows[8][1]), ("i2", "a b"), ("i3", None), ("i4", "")],
                                      "item_id string, text string")
    one = decontaminate.mark_contamination(docs, benchmark).select("doc_id", "contamination.items")
    many = decontaminate.mark_contamination(docs, benchmark, max_block_bytes=64).select("doc_id", "contamination.items")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    hit = {r["doc_id"]: r["items"] for r in one.collect() if r["items"]}
    assert hit == {8: ["i1"], 9: ["i1"], 14: ["i2"]}


def test_one_benchmark_block_is_collected_at_a_time(spark, monkeypatch):
    steps, collect, tables = [], type(spark.range(1)).collect, decontaminate.pattern_tables
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: steps.append("collect") or collect(df))
    monkeypatch.setattr(decontaminate, "pattern_tables", lambda *a: steps.append("tables") or tables(*a))
    benchmark = spark.createDataFrame([(f"i{k}", f"a{k} b{k}") for k in range(6)], "item_id string, text string")
    docs = spark.createDataFrame([(k, f"x a{k} b{k}") for k in range(7)], "doc_id long, text string")
    found = collect(decontaminate.mark_contamination(docs, benchmark, max_block_bytes=10).select("doc_id", "contamination.items"))
    steps = steps[steps.index("tables") - 1:]  # first() collects too
    assert len(steps) > 4 and steps == ["collect", "tables"] * (len(steps) // 2)
    assert {r[0]: r[1] for r in found} == {k: [f"i{k}"] for k in range(6)} | {6: []}


def _contaminated(texts, items, window=10):
    """{doc_id: (words hit, items)} by looking at every window everywhere."""
    found = {}
    for d, text in texts:
        words, hit, names = text.split(), set(), set()
        for item, passage in items:
            own = passage.split()
            m = min(window, len(own))
            wanted = {tuple(own[k:k + m]) for k in range(len(own) - m + 1)} if own else set()
            for k in range(len(words) - m + 1):
                if tuple(words[k:k + m]) in wanted:
                    hit |= set(range(k, k + m))
                    names.add(item)
        found[d] = (len(hit), sorted(names))
    return found


@pytest.mark.parametrize("block, segment", [(1 << 20, 4096), (400, 7), (150, 1), (90, 3)])
def test_large_items_and_common_suffixes_in_blocks_match_brute_force(spark, block, segment):
    rng = random.Random(3)
    large = _text(rng, 300)
    items = [("large", large), ("short", "w1 w2 w3"), ("tail", _text(rng, 8) + " the end"), ("large too", large),
             *((f"s{k}", _text(rng, 12) + " the end") for k in range(9))]
    texts = [(k, " ".join([_text(rng, 30), " ".join(large.split()[31 * k:31 * k + 9 + k]), items[k][1], _text(rng, 5)]))
             for k in range(len(items))]
    texts += [(90, large), (91, large), (92, _text(rng, 50))]
    docs = spark.createDataFrame([(*t, "x", "y") for t in texts], "doc_id long, text string, __key string, at string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    marked = decontaminate.mark_contamination(docs, benchmark, max_block_bytes=block, segment_windows=segment)
    assert marked.columns == [*docs.columns, "contamination"]
    found = marked.select("doc_id", decontaminate.n_hit().alias("n"), "contamination.items").collect()
    assert {r["doc_id"]: (r["n"], r["items"]) for r in found} == _contaminated(texts, items) and len(found) == len(texts)


def test_excerpts_from_inside_a_licence_get_its_label(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for label, notice in licenses.NOTICES:
        words = notice.split()
        less = [w for w in words if w != rng.choice(words)] if len(words) > 12 else words
        for kept in (words, less):
            expected[len(rows)] = label
            rows.append((len(rows), f"{_text(rng, rng.randrange(90))} {' '.join(kept).upper()}, {_text(rng, 40)}"))
    rows.append((len(rows), f"the software is licensed under this permission {_text(rng, 99)}"))
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    labels = {r["doc_id"]: r["license"]["labels"] for r in found}
    assert labels == {d: [label] for d, label in expected.items()} | {len(rows) - 1: []}


EMPTY = {
    "near": lambda d: near.near_duplicates(d.select("doc_id", "text")),
    "one_of_each": near.one_of_each,
    "substrings": substrings.remove_repeats,
    "lines": lines.dedup_lines,
    "shards": lambda d: shards.interleave(d),
    "packing": lambda d: packing.pack(d.select("doc_id", "text")),
    "language": language.keep_identified,
    "passages": lines.drop_passages,
    "decontaminate": lambda d: decontaminate.decontaminate(d, d.select(F.col("source").alias("item_id"), "text")),
    "licenses": licenses.scan_licenses,
}


@pytest.mark.parametrize("name", sorted(EMPTY))
def test_empty_table(docs, name):
    assert EMPTY[name](docs.limit(0)).count() == 0


def test_letters_only_name_a_language():
    assert language.has_letter("1 a") and language.has_letter("½ 語") and not language.has_letter("½ ² Ⅷ 3 _")
    assert not language.has_letter("")


def test_top_k_of_large_components_is_exact(spark):
    rows = [(0, [2.0**16, 1.0]), (1, [2.0**17, 2.0]), (2, [-(2.0**17), 2.0]), (3, [2.0**17, 1.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    scores = {v: sum(int(256 * a) * int(256 * b) for a, b in zip(x, rows[0][1])) for v, x in rows[1:]}
    assert {r["vec_id"]: r["score"] for r in found} == scores and max(scores.values()) == 2**49 + 2**17


@pytest.mark.parametrize("size", [1e18, 2.0**30])
def test_top_k_that_does_not_fit_fails(spark, size):
    rows = spark.createDataFrame([(0, [size, 1.0]), (1, [size, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="may not fit 64 bits"):
        topk.top_k(rows, F.col("vec_id") % 50 == 0).collect()


def test_top_k_of_nothing(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    query, sql = QUERIES[name]
    found = query(spark, SF)
    expected = con.execute(f"SELECT {', '.join(found.columns)} FROM ({sql})").fetchall()
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_token_files_hold_the_library_ids(spark):
    import public_tokenizers
    import zlib
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    start, expected = 0, []
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = QUERIES["op10_token_files"][0](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_of_texts_with_added_tokens_are_the_librarys(spark, name, spaces):
    import public_tokenizers
    from tokenizers import Tokenizer

    from funnelkit.llm import tokens

    path = public_tokenizers.path(name)
    texts = ["end <|endoftext|> go", "<|endoftext|>", "<|startoftext|>a  b<|endoftext|>", "x<|endoftext|><|endoftext|>y", "",
             "a <|ENDOFTEXT|> b", "<|endoftext |>", "<|endoftext|>\u0338 é\n\nend", "un\x1cdeux <|endoftext|>", "Plain text, 12 words"]
    tokenizer = Tokenizer.from_file(path)
    state = dict(tokens.shared_tokenizer(spark, path, spaces).value)
    for _ in range(2):  # the second time from the cache
        assert [r.tolist() for r in tokens.encode(state, texts)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _one_of_each(rows):
    """Brute force: the smallest doc_id of each group linked at 0.8 over five-word shingles."""
    sets = []
    for d, text in rows:
        w = _lower(text)
        k = min(5, len(w))
        sets.append((d, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()))
    least = {d: d for d, _ in sets}
    pairs = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 80 * len(x | y) > 0]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if least[a] != least[b]:
                least[a] = least[b] = min(least[a], least[b])
                changed = True
    return [(d, t) for d, t in rows if least[d] == d]


def test_pipeline_end_to_end_matches_brute_force(spark):
    import public_tokenizers
    from funnelkit.llm.text import term_words
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in language.keep_identified(docs).select("doc_id", "text").collect())
    assert 0 < len(rows) <= docs.count() and all(t for _, t in rows)
    rows = _one_of_each(sorted(_without_passages(rows).items()))
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = term_words((r["text"] or "").encode())
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        w = term_words(text.encode())
        return not any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in rows if clean(t)}
    found = {}
    for r in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: (r["doc_id"], r["start"])):
        own = found.setdefault(r["doc_id"], [])
        assert r["start"] == len(own)
        own += np.frombuffer(bytes(r["ids"]), "<u4").tolist()
    assert found == expected


def test_pipeline_stages_keep_columns_and_take_effect(docs, spark, tmp_path):
    rows = _rows()
    spark.createDataFrame([(1, rows[8][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        new = stage(spark, now, str(tmp_path))
        assert new.columns == docs.columns, name
        now = new
    left = {r["doc_id"] for r in now.collect()}
    assert not left & {5, 6, 8, 9} and {4, 10, 12} <= left
