"""Operator 12 against a plain Merkle tree, and on edge rows."""

import zlib
from hashlib import sha256

import duckdb
from pyspark.sql import functions as F

from funnelkit.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string, members int"


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(r, text):
    values = (r[0], r[3], r[2], r[4], text)
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _paths(nodes):
    """The root of a list of nodes and, for each, its runs of siblings as (before, after)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 8] for k in range(0, len(nodes), 8)]
        for k, at in enumerate(places):
            run, slot = divmod(at, 8)
            paths[k].append((runs[run][:slot], runs[run][slot + 1:]))
            places[k] = run
        nodes = [_h(*run) for run in runs]
    return nodes[0], paths


def _expected(rows, tampered):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r, _leaf(r, r[1])))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = _paths([leaf for _, leaf in by_lang[lang]])
    root, above = _paths([trees[x][0] for x in langs])
    out = []
    for lang, upper in zip(langs, above):
        subroot, paths = trees[lang]
        for (r, leaf), own in zip(by_lang[lang], paths):
            node = leaf
            if tampered(r[0]) and r[1] is not None:
                node = _leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
            for before, after in own + upper:
                node = _h(*before, node, *after)
            proof = _h(*(x for before, after in own + upper for x in before + after))
            out.append((r[0], leaf, subroot, root, proof, node, node == root))
    return out


def _tampered(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 0


def _found(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return merkle.op12_merkle_manifest(spark, str(tmp_path))


def _rows():
    rows = [(k, f"Text {k % 700} É", "hot", f"s{k % 3}", k, "x", k) for k in range(9000)]  # three levels of subtrees
    rows += [(k, None if k % 7 == 0 else "Ab" * k, None, None, None, "x", 0) for k in range(75)]
    rows += [(1, "Lone", "a", "s", 4, "x", 0), (None, "No id", "é", None, 5, "x", 0), (None, "", "é", "", 0, "x", 0)]
    rows += [(5, "Same", "b", "s", 4, "x", 0)] * 30 + [(6, "Long " * 50_000, "b", "s", 250_000, "x", 0)]
    return rows


def test_manifest_matches_a_plain_tree(spark, tmp_path):
    rows = _rows()
    found = _found(spark, rows, tmp_path)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    order = lambda rs: sorted(map(tuple, rs), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert order(found.collect()) == order(_expected(rows, _tampered))
    assert any(not r[-1] for r in _expected(rows, _tampered))


def test_sql_twin_on_edge_rows(spark, tmp_path):
    rows = [r for r in _rows() if r[2] != "hot"] + _rows()[:600]
    found = _found(spark, rows, tmp_path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(con.sql(merkle.OP12_SQL).fetchall(), key=key)


def test_empty_table_and_own_fields(spark, tmp_path):
    assert _found(spark, [], tmp_path).count() == 0
    docs = spark.createDataFrame([(k, f"A{k}", "g") for k in range(20)], "id long, body string, kind string")
    rows = merkle.manifest(docs, {"body": F.lit("other")}, F.col("id") == 3, fields=("id", "body"), key="id", group="kind").collect()
    assert {r["id"]: r["folded"] == r["root"] for r in rows} == {k: k != 3 for k in range(20)}
    assert sorted(r["place"] for r in rows) == list(range(20)) and len({r["root"] for r in rows}) == 1


def test_a_fold_reads_only_the_siblings_to_the_right():
    parent = merkle.Parent([bytes([97 + k]) * 64 for k in range(8)])
    assert parent.fold(3, b"x" * 64) == sha256(b"".join(bytes([97 + k]) * 64 if k != 3 else b"x" * 64 for k in range(8))).hexdigest().encode()
    assert len(parent.right(7)) == 0 and len(parent.states) == 8
