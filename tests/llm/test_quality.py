"""Operator 11: the chain against enumeration, learning, held-out figures, edge rows."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from funnelkit.llm import quality as q

SCHEMA = "doc_id long, text string, lang string, line string, score double"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(4)
    lengths = np.array([1, 4, 2, 6, 1])
    score, pairs = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    good, total, both = q.chain(score, lengths, pairs)
    at = 0
    for d, n in enumerate(lengths):
        own, weights = score[at:at + n], {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            weights[labels] = np.exp((own * labels).sum() + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(weights.values())
        assert np.isclose(np.log(z), total[d])
        for k in range(n):
            assert np.isclose(good[at + k], sum(w for y, w in weights.items() if y[k]) / z)
            for a, b in itertools.product((0, 1), repeat=2):
                expected = sum(w for y, w in weights.items() if y[k:k + 2] == (a, b)) / z
                assert np.isclose(both[at + k, a, b], expected)
        at += n


def _plain_counts(line):
    kinds = [q._CLASS[b] for b in line]
    words = [w for w in line.translate(bytes(32 if q._CLASS[b] == q._SPACE else b for b in range(256))).split(b" ") if w]
    return [kinds.count(k) for k in range(7)] + [len(words), sum(len(w) <= 3 for w in words), sum(a == b for a, b in zip(words, words[1:]))]


def test_counts_match_a_plain_count_in_pieces_too(monkeypatch):
    rng = random.Random(1)
    text = "\n".join("".join(rng.choice("aB1 .,!|$é\t aa bb") for _ in range(rng.randrange(60))) for _ in range(80)).encode()
    found = q.line_counts(text)
    assert found[:, [0, 1, 2, 3, 4, 5, 6, 8, 9, 10]].tolist() == [_plain_counts(x) for x in text.split(b"\n")]
    monkeypatch.setattr(q, "PIECE", 200)
    assert q.line_counts(text).tolist() == found.tolist()
    monkeypatch.setattr(q, "PIECE", 20)  # lines in pieces: bytes stay exact
    assert q.line_counts(text)[:, :7].tolist() == found[:, :7].tolist() and q.line_counts(b"").shape == (1, q.COUNTS)


def test_more_passes_raise_the_likelihood():
    rng = np.random.default_rng(0)
    bins = rng.integers(0, 9, (60, q.FEATURES)).astype(np.uint8)
    lengths, labels = np.full(20, 3), np.arange(20) % 2
    bins[np.repeat(labels, 3) == 1, 3] = 0

    def likelihood(m):
        score = m.weights[q.neighbourhood(bins, lengths)].sum(axis=1)
        line = np.repeat(labels, lengths)
        own = sum(score[k] * line[k] for k in range(60)) + sum(m.pairs[line[k], line[k + 1]] for k in range(59) if k % 3 != 2)
        return own - q.chain(score, lengths, m.pairs)[1].sum()

    fits = [likelihood(q.fit(bins, lengths, labels, np.ones(20), n)) for n in (0, 5, 60)]
    assert fits[0] < fits[1] < fits[2] < 0


def _docs(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        good = "\n".join(" ".join(rng.choices(["alma", "belo", "cara", "de", "en"], k=9)).capitalize() + "." for _ in range(4))
        bad = "\n".join(" | ".join(rng.choices(["Home", "Shop", "Cart"], k=5)) for _ in range(4))
        rows.append((k, bad if k % 3 == 0 else good, None, "x", 1.0))
    rows += [(900, None, None, "x", 1.0), (901, "", None, "x", 1.0), (902, "Alma belo. " * 30_000, None, "x", 1.0),
             (None, "Alma de en.", None, "x", 1.0), (5, rows[5][1], None, "x", 1.0), (902, "\n" * 3000, None, "x", 1.0)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_quality_is_learned_and_every_row_is_scored(spark):
    rows, docs = _docs(spark)
    labels = spark.createDataFrame([(k, 0 if k % 3 == 0 else 1) for k in range(200)] + [(None, 1), (7, None), (8, 1)],
                                   "doc_id long, quality int")
    model = q.learn(docs, labels)
    found = q.score(docs, model).collect()
    assert len(found) == len(rows) and found[0].asDict().keys() == {"doc_id", "text", "lang", "line", "score", "quality"}
    scores = {}
    for r in found:
        scores.setdefault(r["doc_id"], []).append(r["quality"]["score"])
    assert all((scores[k][0] >= q.THRESHOLD) == (k % 3 != 0) for k in range(200, 300))
    assert scores[5][0] == scores[5][1] and scores[900] == scores[901] and len(scores[None]) == 1
    again = {r["doc_id"]: r["quality"]["score"] for r in q.score(docs.filter("doc_id < 300"), q.learn(docs.repartition(7), labels)).collect()}
    assert all(again[k] == scores[k][0] for k in range(300))
    mixed = spark.createDataFrame([(1, rows[1][1] + "\n" + rows[0][1] * 3)], "doc_id long, text string")
    lines = [r["line"] for r in q.label_lines(mixed, model).collect()]
    assert lines[0]["good"] and not lines[-1]["good"] and [x["number"] for x in lines] == list(range(len(lines)))


def test_without_labels_or_documents(spark):
    _, docs = _docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(abs(r["quality"]["score"] - 0.5) < 1e-6 for r in q.score(docs, q.learn(docs, none)).collect())
    assert q.score(docs.limit(0), q.learn(docs.limit(0), none)).count() == 0
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert q.score(docs, q.learn(docs, one)).filter("quality.score < 0.5").count() == 0


def test_the_sample_is_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("A line.").alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 40 != 0).cast("int").alias("quality"))
    rows = q.sampled(docs, labels, sample=400).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()
    found = {r["label"]: (r["n"], r["w"]) for r in rows}
    assert found[0] == (100, 100) and 240 <= found[1][0] <= 360 and abs(found[1][1] - 3900) < 800


def test_held_out_figures(spark):
    sf = "/root/testdata/sf0.01"
    rows = q.op11_quality(spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.9
    pairs = [(a["score"] > b["score"]) for a in rows if a["quality"] for b in rows if not b["quality"]]
    assert sum(pairs) / len(pairs) > 0.95
