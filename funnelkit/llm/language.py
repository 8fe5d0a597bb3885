"""Operator 5: language identification by error-correcting output codes.

Each learned language has a codeword of bits.  One binary classifier per bit
(naive Bayes over hashed character bi- and trigrams: mean log ratio of the
languages whose bit is +1 against the others) predicts it from the text.
Decoding is loss-weighted: a language's loss is the sum over bits of its
weight for that bit times the logistic loss of the bit's margin, the weight
being how often the bit was right on labelled rows of that language.  The
nearest codeword wins; a text whose two nearest codewords are almost equally
far is flagged as ambiguous.

Up to six languages use the exhaustive code (every split of the languages),
more use the best of several seeded random codes.

Learning counts n-grams over every labelled training row (map-side sums, then
languages x FEATURES rows at most on the driver).  Only the bit weights come
from a bounded sample: about ``WEIGHT_ROWS`` training rows chosen by hash.

Defined results: null text or one without a letter is ``und`` with score 0;
so is every text if nothing could be learned; ties between codewords go to
the first language by name; repeated documents are predicted each; a null
doc_id counts as the empty string for the held-out rule; other columns pass.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import utf8

FEATURES = 1 << 14
WEIGHT_ROWS = 4096
SEED = 7
AMBIGUOUS = 0.6  # share of the best codeword below which a text is ambiguous
_CHUNK = 1 << 16
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
RESULT = "struct<lang:string,score:double,ambiguous:boolean>"


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Hashed bi- and trigrams of the letters of the whole text (runs of other
    characters count as one space), in chunks."""
    for at in range(0, len(text), _CHUNK):
        part = _OTHER.sub(" ", " " + text[max(0, at - 2):at + _CHUNK].lower() + " ")
        c = np.frombuffer(part.encode("utf-32-le", "replace"), "<u4")
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0x27D4EB2F) + c[2:] * np.uint32(0x165667B1)
        yield np.concatenate([two, three]) >> np.uint32(18)


def has_letter(text: str) -> bool:
    """Whether a character of a Unicode letter category occurs (numbers such as
    a half or a superscript are none)."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


def codewords(languages: int) -> np.ndarray:
    """A (languages, bits) matrix of -1 and +1 with distinct rows."""
    if languages <= 6:
        rows = [(1, *rest) for rest in itertools.product((-1, 1), repeat=max(0, languages - 1))
                if -1 in rest]
        return np.array(rows, np.int8).T.reshape(languages, -1)
    rng, best, apart = np.random.default_rng(SEED), None, -1
    for _ in range(32):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, 10 * int(np.ceil(np.log2(languages)))))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        near = (code.astype(np.int32) @ code.T.astype(np.int32)) - 2 * code.shape[1] * np.eye(languages, dtype=np.int32)
        if -near.max() > apart or best is None:
            best, apart = code, -near.max()
    return best


def margins(text: str, weights: np.ndarray) -> np.ndarray:
    """The classifiers' margins: sums of log ratios over the root of their
    number, bounded."""
    total, n = np.zeros(weights.shape[1]), 0
    for grams in ngrams(text):
        total += weights[grams].sum(axis=0)
        n += len(grams)
    return np.clip(total / max(n, 1) ** 0.5, -8, 8)


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, code: np.ndarray, trust: np.ndarray):
        self.languages, self.weights, self.code, self.trust = languages, weights, code, trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.languages or not has_letter(text):
            return "und", 0.0, True
        loss = (self.trust * np.log1p(np.exp(-self.code * margins(text, self.weights)))).sum(axis=1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(np.argmin(loss))
        return self.languages[best], float(share[best]), bool(share[best] < AMBIGUOUS)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def ngram_counts(rows: DataFrame) -> DataFrame:
    """(lang, feature, n) over all ``rows`` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                own = sums.setdefault(lang, np.zeros(FEATURES, np.int64))
                for grams in ngrams(text.decode("utf-8", "replace")):
                    own += np.bincount(grams, minlength=FEATURES)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())],
                ["lang", "feature", "n"])

    return (rows.select("lang", "text").mapInArrow(count, "lang string, feature int, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")))


def fit(train: DataFrame, weight_rows: int = WEIGHT_ROWS) -> Model:
    """Learn from ``train`` (doc_id, text, lang); rows without text or
    language teach nothing."""
    train = train.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    table = ngram_counts(train).toArrow()
    lang = table["lang"].to_pylist()
    languages = sorted(set(lang))
    if not languages:
        return Model([], np.zeros((FEATURES, 0)), np.zeros((0, 0)), np.zeros((0, 0)))
    place = {x: k for k, x in enumerate(languages)}
    counts = np.full((len(languages), FEATURES), 0.5)
    np.add.at(counts, ([place[x] for x in lang], table["feature"].to_numpy()), table["n"].to_numpy())
    share = counts / counts.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = np.stack([np.log(share[bit > 0].mean(axis=0) / share[bit < 0].mean(axis=0)) for bit in code.T],
                       axis=1) if code.shape[1] else np.zeros((FEATURES, 0))
    model = Model(languages, weights.astype(np.float32), code, np.ones(code.shape))
    model.trust = bit_trust(train, model, weight_rows)
    return model


def bit_trust(train: DataFrame, model: Model, weight_rows: int) -> np.ndarray:
    """How often each bit was right for each language on the sampled rows
    (one pseudo-count), scaled to a mean of 1 per language."""
    languages, code = model.languages, model.code
    every = max(1, train.count() // weight_rows)
    sample = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    weights = model.weights

    @F.arrow_udf("array<double>")
    def right(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        place = {x: k for k, x in enumerate(languages)}
        for lang, text in batches:
            rows = [(np.sign(margins(t.decode("utf-8", "replace"), weights)) == code[place[x]]).astype(float).tolist()
                    for x, t in zip(lang.to_pylist(), utf8(text))]
            yield pa.array(rows, pa.list_(pa.float64()))

    marked = sample.select("lang", right.asNondeterministic()("lang", "text").alias("right"))
    bits = [F.sum(F.col("right")[j]).alias(f"b{j}") for j in range(code.shape[1])]
    trust = np.ones(code.shape)
    for row in marked.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *bits).collect():
        k = languages.index(row["lang"])
        trust[k] = [(row[f"b{j}"] + 1) / (row["n"] + 1) for j in range(code.shape[1])]
    return trust / np.maximum(trust.mean(axis=1, keepdims=True), 1e-9) if code.shape[1] else trust


def predict(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into`` (lang, score, ambiguous)."""

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = [model.predict(None if t is None else t.decode("utf-8", "replace")) for t in utf8(column)]
            lang, score, odd = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(odd, pa.bool_())],
                names=["lang", "score", "ambiguous"])

    return docs.withColumn(into, run.asNondeterministic()(F.col(text)))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is identified beyond doubt, with their
    own columns; the model learns from the rows that are not held out."""
    model = fit(docs.filter(~held_out()))
    known = predict(docs, model, into="__language")
    return known.filter((F.col("__language.lang") != "und") & ~F.col("__language.ambiguous")).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predict(docs, fit(docs.filter(~held_out()))).select(
        "doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.ambiguous").alias("ambiguous"))
