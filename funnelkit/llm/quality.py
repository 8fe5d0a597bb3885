"""Operator 11: document quality from a linear-chain conditional random field.

The lines of a text are a chain of labels, good or bad.  Each line is described
by binned counts (bytes by class, words, short words, words repeated one after
the other), and its score by weights over its own bins and those of the line
before and after it; a 2 x 2 table scores neighbouring labels.  The forward and
backward sums give each line's probability of being good; their mean, weighted
by line length, is the document's quality.

Learning: the lines of a labelled document carry its label; the regularised log
likelihood is raised by a fixed number of full passes.  The documents to learn
from are a bounded sample, chosen by a hash of the id: about ``SAMPLE`` in all,
half of them from each label where there are as many, of at most ``SAMPLE_LINES``
lines, weighted back to the label's share.  So at most SAMPLE x SAMPLE_LINES
rows of bins (14 bytes each) reach the driver.  Everything else reads every text
whole, in one scan without a shuffle.

Lines end at ``\\n``.  A line longer than ``PIECE`` bytes is counted in pieces
of that size (words are not compared across two pieces).

Defined results: a null text is an empty one, a single empty line; without any
usable label every score is 0.5 (up to rounding); a label's id that is null or repeats counts
once at most (the mean of its labels, 1 from 0.5 on); of rows that repeat a
sampled id one is learned from; every document row is scored; other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .language import held_out
from .text import utf8

SAMPLE, SAMPLE_LINES = 8192, 512
PASSES, RATE, PENALTY = 120, 0.25, 1e-4
PIECE = 1 << 22
THRESHOLD = 0.3
RESULT = "struct<score:double,lines:bigint,bad:bigint>"
_BUCKETS = 1 << 20

# Classes of bytes; those from 0x80 on are letters.
_LOWER, _UPPER, _DIGIT, _SPACE, _SENTENCE, _MARK, _SYMBOL, _BREAK = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
for _kind, _bytes in ((_LOWER, b"abcdefghijklmnopqrstuvwxyz"), (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                      (_DIGIT, b"0123456789"), (_SPACE, b" \t\x0b\x0c\r"), (_SENTENCE, b".,;:?'\"()-"), (_MARK, b"!"),
                      (_BREAK, b"\n"), (_LOWER, bytes(range(128, 256)))):
    _CLASS[list(_bytes)] = _kind
_VALUE = np.random.default_rng(11).integers(1, 1 << 32, 256, dtype=np.uint32)
#: counts of a line: bytes by class, then words, short words, repeated words
COUNTS = 11
BINS, EDGE = 17, 16  # the last bin: there is no such neighbour
FEATURES = 10


# -- lines -----------------------------------------------------------------------


def _counted(piece: bytes) -> np.ndarray:
    """Counts of each line of ``piece`` (lines, COUNTS)."""
    data = np.frombuffer(piece, np.uint8)
    kind = _CLASS[data]
    ends = kind == _BREAK
    line = np.cumsum(ends, dtype=np.int64)
    lines = int(ends.sum()) + 1
    out = np.zeros((lines, COUNTS), np.int64)
    out[:, :8] = np.bincount(line * 8 + kind, minlength=lines * 8).reshape(-1, 8)
    out[:, _BREAK] = 0
    inside = (kind != _SPACE) & ~ends
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(first):
        length, home = last - first, line[first]
        out[:, 8] = np.bincount(home, minlength=lines)
        out[:, 9] = np.bincount(home[length <= 3], minlength=lines)
        at = np.arange(len(data), dtype=np.uint32) + np.uint32(1)
        at[first[0]:] -= np.repeat(first, np.diff(np.concatenate([first, [len(data)]]))).astype(np.uint32)
        value = np.add.reduceat(np.where(inside, _VALUE[data] * at, np.uint32(0)), first)
        again = (value[1:] == value[:-1]) & (length[1:] == length[:-1]) & (home[1:] == home[:-1])
        out[:, 10] = np.bincount(home[1:][again], minlength=lines)
    return out


def line_counts(text: bytes) -> np.ndarray:
    """Counts of every line of ``text``, in pieces of at most PIECE bytes."""
    at, parts, goes_on = 0, [], False
    while True:
        cut, more = len(text), False
        if cut - at > PIECE:
            cut = text.rfind(b"\n", at, at + PIECE)
            more = cut < 0
            cut = at + PIECE if more else cut
        part = _counted(text[at:cut])
        if goes_on:
            parts[-1][-1] += part[0]
            part = part[1:]
        if len(part):
            parts.append(part)
        goes_on = more
        if cut == len(text):
            return np.concatenate(parts)
        at = cut + (not more)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bins 0 to 8 of a share, finer near 0; 0 is a bin of its own."""
    share = np.minimum(part / np.maximum(whole, 1), 1.0)
    return np.where(part > 0, 1 + np.floor(7 * np.sqrt(share)), 0)


def line_bins(counts: np.ndarray) -> np.ndarray:
    """The bins of each line (lines, FEATURES)."""
    size = counts[:, :7].sum(axis=1)
    letters = counts[:, _LOWER] + counts[:, _UPPER]
    words = counts[:, 8]
    return np.stack([
        np.minimum(np.log2(size + 1), 15), _share(counts[:, _UPPER], letters), _share(counts[:, _DIGIT], size),
        _share(counts[:, _SYMBOL], size), _share(counts[:, _MARK], words), _share(counts[:, _SENTENCE], words),
        _share(counts[:, 10], words), np.minimum(size / np.maximum(words, 1), 15), _share(counts[:, 9], words),
        np.minimum(np.log2(words + 1), 15)], axis=1).astype(np.uint8)


def neighbourhood(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Weight indexes of each line (lines, 3 * FEATURES): its own bins, those of
    the line before and those of the line after in its document."""
    before, after = np.full_like(bins, EDGE), np.full_like(bins, EDGE)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    ends = np.cumsum(lengths)
    before[ends - lengths], after[ends - 1] = EDGE, EDGE
    near = np.concatenate([bins, before, after], axis=1)
    return near.astype(np.int32) + np.arange(near.shape[1], dtype=np.int32) * BINS


# -- the chain ---------------------------------------------------------------------


def _sweep(score: np.ndarray, lengths: np.ndarray, pairs: np.ndarray, back: bool) -> np.ndarray:
    """Log sums over the labels before each line (after it, if ``back``), for
    both labels of the line; its own score is included going forward only."""
    ends = np.cumsum(lengths)
    order = np.argsort(-lengths, kind="stable")
    by_length, edge = lengths[order], (ends - 1 if back else ends - lengths)[order]
    step = -1 if back else 1
    sums = np.zeros((len(score), 2))
    if not back:
        sums[edge, 1] = score[edge]
    for t in range(1, int(by_length[0]) if len(lengths) else 0):
        at = edge[:np.searchsorted(-by_length, -t, side="left")] + step * t
        prior = sums[at - step]
        if back:
            prior = prior + np.stack([np.zeros(len(at)), score[at - step]], 1)
        table = pairs.T if back else pairs
        for label in (0, 1):
            sums[at, label] = np.logaddexp(prior[:, 0] + table[0, label], prior[:, 1] + table[1, label])
        if not back:
            sums[at, 1] += score[at]
    return sums


def chain(score: np.ndarray, lengths: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of ``lengths`` lines with ``score`` for a good label and
    ``pairs`` for (label, next label): each line's probability of being good,
    each document's log sum over all labellings, and each line's probabilities
    (lines, 2, 2) of its label and the next one (0 at a document's last line)."""
    forward, backward = _sweep(score, lengths, pairs, False), _sweep(score, lengths, pairs, True)
    ends = np.cumsum(lengths)
    total = np.logaddexp(forward[ends - 1, 0], forward[ends - 1, 1])
    each = np.repeat(total, lengths)
    good = np.exp(forward[:, 1] + backward[:, 1] - each)
    both = np.zeros((len(score), 2, 2))
    for b in (0, 1):
        onward = backward[1:, b] + (score[1:] if b else 0) - each[:-1]
        for a in (0, 1):
            both[:-1, a, b] = np.exp(np.minimum(forward[:-1, a] + pairs[a, b] + onward, 0))
    both[ends - 1] = 0
    return np.clip(good, 0, 1), total, both


class Model:
    """Weights of the bins and of the label pairs."""

    def __init__(self, weights: np.ndarray, pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs

    def good(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The probability of being good of every line."""
        if not len(counts):
            return np.zeros(0)
        score = self.weights[neighbourhood(line_bins(counts), lengths)].sum(axis=1)
        return chain(score, lengths, self.pairs)[0]


def fit(bins: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weight: np.ndarray,
        passes: int = PASSES) -> Model:
    """The model of documents with ``bins`` of all their lines, a label (0 or 1)
    and a weight each."""
    weights, pairs = np.zeros(3 * FEATURES * BINS), np.zeros((2, 2))
    if not len(lengths):
        return Model(weights, pairs)
    near, line_label = neighbourhood(bins, lengths), np.repeat(labels, lengths)
    # every document counts alike, whatever its number of lines
    line_weight = np.repeat(weight / weight.sum() / lengths, lengths)
    seen = np.bincount(near.ravel(), np.repeat(line_weight * line_label, near.shape[1]), len(weights))
    inner = np.ones(len(bins), bool)
    inner[np.cumsum(lengths) - 1] = False
    kept = np.array([[(line_weight * inner * (line_label == a) * (a == b)).sum() for b in (0, 1)] for a in (0, 1)])
    theta, wanted = np.zeros(len(weights) + 4), np.concatenate([seen, kept.ravel()])
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, passes + 1):
        good, _, both = chain(theta[:-4][near].sum(axis=1), lengths, theta[-4:].reshape(2, 2))
        found = np.concatenate([np.bincount(near.ravel(), np.repeat(line_weight * good, near.shape[1]), len(weights)),
                                (line_weight[:, None, None] * both).sum(axis=0).ravel()])
        slope = wanted - found - PENALTY * theta
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope * slope
        theta += RATE / (1 + 4 * t / passes) * (mean / (1 - 0.9 ** t)) / (np.sqrt(spread / (1 - 0.99 ** t)) + 1e-6)
    return Model(theta[:-4], theta[-4:].reshape(2, 2))


# -- on Spark ------------------------------------------------------------------------


@F.arrow_udf(BinaryType())
def _bins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        yield pa.array([line_bins(line_counts(t or b"")).tobytes() for t in utf8(column)], pa.binary())


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> DataFrame:
    """(label, weight, bins of the lines) of the documents to learn from."""
    each = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("__label"))
    counts = {r["__label"]: r["count"] for r in each.groupBy("__label").count().collect()}
    # a label gets half of the sample, or what the other leaves of it
    share = {k: min(1.0, max(sample / 2, sample - counts.get(1 - k, 0)) / n) for k, n in counts.items()}
    if not share:
        return docs.select(F.lit(0).alias("label"), F.lit(1.0).alias("weight"), F.lit(b"").alias("bins")).limit(0)
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v)]), F.col("__label"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_BUCKETS)) / _BUCKETS
    chosen = each.filter(place < rate).select("doc_id", "__label", (1 / rate).alias("__weight"))
    short = docs.select("doc_id", "text").filter(
        F.length(F.coalesce("text", F.lit(""))) - F.length(F.translate(F.coalesce("text", F.lit("")), "\n", "")) < sample_lines)
    # about ``sample`` rows, by the rate above
    met = short.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "__label", "__weight", _bins("text").alias("__bins"))
    return met.groupBy("doc_id").agg(F.first("__label").alias("label"), F.first("__weight").alias("weight"),
                                     F.min("__bins").alias("bins")).select("label", "weight", "bins")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> Model:
    """The model learned from ``docs`` (doc_id, text) that ``labels`` (doc_id,
    quality 0 or 1) marks."""
    rows = sampled(docs, labels, sample, sample_lines).toArrow()
    bins = [np.frombuffer(b, np.uint8).reshape(-1, FEATURES) for b in rows["bins"].to_pylist()]
    order = sorted(range(len(bins)), key=lambda k: bins[k].tobytes())  # the same sums whatever the order of the rows
    return fit(np.concatenate([bins[k] for k in order]) if bins else np.zeros((0, FEATURES), np.uint8),
               np.array([len(bins[k]) for k in order], np.int64), rows["label"].to_numpy()[order].astype(np.int64) if bins else np.zeros(0, np.int64),
               rows["weight"].to_numpy()[order].astype(float) if bins else np.zeros(0))


def _scored(texts: list[bytes | None], model: Model) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(probabilities, weights) of the lines of each text, some texts at a time."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi] or b"") < PIECE):
            size, hi = size + len(texts[hi] or b"") + 1, hi + 1
        counts = line_counts(b"\n".join(t or b"" for t in texts[lo:hi]))
        lengths = np.array([(t or b"").count(b"\n") + 1 for t in texts[lo:hi]], np.int64)
        good, weight = model.good(counts, lengths), counts[:, :7].sum(axis=1) + 1
        cuts = np.cumsum(lengths)[:-1]
        yield from zip(np.split(good, cuts), np.split(weight, cuts))
        lo = hi


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into``: the score, the number of lines
    and how many of them are more likely bad."""

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = [(float(good @ weight / weight.sum()), len(good), int((good < 0.5).sum()))
                    for good, weight in _scored(utf8(column), model)]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(
                zip(*rows) if rows else ((), (), ()), (pa.float64(), pa.int64(), pa.int64()))], ["score", "lines", "bad"])

    return docs.withColumn(into, run.asNondeterministic()(F.col(f"`{text}`")))


def label_lines(docs: DataFrame, model: Model, text: str = "text", into: str = "line") -> DataFrame:
    """``docs`` with a row per line and a struct column ``into``: the line's
    number, its probability of being good, and whether that is 0.5 or more."""

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([good.tolist() for good, _ in _scored(utf8(column), model)], pa.list_(pa.float64()))

    found = docs.select("*", F.posexplode(run.asNondeterministic()(F.col(f"`{text}`"))).alias("__at", "__good"))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        F.col("__at").alias("number"), F.col("__good").alias("probability"), (F.col("__good") >= 0.5).alias("good")).alias(into))


def predicted(score: Column, threshold: float = THRESHOLD) -> Column:
    return F.when(score >= threshold, 1).otherwise(0)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").filter(~held_out())
    rows = score(docs, learn(docs, labels))
    return rows.select("doc_id", held_out().alias("held_out"), F.col("quality.score").alias("score"),
                       predicted(F.col("quality.score")).alias("predicted"),
                       F.col("quality.lines").alias("n_lines"), F.col("quality.bad").alias("n_bad_lines"))
