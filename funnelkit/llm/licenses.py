"""Operator 1: license scan as an exact set-similarity (containment) join.

Left side: blocks of ``BLOCK_WORDS`` words of a document, one every
``STRIDE_WORDS`` words, as sets.  Right side: templates, as sets, each with a
containment threshold in percent.  A pair joins if the block holds at least
``need = ceil(threshold * |T|)`` of the template's words.

Tokens are ordered by their count over the whole corpus, rarest first.  Words
outside every template cannot match, so they are left out of both sides.
Filters, all exact: a block is probed only through the template's prefix, its
``|T| - need + 1`` rarest tokens (prefix); it must hold ``need`` template
tokens of any kind (length); and from the places of the first shared token in
both sorted sets enough tokens must remain on both sides (positional).  What
passes is verified on the full sets.

Base phrases are templates with a threshold of 100; inside a joined block
their consecutive occurrences are then located.  A span of up to
``STRIDE_WORDS + 1`` words lies whole in some block, so none is missed.

Scale: two scans of the documents, the first only to count the (fixed,
bounded) template vocabulary with map-side sums; the templates are a constant
of this module, the only thing sent to the tasks.  No shuffle of texts.

Defined results: null or empty text has no words, no places, empty labels,
score 0; repeated documents are each scanned; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import TERM_WORDS_SQL, term_words, utf8

STRIDE_WORDS = 32
BLOCK_WORDS = 2 * STRIDE_WORDS
THRESHOLD = 80

# The base phrases and their labels.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Sentences of public licence notices and their labels, in the
# notices' order, none longer than a block's stride.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify "
            "merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited "
            "to the warranties of merchantability"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability "
            "whether in an action of contract tort or otherwise"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is "
                 "distributed on an as is basis"),
    ("apache-2", "see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials"),
    ("bsd", "names of its contributors may be used to endorse or promote products derived from this software without "
            "specific prior written permission"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied "
            "warranties are disclaimed"),
    ("bsd", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental "
            "special exemplary or consequential damages"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "as published by the free software foundation either version 3 of the license or at your option any later "
            "version"),
    ("gpl", "without any warranty without even the implied warranty of merchantability or fitness for a particular "
            "purpose see the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("isc", "the author disclaims all warranties with regard to this software including all implied warranties of "
            "merchantability and fitness"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
)

RESULT = ("struct<n_words:bigint,places:array<struct<label:string,start:int>>,labels:array<string>,score:double>")
_PLACE = pa.struct([("label", pa.string()), ("start", pa.int32())])
_ARROW = [pa.field("n_words", pa.int64()), pa.field("places", pa.list_(_PLACE)),
          pa.field("labels", pa.list_(pa.string())), pa.field("score", pa.float64())]


def templates() -> list[tuple[str, list[bytes], int]]:
    """(label, words in order, threshold in percent)."""
    return ([(label, text.encode().split(), 100) for label, text in BASE_PHRASES]
            + [(label, text.encode().split(), THRESHOLD) for label, text in NOTICES])


def token_counts(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """How often each word of ``vocabulary`` occurs in all of ``docs``; one
    partial row per word and task, at most ``len(vocabulary)`` rows returned."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for row in utf8(batch.column(0)):
                counts.update(filter(vocabulary.__contains__, term_words(row)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "token binary, n long")
    return {bytes(r[0]): r[1] for r in rows.groupBy("token").agg(F.sum("n")).collect()}


def join_index(counts: dict[bytes, int], sets: list[tuple[str, list[bytes], int]]):
    """Token ranks (rarest first), per template (label, words, sorted ranks,
    need) and prefix token -> [(template, place in its sorted ranks)]."""
    vocabulary = {w for _, words, _ in sets for w in words}
    rank = {w: r for r, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    plans, prefix = [], defaultdict(list)
    for t, (label, words, threshold) in enumerate(sets):
        ranks = sorted({rank[w] for w in words})
        need = -(-threshold * len(ranks) // 100)
        plans.append((label, words, ranks, need))
        for place, r in enumerate(ranks[:len(ranks) - need + 1]):
            prefix[r].append((t, place))
    return rank, plans, dict(prefix)


def joined_templates(block: list[int], plans, prefix) -> list[tuple[int, int]]:
    """(template, overlap) of every template that the block (sorted distinct
    ranks) contains up to its threshold."""
    found, tried, own = [], set(), set(block)
    for j, r in enumerate(block):
        for t, i in prefix.get(r, ()):
            if t in tried:
                continue
            tried.add(t)  # (i, j) is the first shared token: later ones cannot do better
            _, _, ranks, need = plans[t]
            if len(block) < need or 1 + min(len(ranks) - i, len(block) - j) - 1 < need:
                continue
            overlap = len(own.intersection(ranks))
            if overlap >= need:
                found.append((t, overlap))
    return found


def scan_words(words: list[bytes], rank, plans, prefix) -> tuple[set, set, float]:
    """Base places (label, start), labels and score of one document."""
    hits = [(at, rank[w]) for at, w in enumerate(words) if w in rank]
    blocks: dict[int, set[int]] = defaultdict(set)
    for at, r in hits:
        k = at // STRIDE_WORDS
        blocks[k].add(r)
        if k:
            blocks[k - 1].add(r)
    places, labels, score = set(), set(), 0.0
    for k, ranks in blocks.items():
        if prefix.keys().isdisjoint(ranks):
            continue
        for t, overlap in joined_templates(sorted(ranks), plans, prefix):
            label, phrase, own, need = plans[t]
            if need < len(own) or t >= len(BASE_PHRASES):
                labels.add(label)
                score = max(score, overlap / len(own))
                continue
            first, n = k * STRIDE_WORDS, len(phrase)
            for at in range(first, min(first + BLOCK_WORDS, len(words)) - n + 1):
                if words[at:at + n] == phrase:
                    places.add((label, at))
                    score = 1.0
    return places, labels, score


def scan_licenses(docs: DataFrame, text: str = "text", into: str = "license") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, the base phrases'
    places, all labels and the highest containment found."""
    sets = templates()
    counts = token_counts(docs, {w for _, words, _ in sets for w in words}, text)
    rank, plans, prefix = join_index(counts, sets)

    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            n, where, what, scores = [], [], [], []
            for row in utf8(column):
                words = term_words(row)
                places, labels, score = scan_words(words, rank, plans, prefix)
                n.append(len(words))
                where.append([{"label": a, "start": b} for a, b in sorted(places, key=lambda p: (p[1], p[0]))])
                what.append(sorted(labels | {a for a, _ in places}))
                scores.append(score)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(where, pa.list_(_PLACE)),
                 pa.array(what, pa.list_(pa.string())), pa.array(scores, pa.float64())], fields=_ARROW)

    return docs.withColumn(into, scan.asNondeterministic()(F.col(text)))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    starts = F.transform("license.places", lambda p: p["start"].cast("long"))
    return scan_licenses(docs).select(
        "doc_id", F.col("license.n_words").alias("n_words"),
        F.size("license.places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("license.places", lambda p: p["label"]))), ",")
        .alias("base_labels"),
        F.array_join("license.labels", ",").alias("labels"), F.col("license.score").alias("score"))


def _values(rows) -> str:
    return ", ".join("('{}', [{}], {})".format(label, ", ".join(f"'{w.decode()}'" for w in words), threshold)
                     for label, words, threshold in rows)


OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERM_WORDS_SQL} AS w FROM documents),
base(label, phrase, t) AS (VALUES {_values(templates()[:len(BASE_PHRASES)])}),
notice(label, words, t) AS (VALUES {_values(templates()[len(BASE_PHRASES):])}),
places AS (SELECT r, label, p - 1 AS start
           FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p FROM d), base WHERE w[p:p + len(phrase) - 1] = phrase),
blocks AS (SELECT r, list_distinct(w[{STRIDE_WORDS} * k + 1:{STRIDE_WORDS} * k + {BLOCK_WORDS}]) AS b
           FROM (SELECT r, w, unnest(range(0, (len(w) - 1) // {STRIDE_WORDS} + 1)) AS k FROM d WHERE len(w) > 0)),
joined AS (SELECT r, label, len(list_intersect(b, list_distinct(words))) / len(list_distinct(words)) AS score
           FROM blocks, notice
           WHERE 100 * len(list_intersect(b, list_distinct(words))) >= t * len(list_distinct(words))),
found AS (SELECT r, label, 1.0::DOUBLE AS score, start FROM places
          UNION ALL SELECT r, label, score::DOUBLE, NULL FROM joined),
per AS (SELECT r, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (start IS NOT NULL) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
        FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per USING (r)
"""
