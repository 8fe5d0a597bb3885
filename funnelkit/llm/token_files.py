"""Operator 10: token ids in patched frame-of-reference (PFOR) block files.

File format (all integers little-endian), one file per range of doc_ids:

    "PFOR0001"  file number u32
    blocks      of BLOCK ids each, the last one shorter:
                minimum u32, ids u16, width u8, exceptions u16,
                packed (id - minimum) at ``width`` bits, low bits first,
                exception positions u16 each, exception differences u32 each
    footer      documents: doc_id i64, null flag u8, ids u64 each;
                block starts u64 each (bytes from the start of the file)
    trailer     documents u64, blocks u64, footer start u64, "PFOR0001"

The width of a block is that of its ``percentile``-th difference; larger ones
go to the exception list.  Records (header, runs of blocks, footer) are rows
written by Spark's own file writer, each followed by one 0x0A byte, so task
retries commit one copy and any store that Spark writes will do.

Scale: one range shuffle by (doc_id, text hash), files of about
``FILE_TEXT_BYTES`` of text, streamed batch by batch; reading back is one task
per file.  File totals (one row per file) give the global starts.

Defined results: null or empty text is the end id alone; null doc_ids sort
first; repeated doc_ids are written each, in hash order of their texts; an
empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import new_path, written
from .text import utf8
from .tokens import encode, shared_tokenizer

MAGIC = b"PFOR0001"
BLOCK = 1024
PERCENTILE = 0.9
END_ID = 1
FILE_TEXT_BYTES = 32 << 20
_BLOCK_HEAD = "<IHBH"
_HEAD_BYTES = struct.calcsize(_BLOCK_HEAD)
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("ids", "<u8")])


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """``ids`` (a whole number of BLOCKs, or one shorter block) as blocks."""
    size = min(BLOCK, len(ids))
    if not size:
        return []
    rows = ids.reshape(-1, size).astype(np.uint32)
    least = rows.min(axis=1)
    diff = rows - least[:, None]
    at = max(0, int(np.ceil(percentile * size)) - 1)
    width = np.array([int(x).bit_length() for x in np.partition(diff, at, axis=1)[:, at]], np.uint8)
    over = diff >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    packed: list[bytes] = [b""] * len(rows)
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        for part in np.array_split(which, -(-len(which) // 256)):
            kind = "<u2" if w <= 16 else "<u4"
            bits = np.unpackbits(diff[part].astype(kind).view(np.uint8).reshape(len(part), size, -1), axis=2,
                                 bitorder="little")[:, :, :w]
            for k, row in zip(part, np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little")):
                packed[k] = row.tobytes()
    out = []
    for k in range(len(rows)):
        odd = np.flatnonzero(over[k])
        out.append(struct.pack(_BLOCK_HEAD, int(least[k]), size, int(width[k]), len(odd)) + packed[k]
                   + odd.astype("<u2").tobytes() + diff[k, odd].astype("<u4").tobytes())
    return out


def unpack_blocks(data: memoryview, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``, in order."""
    heads = [struct.unpack_from(_BLOCK_HEAD, data, s) for s in starts]
    sizes = np.array([h[1] for h in heads], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(first[-1], np.uint32)
    groups: dict[tuple[int, int], list[int]] = {}
    for k, (_, size, width, _) in enumerate(heads):
        groups.setdefault((size, width), []).append(k)
    for (size, width), which in groups.items():
        n = (size * width + 7) // 8
        for at in range(0, len(which), 256):
            part = which[at:at + 256]
            raw = np.stack([np.frombuffer(data, np.uint8, n, starts[k] + _HEAD_BYTES) for k in part])
            bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :size * width].reshape(len(part), size, width)
            wide = 16 if width <= 16 else 32
            full = np.zeros((len(part), size, wide), np.uint8)
            full[:, :, :width] = bits
            value = np.packbits(full.reshape(len(part), -1), axis=1, bitorder="little").view(f"<u{wide // 8}")
            for k, row in zip(part, value.astype(np.uint32)):
                least, _, _, n_odd = heads[k]
                if n_odd:
                    pos = int(starts[k]) + _HEAD_BYTES + n
                    odd = np.frombuffer(data, "<u2", n_odd, pos)
                    row[odd] = np.frombuffer(data, "<u4", n_odd, pos + 2 * n_odd)
                out[first[k]:first[k + 1]] = row + np.uint32(least)
    return out


def _file_records(batches: Iterator[tuple[list, list[bytes]]], number: int) -> Iterator[bytes]:
    """The records of one file; ``batches``: doc_ids and their ids' bytes."""
    head = MAGIC + struct.pack("<I", number)
    yield head
    position, starts, docs, rest = len(head) + 1, [], [], np.empty(0, "<u4")
    for doc_ids, rows in batches:
        docs.append(np.array([(d or 0, d is None, len(r) // 4) for d, r in zip(doc_ids, rows)], _DOC))
        ids = np.concatenate([rest, np.frombuffer(b"".join(rows), "<u4")])
        whole = len(ids) // BLOCK * BLOCK
        rest = ids[whole:]
        blocks = pack_blocks(ids[:whole])
        for b in blocks:
            starts.append(position)
            position += len(b)
        if blocks:
            yield b"".join(blocks)
            position += 1
    for b in pack_blocks(rest):
        starts.append(position)
        yield b
        position += len(b) + 1
    index = np.concatenate(docs) if docs else np.empty(0, _DOC)
    yield (index.tobytes() + np.array(starts, "<u8").tobytes()
           + struct.pack("<QQQ", len(index), len(starts), position) + MAGIC)


def read_file(content: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """File number, document index and all ids of one file."""
    data = memoryview(content)
    if bytes(data[:8]) != MAGIC or bytes(data[-9:-1]) != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_blocks, footer = struct.unpack_from("<QQQ", data, len(data) - 33)
    index = np.frombuffer(data, _DOC, n_docs, footer)
    starts = np.frombuffer(data, "<u8", n_blocks, footer + n_docs * _DOC.itemsize).astype(np.int64)
    return struct.unpack_from("<I", data, 8)[0], index, unpack_blocks(data, starts)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, spaces: bool = False, end_id: int = END_ID,
                      file_text_bytes: int = FILE_TEXT_BYTES) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order."""
    shared = shared_tokenizer(docs.sparkSession, vocabulary, spaces)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    end = struct.pack("<I", end_id)

    def encoded(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [(t or b"").decode("utf-8", "replace") for t in utf8(part.column(1))]
                yield part.column(0).to_pylist(), [r.tobytes() + end for r in encode(shared.value, texts)]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        chained = (b for part in ([first], batches) for b in part)
        for record in _file_records(encoded(chained), TaskContext.get().partitionId()):
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(int(total // file_text_bytes) + 1, F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), F.octet_length("text")))
    ordered.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value")).write.text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: file, place (in the file), doc_id, ids before it in the
    file, number of ids, the ids (little-endian u32) and their crc32."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if not len(content.as_py()):
                    continue  # Spark writes one empty file for an empty table
                number, index, ids = read_file(content.as_py())
                n, data = index["ids"].astype(np.int64), ids.astype("<u4").tobytes()
                before = np.concatenate(([0], np.cumsum(n)))
                for at in range(0, len(index), 1024):
                    part = range(at, min(at + 1024, len(index)))
                    own = [data[4 * before[k]:4 * before[k + 1]] for k in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(own), pa.int32()), pa.array(part, pa.int64()),
                         pa.array([None if index["null"][k] else int(index["doc_id"][k]) for k in part], pa.int64()),
                         pa.array(before[at:part.stop], pa.int64()), pa.array(n[at:part.stop], pa.int64()),
                         pa.array(own, pa.binary()), pa.array([zlib.crc32(x) for x in own], pa.int64())],
                        ["file", "place", "doc_id", "file_start", "n_tokens", "ids", "ids_crc32"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        rows, "file int, place long, doc_id long, file_start long, n_tokens long, ids binary, ids_crc32 long")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, global start, n_tokens, ids_crc32."""
    docs = written(read_token_files(spark, path).drop("ids"), "token-index")
    totals = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    bases = written(totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "token-files")
    return docs.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")


def op10_token_files(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = new_path(spark, "token-files")
    write_token_files(docs, path, vocabulary or public_tokenizers.path("word_bpe_49k.json"))
    return token_index(spark, path)
