"""Blocks of documents and the exchange of their dictionaries.

A corpus-wide table keyed by words or byte contexts grows with the input, so it
cannot be broadcast, and joining every token of every document with it would
shuffle the corpus token by token. Instead documents are taken in *blocks* (the
consecutive documents of an input split, up to ``BLOCK_BYTES`` of text). A block
sends each of its distinct keys once; Spark brings equal keys of all blocks
together (a shuffle by key), the answer for a key is worked out once, and answers
travel back packed by block (a shuffle by block), where they meet the block's
documents, which arrive after them in the same sorted partition.

Blocks are numbered by split and by order within it, so the documents must come
from a table: reading it again yields the same splits. The receiving side checks
that every key it meets has an answer and fails otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import byte_list, lean

BLOCK_BYTES = 24 << 20
CHUNK_BYTES = 1 << 20
MAX_BLOCKS_PER_SPLIT = 1 << 20


def split_documents(docs: DataFrame, id_col: str, text_col: str, *extra) -> DataFrame:
    """(split, doc_id, text, extra columns) in table order."""
    return docs.select(F.spark_partition_id().alias("split"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"), *extra)


def iter_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, list[list]]]:
    """(block number, columns) where columns are the ids, the text bytes and
    any further columns of the block's documents."""
    held: list[list] = []
    size = seq = 0
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if split is None:
            split = batch.column(0)[0].as_py()
            held = [[] for _ in range(batch.num_columns - 1)]
        columns = [batch.column(1).to_pylist(), byte_list(batch.column(2)),
                   *[batch.column(i).to_pylist() for i in range(3, batch.num_columns)]]
        for row in zip(*columns):
            if size and size + len(row[1]) > block_bytes:
                yield split * MAX_BLOCKS_PER_SPLIT + seq, held
                held = [[] for _ in held]
                size, seq = 0, seq + 1
            for column, value in zip(held, row):
                column.append(value)
            size += len(row[1])
    if held and held[0]:
        yield split * MAX_BLOCKS_PER_SPLIT + seq, held


def iter_chunks(lengths: list[int]) -> Iterator[slice]:
    """Runs of documents of about ``CHUNK_BYTES`` (at least one each)."""
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > CHUNK_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield slice(start, len(lengths))


class Packer:
    """Zstandard blobs of numpy arrays."""

    def __init__(self):
        self._c = zstandard.ZstdCompressor(level=3)
        self._d = zstandard.ZstdDecompressor()

    def pack(self, *arrays: np.ndarray) -> bytes:
        head = np.array([len(arrays)] + [a.nbytes for a in arrays], np.int64).tobytes()
        return self._c.compress(head + b"".join(a.tobytes() for a in arrays))

    def unpack(self, blob: bytes, *types) -> list[np.ndarray]:
        raw = self._d.decompress(blob)
        sizes = np.frombuffer(raw, np.int64, len(types) + 1)[1:]
        out, at = [], 8 * (len(types) + 1)
        for n, t in zip(sizes, types):
            out.append(np.frombuffer(raw, t, int(n) // np.dtype(t).itemsize, at))
            at += int(n)
        return out


def planes(codes: np.ndarray) -> list[np.ndarray]:
    """The four bytes of 32-bit codes, apart: small codes leave the upper ones
    constant, which the compressor removes."""
    wide = codes.astype("<u4").view(np.uint8).reshape(-1, 4)
    return [np.ascontiguousarray(wide[:, k]) for k in range(4)]


def from_planes(parts: list[np.ndarray]) -> np.ndarray:
    return np.ascontiguousarray(np.stack(parts, axis=1)).view("<u4").reshape(-1)


def deliver(answers: DataFrame, chunks: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn`` over partitions in which each block's answers (``kind`` 0)
    come before its document chunks (``kind`` 1, by ``seq``)."""
    rows = answers.unionByName(chunks, allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", "kind", "seq").mapInArrow(lean(fn), schema)
