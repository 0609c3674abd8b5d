"""Helpers shared by the operators of this package.

Text reaches Python tasks as Arrow batches (Spark bounds a batch by rows and by
``spark.sql.execution.arrow.maxBytesPerBatch``), and every helper here works on
one document or one batch at a time, so a task's memory does not grow with its
partition.
"""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import checkpoint_dir

# Fixed value: the contract's word pattern, as Java and DuckDB read it.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def shared_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                 compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared folder and read it
    back: a cut in the lineage that survives lost executors and, unlike
    ``checkpoint()``, is columnar and compressed."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/vigil-{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)       # an empty table has no files to infer it from


def release_memory() -> None:
    """Give memory that is no longer used back to the system. Spark reuses its
    Python workers, which otherwise keep what their largest task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, with the memory of its task released at its end."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()
    return task


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
                schema: str) -> DataFrame:
    """``mapInArrow`` for a stateless batch function."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from (out if isinstance(out, Iterator) else [out])
    return df.mapInArrow(lean(run), schema)


def byte_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def text_list(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


class WordHashes(dict):
    """word -> 64-bit hash, remembered for the frequent words of a task; the
    memory is bounded by dropping the table when it is full."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)      # odd: a bijection modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all windows of ``width`` words; fewer words are one
    window of their own length (hashed apart from full windows)."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    span = min(n, width)
    with np.errstate(over="ignore"):
        acc = np.full(n - span + 1, span, np.uint64)
        for k in range(span):
            acc = acc * _MULTIPLIER + word_hashes[k:n - span + 1 + k]
            acc = acc ^ (acc >> np.uint64(29))
        return mix(acc)


def hash_bucket(columns: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def group_offsets(df: DataFrame, by: list[str], bucket: str, sums: dict[str, Column]) -> DataFrame:
    """Exclusive running sums of ``sums`` over ``bucket`` within each ``by``
    group: one row per (group, bucket), so the window sorts a pre-aggregated
    table whose groups hold at most one row per bucket."""
    from pyspark.sql import Window

    totals = df.groupBy(*by, bucket).agg(*[F.sum(e).alias(f"_sum_{k}") for k, e in sums.items()])
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*by, bucket, *[
        F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(k) for k in sums])
