"""Quality rules by compression bands.

Each text is compressed with zstandard as a whole and in fixed chunks. Natural
prose compresses by a ratio that grows slowly with its length; repeated
boilerplate compresses far better and random strings hardly at all. A document
is rejected when its whole-text ratio leaves the band for its length, or when
too many of its chunks leave the chunk band (a clean document with a long
repetitive or random stretch).

Null and empty texts have no words and fail the base rule; a row whose id is
null or repeated is judged like any other row. The pass is per document, so
copies, sources and text lengths need no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import WordHashes, byte_list, map_batches, window_hashes

# Fixed values of the contract's base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5


@dataclass(frozen=True)
class Bands:
    """Limits of bytes / compressed bytes. ``whole``: (length below which the
    band holds, least ratio, largest ratio), by rising length. Short texts pay
    the frame header, so their least ratio is low. ``bad_chunk_pct``: (length
    below which it holds, percent of chunks outside ``chunk_limits`` from which a
    text is rejected); ``bad_run``: so many of them in a row reject a text of any
    length."""
    whole: tuple[tuple[float, float, float], ...] = (
        (64, 0.60, 1.8), (128, 0.75, 2.0), (256, 0.95, 2.4), (512, 1.10, 2.6), (1024, 1.20, 2.9),
        (2048, 1.25, 3.2), (4096, 1.30, 3.5), (16384, 1.35, 3.8), (65536, 1.40, 4.2),
        (float("inf"), 1.40, 4.6))
    chunk_bytes: int = 4096
    chunk_limits: tuple[float, float] = (1.25, 4.0)
    bad_chunk_pct: tuple[tuple[float, int], ...] = ((65536, 25), (262144, 15), (float("inf"), 8))
    bad_run: int = 3
    level: int = 3


DEFAULT_BANDS = Bands()
FEATURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, base_failed boolean, ratio double, n_chunks bigint, "
            "n_bad_chunks bigint, verdict string, kept boolean")


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(hashes)
    if n <= width:
        return 0
    windows = window_hashes(hashes, width)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(windows, twice)
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(edges[:n])))


def base_features(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple:
    chars = len(text.decode("utf-8", "replace"))
    spaces = len(text) - sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = repeated_words(hashes)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * len(words)
    return (len(words), chars - spaces, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeats, failed)


def band_verdict(text: bytes, compressor: zstandard.ZstdCompressor, bands: Bands) -> tuple:
    """(ratio, chunks, chunks outside their limits, verdict)."""
    if not text:
        return None, 0, 0, "empty"
    ratio = len(text) / len(compressor.compress(text))
    low, high = next((lo, hi) for below, lo, hi in bands.whole if len(text) < below)
    size, least, most = bands.chunk_bytes, *bands.chunk_limits
    n_chunks = bad = run = longest = 0
    if len(text) > size:
        # The last chunk ends with the text and overlaps the one before it.
        for at in [*range(0, len(text) - size, size), len(text) - size]:
            n_chunks += 1
            if least <= size / len(compressor.compress(text[at:at + size])) <= most:
                run = 0
            else:
                bad, run = bad + 1, run + 1
                longest = max(longest, run)
    if ratio > high:
        verdict = "repetitive"
    elif ratio < low:
        verdict = "incompressible"
    elif longest >= bands.bad_run or bad and 100 * bad >= next(
            pct for below, pct in bands.bad_chunk_pct if len(text) < below) * n_chunks:
        verdict = "bad chunks"
    else:
        verdict = "ok"
    return ratio, n_chunks, bad, verdict


def compression_bands(docs: DataFrame, text_col: str = "text", bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """Every column of ``docs`` (a column named like a feature is replaced)
    with the base features, the ratios, the verdict and ``kept``."""
    names = [f.split()[0] for f in FEATURES.split(", ")]
    source = docs.drop(*[c for c in names if c != text_col])
    if text_col in names:
        raise ValueError(f"the text column cannot be named {text_col}")
    carried = source.schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in carried] + [FEATURES])
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    cache: list = []

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not cache:
            cache.extend([WordHashes(), zstandard.ZstdCompressor(level=bands.level)])
        hashes, compressor = cache
        rows = []
        for text in byte_list(batch.column(batch.schema.get_field_index(text_col))):
            words = text.split()
            base = base_features(text, words, hashes.of(words))
            ratio, n_chunks, bad, verdict = band_verdict(text, compressor, bands)
            rows.append((*base, ratio, n_chunks, bad, verdict, not base[-1] and verdict == "ok"))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return map_batches(source, fn, schema)


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    judged = compression_bands(docs.withColumn("_text", docs[text_col]).select("_text", F.struct(*docs.columns).alias("_row")),
                               "_text")
    return judged.where("kept").select("_row.*")


def op2_query(docs: DataFrame) -> DataFrame:
    return compression_bands(docs.select("doc_id", "text")).drop("text")
