"""Periodic run detection by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period ``q`` whose length
is at least ``Law.repeats * q`` and ``Law.words``, and which no neighbouring
word extends.

1. *Splitting.* Every word of a run occurs in it at least ``repeats`` times, so a
   word that occurs less often in the current segment cannot be part of a run
   inside that segment. Such words split the segment; the pieces are counted
   again on their own, until nothing changes or a piece is shorter than a run.
   Ordinary prose falls apart within a few rounds.
2. *Lag scan.* In a surviving segment words ``q`` apart are compared; a stretch
   of equal pairs is a run of period ``q``. Lags below ``DIRECT`` are all
   scanned. Longer lags, taken in octaves ``[2Q, 4Q)``, are scanned only where a
   run can be: it holds three consecutive grid windows of ``Q`` words that stand
   again ``q`` words later (its length is ``3q`` at least), and equal windows
   have equal hashes. Pairs of windows that lie in a run already found with a
   period up to ``Q`` say nothing new and are left out, so a text that repeats
   one word does not make every lag a candidate. The comparison at a lag is of
   the words themselves, never of hashes.

A stretch found under a multiple of its smallest period is the same stretch, so
of equal stretches the one with the smallest lag stays. The work on a document
is O(n log n) and O(n) for each lag that is scanned.

Documents are independent: one narrow map, no shuffle. Null and empty texts
have no words and no runs and collapse to an empty text; a null id stays null;
repeated rows give repeated results; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.blocks import iter_chunks
from vigil.llm.common import byte_list, mix

DIRECT = 32                       # lags below are scanned without a search
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Law:
    """A run has at least ``words`` words and ``repeats`` (3 or more) periods."""
    words: int = 24
    repeats: int = 3


LAW = Law()                       # fixed values of the contract
Run = tuple[int, int, int]        # start, length, period


def word_codes(words: list[bytes]) -> np.ndarray:
    index: dict[bytes, int] = {}
    return np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words))


def _stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def split_segments(codes: np.ndarray, law: Law = LAW) -> list[tuple[int, int]]:
    """The segments that survive the splitting, in order."""
    done, waiting = [], [(0, len(codes))]
    while waiting:
        start, end = waiting.pop()
        if end - start < law.words:
            continue
        _, local, counts = np.unique(codes[start:end], return_inverse=True, return_counts=True)
        often = counts >= law.repeats
        if often.all():
            done.append((start, end))
            continue
        firsts, lasts = _stretches(often[local])
        long = lasts - firsts >= law.words
        waiting += [(start + int(a), start + int(b)) for a, b in zip(firsts[long], lasts[long])]
    return sorted(done)


def _at_lag(seg: np.ndarray, q: int, law: Law) -> list[Run]:
    equal = seg[:-q] == seg[q:]
    need = max(law.words, law.repeats * q) - q
    if np.count_nonzero(equal) < need:
        return []
    firsts, lasts = _stretches(equal)
    long = lasts - firsts >= need
    return [(int(a), int(b - a) + q, q) for a, b in zip(firsts[long], lasts[long])]


def _reach(n: int, runs: list[Run], longest: int) -> np.ndarray:
    """For each word the end of the furthest run around it, of the runs with a
    period of at most ``longest``; 0 outside of runs."""
    reach = np.zeros(n, np.int64)
    for start, length, period in sorted(runs, key=lambda r: r[0] + r[1]):
        if period <= longest:
            reach[start:start + length] = start + length
    return reach


def _candidate_lags(seg: np.ndarray, hashes: np.ndarray, width: int, runs: list[Run], law: Law) -> np.ndarray:
    """The lags in [2 width, 4 width) at which three consecutive grid windows
    stand again, outside of runs already found."""
    n, last = len(seg), len(seg) // law.repeats
    span = min(4 * width, last + 1) - 2 * width
    k = (len(hashes) - 2 * width - 1) // width + 1
    if span <= 0 or k < 3:
        return np.empty(0, np.int64)
    padded = np.zeros((k - 1) * width + 2 * width + span, np.uint64)
    m = min(len(padded), len(hashes))
    padded[:m] = hashes[:m]
    reach = _reach(n, runs, width)[::width][:k]
    found = np.zeros(span, bool)
    rows = max(3, (1 << 22) // span)                       # compare at most about 4 million windows at once
    grid = np.arange(k, dtype=np.int64) * width
    for at in range(0, k - 2, rows - 2):
        part = slice(at, min(at + rows, k))
        later = np.lib.stride_tricks.as_strided(
            padded[at * width + 2 * width:], (part.stop - at, span), (width * 8, 8), writeable=False)
        same = later == hashes[grid[part]][:, None]
        # The last lag at which window and repeat lie in the known run.
        known = reach[part] - grid[part] - 3 * width
        same &= np.arange(span)[None, :] > known[:, None]
        found |= (same[:-2] & same[1:-1] & same[2:]).any(axis=0)
    return np.flatnonzero(found) + 2 * width


def lag_scan(seg: np.ndarray, law: Law = LAW) -> list[Run]:
    """All runs of the segment, each with its smallest period."""
    last = len(seg) // law.repeats
    runs: dict[tuple[int, int], Run] = {}

    def add(q: int) -> None:
        for run in _at_lag(seg, q, law):
            runs.setdefault(run[:2], run)

    for q in range(1, min(last, DIRECT - 1) + 1):
        add(q)
    width = DIRECT // 2
    if last >= DIRECT:
        hashes = mix(seg.astype(np.uint64) + np.uint64(1))
        done = 1
        while 2 * width <= last:
            while done < width:                            # hashes of windows twice as wide
                hashes = mix(hashes[:-done] * _SPREAD + hashes[done:])
                done *= 2
            for q in _candidate_lags(seg, hashes, width, list(runs.values()), law).tolist():
                add(q)
            width *= 2
    return list(runs.values())


def find_runs(words: list[bytes], law: Law = LAW) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < law.words:
        return []
    codes = word_codes(words)
    with np.errstate(over="ignore"):
        return sorted(((start + a, length, q) for start, end in split_segments(codes, law)
                       for a, length, q in lag_scan(codes[start:end], law)), key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length/period, exactly compared; of equal ones
    the first, then the one of smaller period (``runs`` comes in that order)."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", law: Law = LAW) -> DataFrame:
    """(id, n_words, runs, best, collapsed) of every row: ``runs`` by start then
    period, ``best`` the one with most repeats (null if none), ``collapsed`` the
    kept words joined by one space."""
    if law.repeats < 3:
        raise ValueError("a run repeats its period three times at least")
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_list(batch.column(1))
            for part in iter_chunks([len(t) for t in texts]):
                counts, found, texts_out = [], [], []
                for text in texts[part]:
                    words = text.split()
                    runs = find_runs(words, law)
                    counts.append(len(words))
                    found.append(runs)
                    texts_out.append(b" ".join(collapse(words, runs)))
                named = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                best = [dict(zip(("start", "length", "period"), r)) if (r := strongest(runs)) else None for runs in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, part.stop - part.start).cast(id_type), pa.array(counts, pa.int64()),
                     pa.array(named, pa.list_(_RUN)), pa.array(best, _RUN), pa.array(texts_out, pa.binary()).cast(pa.string())],
                    ["id", "n_words", "runs", "best", "collapsed"])

    triple = "struct<start: bigint, length: bigint, period: bigint>"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, runs array<{triple}>, best {triple}, "
             "collapsed string")
    return out.withColumnRenamed("id", id_col)


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's planted repeats: in a tenth of the ids the words from
    ``a`` on become repeats of the ``p`` words at ``a``."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the planted repeats; other texts stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), byte_list(batch.column(1))
            for part in iter_chunks([len(t) for t in texts]):
                out = []
                for i, text in zip(ids[part], texts[part]):
                    words = text.split()
                    changed = plant(words, i)
                    out.append(text if changed is words else b" ".join(changed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part], pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, text string")


def op12_query(docs: DataFrame) -> DataFrame:
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return periodic_runs(planted(docs)).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


# The least run has 24 words and a period of up to 8, so 16 consecutive words
# stand again one period later: pairs of equal 16-word windows hold every run.
OP12_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(strlen(doc_id::VARCHAR)),
           lambda i: list_concat([ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT],
                                 [(-1)::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS state
  FROM documents),
h AS (SELECT row_no, doc_id, words, len(words)::BIGINT AS n, xor(state, 4294967295) AS h FROM w),
p AS (SELECT *, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS d FROM h),
t AS (
  SELECT row_no, doc_id, n, CASE WHEN planted THEN list_concat(words[1:a], list_transform(range(n - a),
         lambda i: words[a + 1 + i % (1 + (n - a) // d)])) ELSE words END AS words FROM p),
grams AS (
  SELECT row_no, unnest(range(n - 15)) AS i,
         unnest(list_transform(range(n - 15), lambda i: hash(array_to_string(words[i + 1:i + 16], ' ')))) AS g
  FROM t WHERE n >= 24),
pairs AS (
  SELECT x.row_no, x.i, y.i - x.i AS q FROM grams x JOIN grams y
  ON x.row_no = y.row_no AND x.g = y.g AND x.i < y.i),
islands AS (
  SELECT row_no, q, i, i - row_number() OVER (PARTITION BY row_no, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT row_no, q, min(i) AS start, count(*) + 15 + q AS length FROM islands GROUP BY row_no, q, island
  HAVING count(*) + 15 + q >= greatest(24, 3 * q)),
runs AS (SELECT row_no, start, length, min(q) AS period FROM stretches GROUP BY row_no, start, length),
best AS (
  SELECT DISTINCT ON (row_no) row_no, start, length, period FROM runs
  ORDER BY row_no, length::DOUBLE / period DESC, start, period),
digests AS (
  SELECT row_no, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY row_no),
dropped AS (
  SELECT DISTINCT row_no, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT s.row_no, string_agg(s.word, ' ' ORDER BY s.i) AS collapsed FROM (
    SELECT row_no, unnest(range(n)) AS i, unnest(words) AS word FROM t
    WHERE row_no IN (SELECT row_no FROM runs)) s
  ANTI JOIN dropped d ON d.row_no = s.row_no AND d.i = s.i
  GROUP BY s.row_no)
SELECT t.doc_id, coalesce(g.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
       b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
       sha256(coalesce(g.lines, '')) AS runs_sha256,
       sha256(CASE WHEN g.row_no IS NULL THEN array_to_string(t.words, ' ') ELSE coalesce(k.collapsed, '') END) AS collapsed_sha256
FROM t LEFT JOIN digests g USING (row_no) LEFT JOIN best b USING (row_no) LEFT JOIN kept k USING (row_no)
"""
