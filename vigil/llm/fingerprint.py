"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Each paragraph (a line) and each piece of it (runs of words cut after words
whose hash falls in one of ``CUT`` classes, about ``CUT`` words long) is hashed
to a wide vector of ``LANES`` lanes of +1 or -1. A document's fingerprint is
the sum of its vectors modulo 2**16, so

- the order of paragraphs does not matter, and equal texts have equal
  fingerprints;
- inserting a paragraph adds its vector and deleting one subtracts it
  (``insert`` and ``delete``), without the rest of the document;
- the distance of two fingerprints estimates the size of the symmetric
  difference of their multisets, which gives ``likeness`` from 0 to 1.

Two different multisets collide only if all lanes of a random walk return to
zero together, or if the 64-bit hashes of their units do. A lane is read as a
signed 16-bit number, so likeness holds while no lane's sum leaves that range
(a unit repeated over 32,767 times wraps); equality does not depend on it.

``with_next`` pairs every document with the next one by id: one range shuffle,
after which the neighbour is the next row of the partition; only the first and
last document of each partition are matched across partitions. Rows of equal
id follow each other by the hash of their text, then text; a null id comes
first. Null texts are empty; an
empty text has the zero fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import WordHashes, mix, shared_table

LANES = 256
CUT = 4
_LANE_SEEDS = mix(np.arange(1, LANES // 64 + 1, dtype=np.uint64))


def _units(text: bytes, hashes: WordHashes) -> np.ndarray:
    """64-bit hashes of the paragraphs and their pieces."""
    lines = [line for line in text.split(b"\n") if line]
    whole = np.fromiter((xxhash.xxh3_64_intdigest(line) for line in lines), np.uint64, len(lines))
    words, ends = [], []
    for line in lines:
        words += line.split()
        ends.append(len(words))
    if not words:
        return whole
    h = hashes.of(words)
    n = len(h)
    last = h % np.uint64(CUT) == 0
    last[np.array(ends, np.int64)[np.array(ends) > 0] - 1] = True
    last[-1] = True
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    with np.errstate(over="ignore"):
        pieces = mix(np.add.reduceat(mix(h + place.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)), starts))
    return np.concatenate([whole, pieces])


def vector(text: bytes, hashes: WordHashes | None = None) -> np.ndarray:
    """The fingerprint: ``LANES`` integers modulo 2**16."""
    units = _units(text, hashes if hashes is not None else WordHashes())
    total = np.zeros(LANES, np.int64)
    for at in range(0, len(units), 4096):                      # bounded expansion of long texts
        part = units[at:at + 4096]
        bits = np.unpackbits(mix(part[:, None] ^ _LANE_SEEDS[None, :]).view(np.uint8).reshape(len(part), -1), axis=1)
        total += 2 * bits.sum(axis=0, dtype=np.int64) - len(part)
    return total.astype(np.uint16)


def insert(fingerprint: np.ndarray, paragraph: bytes) -> np.ndarray:
    return fingerprint + vector(paragraph)


def delete(fingerprint: np.ndarray, paragraph: bytes) -> np.ndarray:
    return fingerprint - vector(paragraph)


def to_bytes(fingerprint: np.ndarray) -> bytes:
    """The lanes' low bytes, then their high bytes (which compress well)."""
    return fingerprint.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def encode(fingerprint: np.ndarray) -> str:
    return to_bytes(fingerprint).hex().upper()


def decode(fingerprint: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(2, -1).T).view("<u2").reshape(-1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common units (twice the common ones over all), estimated."""
    x, y = a.view(np.int16).astype(np.float64), b.view(np.int16).astype(np.float64)
    size = float(x @ x + y @ y)
    if size == 0:
        return 1.0
    d = (a - b).view(np.int16).astype(np.float64)
    return min(1.0, max(0.0, 1.0 - float(d @ d) / size))


def half_edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the
    following text."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


_RESULT = ("n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double")
_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _compare(text: str, own: np.ndarray, following: str, theirs: np.ndarray, hashes: WordHashes) -> tuple:
    edited = half_edit(text, following).encode()
    changed = vector(edited, hashes)
    return (len(text), hashlib.sha256(edited).digest(), to_bytes(own), to_bytes(changed),
            likeness(own, changed), likeness(own, theirs))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its half edit with the next document."""
    ordered = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ranged = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), tie, "text").withColumn("part", F.spark_partition_id())
    id_type = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held = None                                            # the row whose successor is not known yet
        part = None

        def emit(rows, edges, ids_type):
            kinds = ["row"] * len(rows) + [e[0] for e in edges]
            ids = [r[0] for r in rows] + [e[1] for e in edges]
            texts = [None] * len(rows) + [e[2] for e in edges]
            values = [r[1] for r in rows] + [(None,) * len(_TYPES)] * len(edges)
            columns = [pa.array(c, t) for c, t in zip(zip(*values), _TYPES)]
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([part] * len(kinds), pa.int32()),
                 pa.array(ids, ids_type), pa.array(texts, pa.string()), *columns],
                ["kind", "part", "doc_id", "edge_text", *[f.split()[0] for f in _RESULT.split(", ")]])

        ids_type = None
        for batch in batches:
            ids_type = batch.schema.field(0).type
            rows, edges = [], []
            for doc_id, text, pid in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = vector(text.encode(), hashes)
                if held is None:
                    part = pid
                    edges.append(("first", doc_id, text))
                else:
                    rows.append((held[0], _compare(held[1], held[2], text, own, hashes)))
                held = (doc_id, text, own)
            if rows or edges:
                yield emit(rows, edges, ids_type)
        if held is not None:
            yield emit([], [("last", held[0], held[1])], ids_type)

    schema = f"kind string, part int, doc_id {id_type}, edge_text string, {_RESULT}"
    table = shared_table(ranged.mapInArrow(run, schema), "fingerprints", ["kind"], compression="zstd")
    inner = table.where("kind = 'row'").select("doc_id", *[f.split()[0] for f in _RESULT.split(", ")])

    # Two rows per non-empty partition from here on; the window sees partition
    # numbers only, texts meet in the join.
    edges = table.where("kind <> 'row'").select("kind", "part", "doc_id", "edge_text")
    parts = edges.where("kind = 'first'").select("part")
    follows = parts.withColumn("next_part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.lit(None)))
    wrap = parts.agg(F.min("part").alias("lowest"))
    follows = follows.join(F.broadcast(wrap)).select(
        "part", F.coalesce("next_part", "lowest").alias("next_part"))
    first = edges.where("kind = 'first'").select(
        F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"))
    last = edges.where("kind = 'last'").join(follows, "part").join(first, "next_part").select(
        "doc_id", "edge_text", "next_text")

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [_compare(t, vector(t.encode(), hashes), f, vector(f.encode(), hashes), hashes)
                    for t, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)]],
                ["doc_id", *[f.split()[0] for f in _RESULT.split(", ")]])

    both = inner.unionByName(last.mapInArrow(resolve, f"doc_id {id_type}, {_RESULT}"))
    return both.withColumns({
        "edited_sha256": F.lower(F.hex("edited_sha256")), "fingerprint": F.hex("fingerprint"),
        "edited_fingerprint": F.hex("edited_fingerprint")}).withColumnRenamed("doc_id", id_col)


def op8_query(docs: DataFrame) -> DataFrame:
    return with_next(docs)
