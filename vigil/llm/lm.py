"""LM scoring by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts up to ``ORDER`` long with the counts of the
byte that followed, gathered from the training documents (ids whose CRC-32
modulo 7 is not 2). Texts have A-Z lower-cased, start after ``ORDER`` start marks
and end with an end symbol; both marks are bytes that UTF-8 never uses.

A byte is predicted in its longest known context. If it was seen there c times
among n, with d distinct bytes, its probability is c / (n + d); otherwise the
model escapes with d / (n + d) (escape method C) to the context one byte
shorter, where the bytes seen in the longer context are excluded from all
counts, and so on down to a uniform choice among the bytes never seen. Contexts
never seen are passed over at no cost. The score is the sum of log10
probabilities, end symbol included.

Because every shorter context is counted wherever a longer one is, the excluded
bytes of a context are those seen in the one longer context the escape came
from, so the probability of (context, byte) depends on the trie alone: it is
worked out once per distinct byte string of ``ORDER + 1`` by joins of the count
tables, not once per position. The tables grow with the corpus; nothing of them
is broadcast or sent to the driver. Blocks of documents ask for the byte strings
and words they hold and get the answers back (``blocks``).

``base_score`` is the unigram score of the contract; its word counts take the
same way. Nulls are empty texts: one end token, one end symbol. Repeated rows are
scored alike. With no training document at all, every symbol is uniform.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.blocks import BLOCK_BYTES, Packer, deliver, iter_blocks, iter_chunks, split_documents
from vigil.llm.bpe import _arrow_type
from vigil.llm.common import shared_table
from vigil.session import cut_lineage

ORDER = 3
START, END = 0xFE, 0xFF        # bytes that no UTF-8 text contains
HELD_OUT, FOLDS = 2, 7         # fixed values of the contract
FLUSH_KEYS = 200_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def byte_strings(text: bytes, order: int = ORDER) -> np.ndarray:
    """The ``order + 1`` bytes that end at each symbol, as integers."""
    raw = np.frombuffer(bytes([START]) * order + text.lower() + bytes([END]), np.uint8)
    n = len(raw) - order
    kind = np.uint32 if order <= 3 else np.uint64
    out = np.zeros(n, kind)
    for k in range(order + 1):
        out = (out << kind(8)) | raw[k:n + k]
    return out


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[starts], np.add.reduceat(c, starts)


def requests(source: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Distinct keys of every block with their training counts: ``kind`` word
    (word, idx) and ``bytes`` (gram); and one ``total`` row per block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, (_, texts, tested) in iter_blocks(batches, block_bytes):
            index: dict[bytes, int] = {}
            trained: Counter = Counter()
            tokens = 0
            for text, test in zip(texts, tested):
                words = text.lower().split()
                for w in words:
                    if w not in index:
                        index[w] = len(index)
                if not test:
                    trained.update(words)
                    tokens += len(words) + 1
            distinct = sorted(index)
            for at in range(0, len(distinct), 50_000):
                part = distinct[at:at + 50_000]
                yield _request_rows("word", block, part, [index[w] for w in part], None,
                                    [trained[w] for w in part])
            index, trained = {}, Counter()
            keys, counts = [], []
            for part in iter_chunks([len(t) for t in texts]):
                for test in (False, True):
                    grams = [byte_strings(t, order) for t, x in zip(texts[part], tested[part]) if x == test]
                    if grams:
                        k, c = np.unique(np.concatenate(grams), return_counts=True)
                        keys.append(k.astype(np.int64))
                        counts.append(np.zeros_like(c) if test else c)
                if len(keys) >= 32:
                    keys, counts = ([x] for x in _merge(keys, counts))
            k, c = _merge(keys, counts)
            for at in range(0, len(k), 100_000):
                yield _request_rows("bytes", block, None, None, k[at:at + 100_000], c[at:at + 100_000].tolist())
            yield _request_rows("total", block, None, None, None, [tokens])

    return source.mapInArrow(run, "kind string, block bigint, word binary, idx int, gram bigint, n bigint")


def _request_rows(kind, block, words, idx, grams, n) -> pa.RecordBatch:
    m = len(n)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * m), pa.array([block] * m, pa.int64()),
         pa.array(words if words is not None else [None] * m, pa.binary()),
         pa.array(idx if idx is not None else [None] * m, pa.int32()),
         pa.array(grams if grams is not None else [None] * m, pa.int64()), pa.array(n, pa.int64())],
        ["kind", "block", "word", "idx", "gram", "n"])


def trie_probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, logp): log10 probability of the last byte of every byte string,
    given the bytes before it. ``grams`` is (gram, c) with c = 0 for strings that
    are asked for but were not trained on."""
    low = lambda k: F.col("gram").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1))
    counts = {order: grams.where("c > 0").select("gram", "c")}
    for k in range(order - 1, -1, -1):
        counts[k] = cut_lineage(counts[k + 1].groupBy(low(k).alias("gram")).agg(F.sum("c").alias("c")))

    # Per context of length k: n, d, and the count its bytes have one order below.
    contexts: dict[int, DataFrame] = {}
    for k in range(order, -1, -1):
        table = counts[k]
        if k:
            below = counts[k - 1].select(F.col("gram").alias("_low"), F.col("c").alias("_c"))
            table = table.withColumn("_low", low(k - 1)).join(below, "_low")
        else:
            table = table.withColumn("_c", F.lit(0).cast("bigint"))
        contexts[k] = table.groupBy(F.shiftright("gram", 8).alias(f"ctx{k}")).agg(
            F.sum("c").alias(f"n{k}"), F.count(F.lit(1)).alias(f"d{k}"), F.sum("_c").alias(f"x{k}"))

    rows = grams.select("gram", F.col("c").alias(f"c{order}"))
    for k in range(order, -1, -1):
        if k < order:
            rows = rows.withColumn("_low", low(k)).join(
                counts[k].select(F.col("gram").alias("_low"), F.col("c").alias(f"c{k}")), "_low", "left").drop("_low")
        ctx = F.shiftright(low(k), 8)
        rows = rows.withColumn(f"ctx{k}", ctx).join(contexts[k], f"ctx{k}", "left").drop(f"ctx{k}")
    zero = F.lit(0)
    logp = F.log10(F.lit(1.0) / (F.lit(256) - F.coalesce("d0", zero)))
    # From the shortest context up: what an escape to order k - 1 costs in all.
    for k in range(0, order + 1):
        c, n, d = (F.coalesce(f"{x}{k}", zero) for x in "cnd")
        if k < order:
            n = n - F.coalesce(f"x{k + 1}", zero)
            d = d - F.coalesce(f"d{k + 1}", zero)
        total = (n + d).cast("double")
        logp = F.when(c > 0, F.log10(c / total)).when(
            (total > 0) & (d > 0), F.log10(d / total) + logp).otherwise(logp)
    return rows.select("gram", logp.alias("logp"))


def _answer_words(word_rows: DataFrame) -> DataFrame:
    """Add up each word's counts over the blocks and pack the sums by block.
    One ``stat`` row per task part carries the distinct trained words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        held: list = []
        rows = known = 0
        words, block, idx, n = [], [], [], []

        def settle(final: bool):
            """Close all groups but the last one, which may go on."""
            nonlocal words, block, idx, n, known
            if not words:
                return
            starts = [i for i in range(len(words)) if not i or words[i] != words[i - 1]]
            cut = len(words) if final else starts[-1]
            if cut:
                at = np.array([s for s in starts if s < cut])
                sums = np.add.reduceat(np.array(n[:cut], np.int64), at)
                known += int(np.count_nonzero(sums))
                held.append((np.array(block[:cut], np.int64), np.array(idx[:cut], np.int32),
                             np.repeat(sums, np.diff(np.append(at, cut)))))
            words, block, idx, n = words[cut:], block[cut:], idx[cut:], n[cut:]

        def flush():
            nonlocal known
            out = []
            if held:
                b, i, c = (np.concatenate(x) for x in zip(*held))
                order = np.argsort(b, kind="stable")
                starts = np.flatnonzero(np.diff(b[order], prepend=b[order][0] - 1))
                out = [(int(b[p[0]]), 0, packer.pack(i[p], c[p].astype(np.int64))) for p in np.split(order, starts[1:])]
            held.clear()
            out.append((-1, -1, packer.pack(np.array([known], np.int64))))
            known = 0
            return _answer_rows(out)

        for batch in batches:
            if not batch.num_rows:
                continue
            words += batch.column(0).to_pylist()
            block += batch.column(1).to_pylist()
            idx += batch.column(2).to_pylist()
            n += batch.column(3).to_pylist()
            rows += batch.num_rows
            settle(False)
            if rows >= FLUSH_KEYS:
                yield flush()
                rows = 0
        settle(True)
        yield flush()

    ordered = word_rows.select("word", "block", "idx", "n").repartition("word").sortWithinPartitions("word")
    return ordered.mapInArrow(run, _ANSWER)


_ANSWER = "block bigint, kind int, seq bigint, blob binary"


def _answer_rows(out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
         pa.array([0] * len(out), pa.int64()), pa.array([x[2] for x in out], pa.binary())],
        ["block", "kind", "seq", "blob"])


def _answer_bytes(gram_rows: DataFrame, order: int) -> DataFrame:
    """The probability of every byte string a block holds, packed by block."""
    grams = cut_lineage(gram_rows.groupBy("gram").agg(F.sum("n").alias("c")))
    answered = gram_rows.select("block", "gram").join(trie_probabilities(grams, order), "gram")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        held, rows = [], 0

        def flush():
            b, g, p = (np.concatenate(x) for x in zip(*held))
            rank = np.lexsort((g, b))
            starts = np.flatnonzero(np.diff(b[rank], prepend=b[rank][0] - 1))
            out = [(int(b[part[0]]), 1, packer.pack(g[part], p[part])) for part in np.split(rank, starts[1:])]
            held.clear()
            return _answer_rows(out)

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(batch.column(i).to_numpy() for i in range(3)))
                rows += batch.num_rows
                if rows >= FLUSH_KEYS:
                    yield flush()
                    rows = 0
        if held:
            yield flush()

    return answered.select("block", "gram", "logp").mapInArrow(run, _ANSWER)


def _text_chunks(source: DataFrame, block_bytes: int) -> DataFrame:
    """(block, kind 2, seq, doc_ids, tested, blob): texts packed in chunks."""
    id_type = _arrow_type(source, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        for block, (ids, texts, tested) in iter_blocks(batches, block_bytes):
            for seq, part in enumerate(iter_chunks([len(t) for t in texts])):
                own = texts[part]
                blob = packer.pack(np.array([len(t) for t in own], np.int64),
                                   np.frombuffer(b"".join(own), np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([2], pa.int32()), pa.array([seq], pa.int64()),
                     pa.array([ids[part]], pa.list_(id_type)), pa.array([tested[part]], pa.list_(pa.bool_())),
                     pa.array([blob], pa.binary())], ["block", "kind", "seq", "doc_ids", "tested", "blob"])

    return source.mapInArrow(run, f"block bigint, kind int, seq bigint, "
                                  f"doc_ids array<{source.schema['doc_id'].dataType.simpleString()}>, "
                                  "tested array<boolean>, blob binary")


class _BlockModel:
    """What one block asked for: counts of its words, probabilities of its
    byte strings."""

    def __init__(self, block: int):
        self.block = block
        self.parts: dict[int, list] = {0: [], 1: []}
        self.index: dict[bytes, int] = {}
        self.ready = False

    def finish(self) -> None:
        idx = np.concatenate([p[0] for p in self.parts[0]]) if self.parts[0] else np.empty(0, np.int32)
        self.counts = np.full(int(idx.max()) + 1 if len(idx) else 0, -1, np.int64)
        if len(idx):
            self.counts[idx] = np.concatenate([p[1] for p in self.parts[0]])
        grams = np.concatenate([p[0] for p in self.parts[1]])
        order = np.argsort(grams)
        self.grams = grams[order].astype(np.uint64)
        self.logp = np.concatenate([p[1] for p in self.parts[1]])[order]
        self.log_counts = np.log10(self.counts + 1.0) if (self.counts >= 0).all() else None
        self.parts, self.ready = {0: [], 1: []}, True

    def words(self, text: bytes) -> tuple[int, int, float]:
        """(tokens without the end, known ones, sum of log10(c + 1))."""
        words = text.lower().split()
        index = self.index
        for w in words:
            if w not in index:
                index[w] = len(index)
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        return len(words), int(np.count_nonzero(self.counts[at])), float(self.log_counts[at].sum())

    def score(self, texts: list[bytes], order: int) -> list[float]:
        """log10 probability of each text."""
        parts = [byte_strings(t, order) for t in texts]
        keys = np.concatenate(parts).astype(np.uint64)
        at = np.searchsorted(self.grams, keys)
        if (at >= len(self.grams)).any() or (self.grams[at] != keys).any():
            raise RuntimeError("a byte string of this block has no answer")
        ends = np.cumsum([0] + [len(p) for p in parts[:-1]])
        return np.add.reduceat(self.logp[at], ends).tolist()


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    order: int = ORDER, tested: Column | None = None,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score).
    ``tested`` marks the documents not learned from. ``docs`` must be a table."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    mark = tested if tested is not None else held_out(F.col(id_col))
    source = split_documents(docs, id_col, text_col, mark.alias("tested"))
    id_type = _arrow_type(source, "doc_id")
    asked = shared_table(requests(source, order, block_bytes), "lm-requests", ["kind"])
    words = asked.where("kind = 'word'")
    answers = _answer_words(words).unionByName(
        _answer_bytes(asked.where("kind = 'bytes'").select("block", "gram", "n"), order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, model = Packer(), None
        names = ["doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score", "stat"]
        types = [id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        for batch in batches:
            for block, kind, blob, ids, marks in zip(*(
                    batch.column(batch.schema.get_field_index(c)).to_pylist()
                    for c in ("block", "kind", "blob", "doc_ids", "tested"))):
                if kind == -1:
                    rows = [(None, None, None, None, None, None, int(packer.unpack(blob, np.int64)[0][0]))]
                elif kind < 2:
                    if model is None or model.block != block:
                        model = _BlockModel(block)
                    model.parts[kind].append(packer.unpack(blob, *([np.int32, np.int64] if kind == 0 else [np.int64, np.float64])))
                    continue
                else:
                    if model is None or model.block != block:
                        raise RuntimeError("a block's documents came without its answers")
                    if not model.ready:
                        model.finish()
                    lengths, raw = packer.unpack(blob, np.int64, np.uint8)
                    whole, ends = raw.tobytes(), np.cumsum(lengths).tolist()
                    texts = [whole[e - n:e] for e, n in zip(ends, lengths.tolist())]
                    rows = []
                    for doc_id, test, text, score in zip(ids, marks, texts, model.score(texts, order)):
                        n, known, logs = model.words(text)
                        rows.append((doc_id, test, n + 1, known, logs, score, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = (f"doc_id {source.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens bigint, "
              "n_known bigint, log_counts double, score double, stat bigint")
    scored = shared_table(deliver(answers, _text_chunks(source, block_bytes), run, schema), "lm-scores")
    # One row: distinct trained words. The end token is one more, counted once
    # per training document; every document has one.
    known_words = scored.agg(F.coalesce(F.sum("stat"), F.lit(0)).alias("words"))
    trained = asked.where("kind = 'total'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("train_tokens"))
    ends = scored.where(F.col("stat").isNull()).agg(F.count(F.when(~F.col("held_out"), 1)).alias("train_docs"))
    totals = F.broadcast(known_words.join(trained).join(ends))
    end_known = (F.col("train_docs") > 0).cast("bigint")
    rows = scored.where(F.col("stat").isNull()).join(totals)
    base = F.col("log_counts") + F.log10(F.col("train_docs") + 1.0) - F.col("n_tokens") * F.log10(
        (F.col("train_tokens") + F.col("words") + end_known + 1).cast("double"))
    return rows.select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + end_known).alias("n_known"),
        "train_tokens", base.alias("base_score"), "score")


def op4_query(docs: DataFrame) -> DataFrame:
    return score_documents(docs)
