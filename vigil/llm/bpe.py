"""BPE encoding through a distinct-word table.

The tokenizer's stages never look across white space (its pre-tokenizer pattern
has no alternative with a space, its normalizer maps character by character or
composes within a run without spaces, and its special tokens hold none), so the
ids of a text are the ids of its words in order. Hence:

1. Documents are split into words, block by block (``blocks``); a document
   becomes a list of codes into its block's word list.
2. All blocks' words are shuffled by word and sorted; each distinct word is
   encoded once by the tokenizer; its ids go back to the blocks that asked.
3. The ids are joined back by position: a block's documents look their codes up
   in the answers of their block.
4. Decoding joins ids with the vocabulary's pieces. The id-to-piece table has
   as many rows as the vocabulary, which is fixed by the tokenizer's file, so it
   is the broadcast side of the join (``decode`` does the join on rows of ids;
   ``encode_documents`` does it per distinct word of a block).

Nulls are empty texts; a text without words has no ids and decodes to an empty
text. Repeated rows give repeated results. A word of any length is one key.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.blocks import BLOCK_BYTES, Packer, deliver, from_planes, iter_blocks, iter_chunks, planes, split_documents
from vigil.llm.common import lean

FLUSH_WORDS = 1_000_000        # answered words a task holds before packing them by block


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(id, piece) of the tokenizer's file, special tokens included."""
    pieces = load_tokenizer(path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(pa.table({"id": pa.array(list(pieces.values()), pa.int32()),
                                           "piece": pa.array(list(pieces), pa.string())}))


def decode(encoded: DataFrame, pieces: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): join every id with its piece and put the pieces back in
    order, with one space between (this tokenizer has no decoder of its own).
    Unknown ids give no piece. Rows of one id are decoded apart if ``id_col`` is
    unique; null and empty lists decode to an empty text."""
    rows = encoded.select(id_col, F.posexplode_outer(ids_col).alias("pos", "id"))
    known = rows.join(F.broadcast(pieces), "id", "left")
    return known.groupBy(id_col).agg(F.array_sort(F.collect_list(
        F.when(F.col("piece").isNotNull(), F.struct("pos", "piece")))).alias("parts")).select(
        id_col, F.array_join(F.transform("parts", lambda p: p["piece"]), " ").alias("decoded"))


def _words_of_block(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, list[int]]:
    """(distinct words, most frequent first; codes of all words; words per text)."""
    index: dict[bytes, int] = {}
    parts, counts = [], []
    for text in texts:
        words = text.split()
        counts.append(len(words))
        for w in words:
            if w not in index:
                index[w] = len(index)
        parts.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
    codes = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    order = np.argsort(-np.bincount(codes, minlength=len(index)), kind="stable")
    rank = np.empty(len(index), np.uint32)
    rank[order] = np.arange(len(index), dtype=np.uint32)
    distinct = list(index)
    return [distinct[i] for i in order], rank[codes] if len(codes) else codes, counts


def word_requests(source: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(word, block, idx): every distinct word of every block, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, columns in iter_blocks(batches, block_bytes):
            words, _, _ = _words_of_block(columns[1])
            by_word = sorted(range(len(words)), key=words.__getitem__)
            for at in range(0, len(words), 50_000):
                part = by_word[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[i] for i in part], pa.binary()), pa.array([block] * len(part), pa.int64()),
                     pa.array(part, pa.int32())], ["word", "block", "idx"])
    return source.mapInArrow(lean(run), "word binary, block bigint, idx int")


def word_chunks(source: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, kind, seq, ids, blob): documents as codes, packed in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        for block, columns in iter_blocks(batches, block_bytes):
            _, codes, counts = _words_of_block(columns[1])
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            for seq, part in enumerate(iter_chunks([4 * n for n in counts])):
                blob = packer.pack(np.array(counts[part], np.int64), *planes(codes[ends[part.start]:ends[part.stop]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([1], pa.int32()), pa.array([seq], pa.int64()),
                     pa.array([columns[0][part]], pa.list_(id_type)), pa.array([blob], pa.binary())],
                    ["block", "kind", "seq", "doc_ids", "blob"])
    id_type = _arrow_type(source, "doc_id")
    return source.mapInArrow(lean(run), f"block bigint, kind int, seq bigint, "
                                  f"doc_ids array<{source.schema['doc_id'].dataType.simpleString()}>, blob binary")


def _arrow_type(df: DataFrame, column: str):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def encode_words(requests: DataFrame, tokenizer_path: str, flush_words: int = FLUSH_WORDS) -> DataFrame:
    """Encode every distinct word once and pack the ids by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = load_tokenizer(tokenizer_path), Packer()
        blocks, idx, lengths, ids = [], [], [], []
        last, last_ids = None, None
        seq = 0

        def flush():
            nonlocal seq
            if not blocks:
                return None
            b, i, n = np.concatenate(blocks), np.concatenate(idx), np.concatenate(lengths)
            flat = np.concatenate(ids)
            ends = np.cumsum(n)
            order = np.lexsort((i, b))
            starts = np.flatnonzero(np.diff(b[order], prepend=b[order][0] - 1))
            out = []
            for part in np.split(order, starts[1:]):
                total = int(n[part].sum())
                shift = np.repeat(ends[part] - n[part] - np.concatenate([[0], np.cumsum(n[part])[:-1]]), n[part])
                # Steps between rising codes are small numbers.
                out.append((int(b[part[0]]), packer.pack(
                    *planes(np.diff(i[part], prepend=0)), *planes(n[part]), *planes(flat[np.arange(total) + shift]))))
            for held in (blocks, idx, lengths, ids):
                held.clear()
            seq += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([0] * len(out), pa.int32()),
                 pa.array([seq] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.binary())],
                ["block", "kind", "seq", "blob"])

        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0).to_pylist()
            new = [w for w, before in zip(words, [last] + words) if w != before]
            coded = [e.ids for e in tokenizer.encode_batch(
                [w.decode("utf-8", "replace") for w in new], add_special_tokens=False)]
            table = ([last_ids] if words[0] == last else []) + coded
            step = np.fromiter((w != before for w, before in zip(words, [last] + words)), bool, len(words))
            which = np.cumsum(step) - (0 if words[0] == last else 1)
            sizes = np.fromiter(map(len, table), np.int64, len(table))
            flat = np.fromiter((t for ids_ in table for t in ids_), np.uint32, int(sizes.sum()))
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            n = sizes[which]
            shift = np.repeat(firsts[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            blocks.append(batch.column(1).to_numpy())
            idx.append(batch.column(2).to_numpy())
            lengths.append(n)
            ids.append(flat[np.arange(int(n.sum())) + shift])
            last, last_ids = words[-1], table[-1]
            held += len(words)
            if held >= flush_words:
                yield flush()
                held = 0
        out = flush()
        if out is not None:
            yield out

    ordered = requests.repartition("word").sortWithinPartitions("word")
    return ordered.mapInArrow(lean(run), "block bigint, kind int, seq bigint, blob binary")


class _WordTable:
    """ids and decoded pieces of the words of one block."""

    def __init__(self, pieces: dict[int, bytes], block: int):
        self.block, self.pieces = block, pieces
        self.idx, self.sizes, self.flat = [], [], []
        self.ids: list = []
        self.texts: list = []

    def add(self, idx, sizes, flat) -> None:
        self.idx.append(idx)
        self.sizes.append(sizes)
        self.flat.append(flat)

    def finish(self) -> None:
        if not self.idx:
            return
        idx, sizes, flat = (np.concatenate(x) for x in (self.idx, self.sizes, self.flat))
        ends = np.cumsum(sizes)
        self.ids = [None] * (int(idx.max()) + 1)
        self.texts = [None] * len(self.ids)
        raw, get = flat.astype("<u4").tobytes(), self.pieces.get
        values = flat.tolist()
        for i, end, n in zip(idx.tolist(), ends.tolist(), sizes.tolist()):
            self.ids[i] = raw[4 * (end - n):4 * end]
            self.texts[i] = b" ".join([p for p in map(get, values[end - n:end]) if p is not None])
        self.idx, self.sizes, self.flat = [], [], []


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False, block_bytes: int = BLOCK_BYTES,
                     flush_words: int = FLUSH_WORDS) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every document, with the
    ids and the decoded text when ``with_ids``. ``docs`` must be a table."""
    path = tokenizer_path or default_tokenizer()
    spark = docs.sparkSession
    source = split_documents(docs, id_col, text_col)
    # Fixed by the tokenizer's file, whatever the documents.
    table = spark.sparkContext.broadcast(
        {r["id"]: r["piece"].encode() for r in vocabulary(spark, path).toLocalIterator()})
    id_type = _arrow_type(source, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, words = Packer(), None
        for batch in batches:
            for block, kind, blob, ids in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                                for c in ("block", "kind", "blob", "doc_ids"))):
                if words is None or words.block != block:
                    words = _WordTable(table.value, block)
                if kind == 0:
                    parts = packer.unpack(blob, *[np.uint8] * 12)
                    step, sizes, flat = (from_planes(parts[k:k + 4]) for k in (0, 4, 8))
                    words.add(np.cumsum(step, dtype=np.int64), sizes.astype(np.int64), flat)
                    continue
                words.finish()
                counts, *parts = packer.unpack(blob, np.int64, *[np.uint8] * 4)
                codes = from_planes(parts).tolist()
                rows, at = [], 0
                for doc_id, n in zip(ids, counts.tolist()):
                    own = codes[at:at + n]
                    at += n
                    raw = b"".join(map(words.ids.__getitem__, own))     # a missing answer fails here
                    text = b" ".join([t for t in map(words.texts.__getitem__, own) if t])
                    rows.append((doc_id, len(raw) // 4, hashlib.sha256(raw).hexdigest(),
                                 hashlib.sha256(text).hexdigest())
                                + ((np.frombuffer(raw, "<u4").astype(np.int32).tolist(), text.decode()) if with_ids else ()))
                types = [id_type, pa.int64(), pa.string(), pa.string()] + (
                    [pa.list_(pa.int32()), pa.string()] if with_ids else [])
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if with_ids else [])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = (f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, "
              "decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else ""))
    return deliver(encode_words(word_requests(source, block_bytes), path, flush_words),
                   word_chunks(source, block_bytes), run, schema).withColumnRenamed(
        "doc_id", id_col)


def op6_query(docs: DataFrame) -> DataFrame:
    return encode_documents(docs)
