"""Cross-tokenizer alignment by external spill counting.

Every text is encoded by a byte-level BPE (side A, over space + text) and by a
piece model with byte fallback (side B, which adds the space itself). Byte
offsets at which tokens of both sides end cut the tokens into groups; an A and a
B token are linked where their byte ranges overlap. A pair of ids counts in how
many documents it is linked, over the whole corpus.

1. *Runs.* A task takes its documents in blocks (``BLOCK_BYTES`` of text),
   reduces a block's links to records (pair, document, times linked), sorted by
   A id, B id and document, cuts them by the radix of the A id and writes each
   part as a run of zstd frames. A pair that many documents share is one entry of
   a block's run, so a frequent id does not grow with its documents.
2. *Counting.* Runs of a radix are merged ``FAN_IN`` at a time by a heap over
   their frames; only one frame of each run is unpacked. Passes repeat until one
   run per radix is left, so no task reads more than ``FAN_IN`` runs of a pass,
   whatever the input. Since a run is A-major, all pairs of an A id stand
   together and the last merge also knows which of them have its highest count.
3. *Contributions.* The counted runs meet the blocks' runs again (a counted run
   is sent once to every ``FAN_IN`` blocks); each run adds its records to its
   documents' sums, and the sums of a block's radixes are added up.

No step holds more than a block, one frame per run, or one radix's pair counts,
whose number is bounded by the vocabularies and not by the documents.

Null and empty texts, and texts whose joined token bytes on either side differ
from space + text, have no tokens: zeros and an empty digest. Strings of special
tokens are plain text. Repeated rows are documents of their own, a null id stays
null, further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.blocks import Packer, iter_blocks, iter_chunks, split_documents
from vigil.llm.bpe import load_tokenizer
from vigil.llm.common import byte_list, shared_table

BLOCK_BYTES = 8 << 20
RADIXES = 64
FAN_IN = 64                       # runs that one merge opens
FRAME = 16_384                    # entries of a frame
REMEMBERED = 400_000              # stretches whose ids a worker remembers
DOC_BITS = 31                     # number of a document in its block, in the sort key

# A single space before a character that is white space in no reading of Unicode.
_CUT = re.compile(r" (?<=[^ ] )(?=[!-~\w])")
# Stretches that can stand side by side with such a space between.
_CLEAN = re.compile(r"[!-~\w][^\s▁]{0,63}")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_char() -> dict[str, int]:
    """The alphabet of byte-level BPE: printable bytes of Latin-1 stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Ids:
    """Token ids of several texts, one after the other."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts, self._ends = ids, counts, np.cumsum(counts)

    def of(self, i: int) -> np.ndarray:
        return self.ids[self._ends[i] - self.counts[i]:self._ends[i]]

    def without(self, texts: np.ndarray) -> Ids:
        if not texts.any():
            return self
        return Ids(self.ids[~np.repeat(texts, self.counts)], np.where(texts, 0, self.counts))


class Known:
    """The ids of remembered stretches, by code."""

    def __init__(self):
        self._ids, self._lengths, self._starts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._ids = np.concatenate([self._ids, ids.astype(np.int32)])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._starts = np.cumsum(self._lengths) - self._lengths

    def of(self, codes: np.ndarray, counts: np.ndarray) -> Ids:
        """The ids of texts of ``counts`` stretches each."""
        lengths = self._lengths[codes]
        ends = np.cumsum(lengths)
        at = np.repeat(self._starts[codes] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return Ids(self._ids[at].astype(np.int64), np.diff(upto))


class Sides:
    """Both tokenizers, with the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self._a = load_tokenizer(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_of_char()
        vocabulary = self._a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        self.b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else
                                piece.replace("▁", " ").encode())
        self.a_size, self.b_size = len(self.a_bytes), len(self.b_bytes)
        self._a_len = np.array([len(b) for b in self.a_bytes], np.int64)
        self._b_len = np.array([len(b) for b in self.b_bytes], np.int64)
        self._cuts = self._cuttable(a_path)
        self._forget()
        a_text, b_text = ([str(i).encode() for i in range(n)] for n in (self.a_size, self.b_size))
        # How an id is written: within its part of a group, or as its last.
        self._written = [t + b"," for t in a_text] + [t + b"|" for t in a_text] + \
            [t + b"," for t in b_text] + [t + b";" for t in b_text]

    def _cuttable(self, a_path: str) -> bool:
        """Whether both sides cut a text at every space that ``_CUT`` names: side
        A if it is a byte-level BPE with the usual pattern, in which such a space
        begins a word of its own, and no normalizer; side B if no piece goes on
        with a space after another character."""
        with open(a_path, encoding="utf-8") as file:
            stages = json.load(file)
        first = stages.get("pre_tokenizer") or {}
        return stages.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex", True) and \
            not first.get("add_prefix_space") and all(b" " not in piece.lstrip(b" ") for piece in self.b_bytes)

    def _apart(self, keys: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides for each key, encoded one by one."""
        return [e.ids for e in self._a.encode_batch([" " + k for k in keys], add_special_tokens=False)], \
            self._b.encode(keys, num_threads=1) if keys else []

    def _together(self, keys: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(ids, ids per key) of each side for keys between which both sides cut:
        encoded as one text, taken apart by byte offsets. None if the bytes
        differ anywhere."""
        whole = " ".join(keys)
        ends = np.cumsum([len(k.encode()) + 1 for k in keys])
        out = []
        for ids, lengths, names in ((self._a.encode(" " + whole, add_special_tokens=False).ids, self._a_len, self.a_bytes),
                                    (self._b.encode(whole), self._b_len, self.b_bytes)):
            if b"".join(map(names.__getitem__, ids)) != b" " + whole.encode():
                return None
            ids = np.array(ids, np.int64)
            at = np.cumsum(lengths[ids])
            cut = np.searchsorted(at, ends)
            if not np.array_equal(at[cut], ends):
                return None
            out.append((ids, np.diff(cut, prepend=-1)))
        return out

    def _learn(self, keys: list[str]) -> None:
        clean = [k for k in keys if _CLEAN.fullmatch(k)] if self._cuts else []
        found = self._together(clean) if clean else None
        if found is None:
            clean = []
        rest = list(set(keys).difference(clean))
        single = self._apart(rest)
        odd = [b"".join(map(self.a_bytes.__getitem__, x)) != b" " + k.encode()
               or b"".join(map(self.b_bytes.__getitem__, y)) != b" " + k.encode() for k, x, y in zip(rest, *single)]
        for code, key in enumerate([*clean, *rest], len(self._codes)):
            self._codes[key] = code
        self._odd = np.concatenate([self._odd, np.zeros(len(clean), bool), np.array(odd, bool)])
        for i, side in enumerate((self._a_known, self._b_known)):
            if found is not None:
                side.add(*found[i])
            side.add(np.array([x for ids in single[i] for x in ids], np.int64), np.array([len(x) for x in single[i]], np.int64))

    def encode(self, texts: list[bytes]) -> tuple[Ids, Ids]:
        """Ids of both sides; none for a text if either side's bytes differ from
        space + text. A stretch between cuts is encoded once and remembered; a
        worker remembers a bounded number of them."""
        keys = [(_CUT.split(t.decode()) if self._cuts else [t.decode()]) if t else [] for t in texts]
        if len(self._codes) > REMEMBERED:
            self._forget()
        if new := {k for ks in keys for k in ks}.difference(self._codes):
            self._learn(list(new))
        counts = np.array([len(ks) for ks in keys], np.int64)
        codes = np.fromiter(map(self._codes.__getitem__, itertools.chain.from_iterable(keys)), np.int64, int(counts.sum()))
        a, b = (side.of(codes, counts) for side in (self._a_known, self._b_known))
        owner = np.repeat(np.arange(len(texts)), counts)
        differ = np.zeros(len(texts), bool)
        for i in np.unique(owner[self._odd[codes]]).tolist():
            differ[i] = any(b"".join(map(names.__getitem__, x.of(i).tolist())) != b" " + texts[i]
                            for names, x in ((self.a_bytes, a), (self.b_bytes, b)))
        return a.without(differ), b.without(differ)

    def _forget(self) -> None:
        self._codes: dict[str, int] = {}
        self._a_known, self._b_known, self._odd = Known(), Known(), np.empty(0, bool)

    def align(self, texts: list[bytes]) -> Aligned:
        return Aligned(self, *self.encode(texts))


class Aligned:
    """Groups and links of some documents, as one sequence of tokens: the two
    sides of a document have the same bytes, so offsets agree throughout."""

    def __init__(self, sides: Sides, a: Ids, b: Ids):
        self._sides = sides
        self.n_a, self.n_b, a, b = a.counts, b.counts, a.ids, b.ids
        docs = len(self.n_a)
        doc = np.repeat(np.arange(docs), self.n_a)
        a_end, b_end = np.cumsum(sides._a_len[a]), np.cumsum(sides._b_len[b])
        b_start = b_end - sides._b_len[b]
        # B tokens that begin before each A token's end; both sides end together
        # where the last of these ends there too, else it reaches into the next.
        last = np.searchsorted(b_start, a_end, side="left")
        self._a_cut = b_end[last - 1] == a_end if len(a) else np.empty(0, bool)
        self._b_cut = np.zeros(len(b), bool)
        self._b_cut[last[self._a_cut] - 1] = True
        first = np.concatenate([[0], (last - ~self._a_cut)[:-1]]) if len(a) else last
        width = last - first
        before = np.cumsum(width) - width
        partner = np.arange(int(width.sum())) + np.repeat(first - before, width)
        self.pairs = np.repeat(a, width) * sides.b_size + b[partner]      # one entry a link
        self.pair_docs = np.repeat(doc, width)
        self.n_links = np.bincount(self.pair_docs, minlength=docs)
        self.n_groups = np.bincount(doc[self._a_cut], minlength=docs)
        self._a, self._b = a, b

    def groups(self) -> Iterator[bytes]:
        """Each document's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        a, b = self._a, self._b
        a_group, b_group = np.cumsum(self._a_cut) - self._a_cut, np.cumsum(self._b_cut) - self._b_cut
        a_upto = np.flatnonzero(self._a_cut) + 1                          # A tokens up to each group's end
        b_upto = np.concatenate([[0], np.flatnonzero(self._b_cut) + 1])   # B tokens before each group
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + b_upto[a_group]] = a + self._a_cut * self._sides.a_size
        written[np.arange(len(b)) + a_upto[b_group]] = b + self._b_cut * self._sides.b_size + 2 * self._sides.a_size
        at = 0
        for n in (self.n_a + self.n_b).tolist():
            yield b"".join(map(self._sides._written.__getitem__, written[at:at + n].tolist()))[:-1]
            at += n


@functools.lru_cache(maxsize=2)
def sides(a_path: str, b_path: str) -> Sides:
    return Sides(a_path, b_path)


class Runs:
    """Runs as lists of zstd frames of arrays."""

    def __init__(self):
        self._packer = Packer()

    def write(self, *arrays: np.ndarray) -> list[bytes]:
        n = len(arrays[0])
        return [self._packer.pack(*(x[at:at + FRAME] for x in arrays)) for at in range(0, n, FRAME)]

    def read(self, frames: list[bytes], *types) -> Iterator[list[np.ndarray]]:
        for frame in frames:
            yield self._packer.unpack(frame, *types)

    def merge(self, runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(keys, summed counts) in ascending order of the keys. The heap holds
        each run's open frame by its last key: what is not above the least of
        these is complete, because every later frame of any run is above it."""
        streams = [self.read(run, "<i8", "<i8") for run in runs]
        open_frames: dict[int, list[np.ndarray]] = {}
        heap: list[tuple[int, int]] = []

        def advance(r: int) -> None:
            frame = next(streams[r], None)
            if frame is None:
                open_frames.pop(r, None)
            else:
                open_frames[r] = frame
                heapq.heappush(heap, (int(frame[0][-1]), r))

        for r in range(len(runs)):
            advance(r)
        while heap:
            bound = heap[0][0]
            keys, counts = [], []
            for r, (k, c) in open_frames.items():
                at = int(np.searchsorted(k, bound, side="right"))
                if at:
                    keys.append(k[:at])
                    counts.append(c[:at])
                    open_frames[r] = [k[at:], c[at:]]
            while heap and heap[0][0] == bound:
                advance(heapq.heappop(heap)[1])
            found, at = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, at, np.concatenate(counts))
            yield found, sums


def _records(pairs: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(pair, document, times) in ascending order, from one entry a link."""
    packed = np.concatenate(pairs) << DOC_BITS | np.concatenate(docs)
    found, times = np.unique(packed, return_counts=True)
    return found >> DOC_BITS, found & ((1 << DOC_BITS) - 1), times


def spill(source: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES,
          radixes: int = RADIXES) -> DataFrame:
    """Rows of two kinds: ``doc`` (block, idx, doc_id, the document's own columns)
    and ``run`` (block, radix, n_docs of the block, pairs, records), where
    ``pairs`` are frames of (pair, documents) and ``records`` frames of (document,
    times) in the same order."""
    id_type = to_arrow_type(source.schema["doc_id"].dataType)
    names = ["kind", "block", "idx", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "radix", "n_docs",
             "pairs", "records"]
    types = [pa.string(), pa.int64(), pa.int32(), id_type, *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int32(),
             pa.list_(pa.binary()), pa.list_(pa.binary())]

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(rows, t) for c, t in zip(names, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, runs = sides(a_path, b_path), Runs()
        for block, (ids, texts) in iter_blocks(batches, block_bytes):
            pairs, docs = [], []
            for part in iter_chunks([len(t) for t in texts]):
                aligned = both.align(texts[part])
                pairs.append(aligned.pairs)
                docs.append(aligned.pair_docs + part.start)
                rows = part.stop - part.start
                yield batch_of(
                    rows, kind=pa.array(["doc"] * rows), block=pa.array([block] * rows, pa.int64()),
                    idx=pa.array(np.arange(part.start, part.stop, dtype=np.int32)), doc_id=pa.array(ids[part], id_type),
                    n_a=pa.array(aligned.n_a), n_b=pa.array(aligned.n_b), n_groups=pa.array(aligned.n_groups),
                    n_links=pa.array(aligned.n_links), groups_sha256=pa.array(
                        [hashlib.sha256(g).hexdigest() if g else "" for g in aligned.groups()]))
            pair, doc, times = _records(pairs, docs)
            radix = pair // both.b_size % radixes
            for r in np.unique(radix).tolist():
                mine = radix == r
                found, counts = np.unique(pair[mine], return_counts=True)
                yield batch_of(
                    1, kind=pa.array(["run"]), block=pa.array([block], pa.int64()), radix=pa.array([r], pa.int32()),
                    n_docs=pa.array([len(texts)], pa.int32()),
                    pairs=pa.array([runs.write(found.astype("<i8"), counts.astype("<i8"))], pa.list_(pa.binary())),
                    records=pa.array([runs.write(doc[mine].astype("<u4"), times[mine].astype("<u4"))],
                                     pa.list_(pa.binary())))

    return source.mapInArrow(
        run, f"kind string, block bigint, idx int, doc_id {source.schema['doc_id'].dataType.simpleString()}, n_a bigint, "
             "n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, radix int, n_docs int, "
             "pairs array<binary>, records array<binary>")


def _merged(runs: DataFrame) -> DataFrame:
    """(radix, slot, pairs): the runs of each radix and slot as one."""
    def fn(table: pa.Table) -> pa.Table:
        io = Runs()
        frames, held, n = [], [], 0
        for keys, counts in io.merge(table.column("pairs").to_pylist()):
            held.append((keys, counts))
            n += len(keys)
            if n >= FRAME:
                frames += io.write(*(np.concatenate(x) for x in zip(*held)))
                held, n = [], 0
        if held:
            frames += io.write(*(np.concatenate(x) for x in zip(*held)))
        return pa.table([table.column("radix")[:1], table.column("slot")[:1], pa.array([frames], pa.list_(pa.binary()))],
                        ["radix", "slot", "pairs"])

    return runs.groupBy("radix", "slot").applyInArrow(fn, "radix int, slot bigint, pairs array<binary>")


def _slot(order: str, runs: int, fan_in: int):
    """(slot column, slots): about ``fan_in`` consecutive runs share a slot."""
    slots = -(-runs // fan_in)
    return F.pmod(F.xxhash64(order), F.lit(slots)).cast("bigint"), slots


def count_pairs(runs: DataFrame, blocks: int, fan_in: int = FAN_IN) -> DataFrame:
    """(radix, pairs): one run of all pair counts for each radix, by merge passes."""
    current, left = runs.select("radix", F.col("block").alias("slot"), "pairs"), blocks
    while True:
        slot, left = _slot("slot", left, fan_in)
        current = shared_table(_merged(current.withColumn("slot", slot)), "pair-runs")
        if left <= 1:
            return current.select("radix", "pairs")


def _best_of(keys: np.ndarray, counts: np.ndarray, b_size: int) -> np.ndarray:
    """Which pairs have the highest count of their A id (keys are A-major)."""
    a = keys // b_size
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    highest = np.maximum.reduceat(counts, starts)
    return counts == np.repeat(highest, np.diff(np.concatenate([starts, [len(a)]])))


def contributions(runs: DataFrame, counted: DataFrame, blocks: int, b_size: int, fan_in: int = FAN_IN) -> DataFrame:
    """(block, idx, n_best, count_sum) of the documents that have links."""
    slot, slots = _slot("block", blocks, fan_in)
    tables = counted.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).select(
        "radix", F.col("slot").cast("bigint").alias("slot"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("block"),
        F.lit(None).cast("int").alias("n_docs"), "pairs", F.lit(None).cast("array<binary>").alias("records"))
    parts = runs.select("radix", slot.alias("slot"), F.lit(1).alias("kind"), "block", "n_docs", "pairs", "records")
    rows = tables.unionByName(parts).repartition("radix", "slot").sortWithinPartitions("radix", "slot", "kind")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        io, packer = Runs(), Packer()
        at = keys = counts = best = None
        for batch in batches:
            for i in range(batch.num_rows):
                radix, slot_no, kind, block, n_docs = (batch.column(c)[i].as_py() for c in range(5))
                frames = list(io.read(batch.column(5)[i].as_py(), "<i8", "<i8"))
                pair, n = (np.concatenate(x) for x in zip(*frames))
                if kind == 0:
                    at, keys, counts = (radix, slot_no), pair, n
                    best = _best_of(keys, counts, b_size)
                    continue
                if at != (radix, slot_no):
                    raise RuntimeError("a run came without its radix's counts")
                where = np.searchsorted(keys, pair)
                if not np.array_equal(keys[where], pair):
                    raise RuntimeError("a pair has no count")
                doc, times = (np.concatenate(x) for x in zip(*io.read(batch.column(6)[i].as_py(), "<u4", "<u4")))
                which = np.repeat(where, n)
                times = times.astype(np.float64)           # sums stay below 2**53
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([packer.pack(
                        np.bincount(doc, times * best[which], n_docs).astype("<i8"),
                        np.bincount(doc, times * counts[which], n_docs).astype("<i8"))], pa.binary())], ["block", "sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        at = sums = None

        def out() -> pa.RecordBatch:
            n = len(sums[0])
            return pa.RecordBatch.from_arrays(
                [pa.array([at] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(sums[0]), pa.array(sums[1])],
                ["block", "idx", "n_best", "count_sum"])

        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = packer.unpack(blob, "<i8", "<i8")
                if block != at:
                    if at is not None:
                        yield out()
                    at, sums = block, [x.copy() for x in new]
                else:
                    sums = [x + y for x, y in zip(sums, new)]
        if at is not None:
            yield out()

    partial = rows.mapInArrow(add, "block bigint, sums binary")
    return partial.repartition("block").sortWithinPartitions("block").mapInArrow(
        total, "block bigint, idx int, n_best bigint, count_sum bigint")


class Alignment:
    """The aligned corpus: ``documents`` (one row per document) and
    ``pair_table`` (a_id, b_id, n_docs, best)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
                 b_path: str | None = None, block_bytes: int = BLOCK_BYTES, radixes: int = RADIXES, fan_in: int = FAN_IN):
        if fan_in < 2:
            raise ValueError("a merge opens two runs at least")
        a_path, b_path = a_path or byte_bpe(), b_path or piece_bpe()
        self._id_col, self._b_size = id_col, sides(a_path, b_path).b_size
        source = split_documents(docs.withColumn(text_col, F.col(text_col).cast("string")), id_col, text_col)
        source = source.select("split", "doc_id", "text")
        spilled = shared_table(spill(source, a_path, b_path, block_bytes, radixes), "pair-records", ["kind"])
        self._rows, self._runs = spilled.where("kind = 'doc'"), spilled.where("kind = 'run'")
        self._fan_in = fan_in
        self._blocks = max(1, self._runs.select("block").distinct().count())
        self._counted = count_pairs(self._runs, self._blocks, fan_in)

    def documents(self) -> DataFrame:
        sums = contributions(self._runs, self._counted, self._blocks, self._b_size, self._fan_in)
        return self._rows.join(sums, ["block", "idx"], "left").select(
            F.col("doc_id").alias(self._id_col), "n_a", "n_b", "n_groups", "n_links",
            F.coalesce("n_best", F.lit(0).cast("bigint")).alias("n_best"),
            F.coalesce("count_sum", F.lit(0).cast("bigint")).alias("count_sum"), "groups_sha256")

    def pair_table(self) -> DataFrame:
        b_size = self._b_size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            io = Runs()
            for batch in batches:
                for frames in batch.column(0).to_pylist():
                    keys, counts = (np.concatenate(x) for x in zip(*io.read(frames, "<i8", "<i8")))
                    best = _best_of(keys, counts, b_size)
                    for at in range(0, len(keys), FRAME):
                        part = slice(at, at + FRAME)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[part] // b_size), pa.array(keys[part] % b_size), pa.array(counts[part]),
                             pa.array(best[part])], ["a_id", "b_id", "n_docs", "best"])

        return self._counted.select("pairs").mapInArrow(run, "a_id bigint, b_id bigint, n_docs bigint, best boolean")


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
                 b_path: str | None = None) -> DataFrame:
    """(id, groups): the groups themselves, written as ``a1,a2|b1;a3|b2,b3``."""
    a_path, b_path = a_path or byte_bpe(), b_path or piece_bpe()
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(a_path, b_path)
        for batch in batches:
            texts = byte_list(batch.column(1))
            for part in iter_chunks([len(t) for t in texts]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, part.stop - part.start).cast(id_type),
                     pa.array([g.decode() for g in both.align(texts[part]).groups()], pa.string())], ["id", "groups"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {docs.schema[id_col].dataType.simpleString()}, groups string").withColumnRenamed("id", id_col)


def op11_query(docs: DataFrame) -> DataFrame:
    return Alignment(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).documents()
