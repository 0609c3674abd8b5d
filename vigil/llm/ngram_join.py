"""N-gram Jaccard join with prefix filters under several global token orders.

A document is the set of its distinct 5-word shingles (hashed to 64 bits). Two
sets x and y with Jaccard at least 4/5 share at least ``need = ceil(4/5 |x|)``
tokens of x, so under *any* total order of the tokens they share one among the
first ``|x| - need + 1`` tokens of x (its prefix) and the same of y. A candidate
pair must pass this test under three orders:

1. *rare first* - tokens seen once, then tokens seen repeatedly, then tokens
   that were not counted, then the most frequent ones; within a class by hash.
   This order carries the inverted index. A document whose prefix is all unique
   tokens cannot have a partner and emits nothing, and boilerplate shared by
   very many documents comes last, so its long posting lists are only met by
   documents that hold hardly anything else;
2. *ascending hash* and 3. *descending hash* - tested on the candidate pairs,
   before their full overlap is counted.

Which class a token has is read from corpus counts: all tokens of the hash
region below ``Bounds.region`` are counted over all documents, a bit array of fixed
size marks the repeated ones (a false mark only moves a token to a later
class), and the most frequent ones are listed. Any outcome gives
a total order, so the join is exact whatever these bounds are; they bound what
is broadcast.

Equal sets are one class and meet only once. Within a posting list each class
is first compared with one leader (the class with the smallest share of unique
tokens), which joins families of near copies with a linear number of pairs; then
the pairs of classes that are in different components are compared, so no link
between components is lost. Those pairs must also pass the length and
positional filters and a parity sketch, a lower bound of the sets' difference,
inside the join, which keeps families of loosely similar texts (thousands of
edits of one text that are mostly further apart than the threshold) from being
written out as pairs. The comparisons inside such a family still grow with the
square of its size.

Nulls, empty texts and texts without words have an empty set and link with
nothing (their component is their own id). Repeated rows are one class. A null
id never becomes a component id unless its whole component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.common import WordHashes, byte_list, lean, map_batches, mix, shared_table, window_hashes
from vigil.session import cut_lineage

WIDTH = 5                      # fixed values of the contract: 5 words, 80 %
NUM, DEN = 4, 5
TOKEN_BITS = 48                # stored bits of a token (six bytes)
STAR_ROUNDS = 2
GROUP = 500                    # documents a task holds as arrays at a time
REMEMBERED = 100_000           # names of sets a task remembers as sent
POSTING = ["token", "cls", "n", "pos", "lone"]
KEY_BITS = 24                  # bit array of the keys that do not simply stay: 2 MB
SKETCH = 512
SKETCH_COLUMNS = [f"s{k}" for k in range(SKETCH // 64)]


@dataclass(frozen=True)
class Bounds:
    """Sizes of what the rare-first order is read from. They change the order,
    hence the work, never the result."""
    region: int = int(0.32 * 2**TOKEN_BITS)      # tokens below are counted
    filter_bits: int = 26                        # bit array of repeated tokens: 8 MB
    hot_df: int = 64                             # documents from which a token is frequent
    hot_tokens: int = 1 << 18                    # most frequent tokens listed: 2 MB


BOUNDS = Bounds()


def pack(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view("<u8").reshape(-1)


def prefix_length(n: int) -> int:
    return n - (NUM * n + DEN - 1) // DEN + 1


def set_of(text: bytes, hashes: WordHashes) -> tuple[int, bytes | None, np.ndarray]:
    """(set size, a 128-bit name of the set, its tokens in ascending order)."""
    found = np.unique(window_hashes(hashes.of(text.lower().split()), WIDTH))
    if not len(found):
        return 0, None, found
    return len(found), xxhash.xxh3_128_digest(found.tobytes()), np.unique(found >> np.uint64(64 - TOKEN_BITS))


def token_counts(source: DataFrame, bounds: Bounds = BOUNDS) -> DataFrame:
    """(token, df) of the counted region, where df is 2 or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                found = [t[:np.searchsorted(t, bounds.region)] for t in (
                    set_of(text, hashes)[2] for text in byte_list(batch.column(0).slice(at, GROUP)))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64))], ["token"])

    tokens = source.select("text").where(F.col("text").isNotNull()).mapInArrow(lean(run), "token bigint")
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")


def order_tables(counts: DataFrame, bounds: Bounds = BOUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(bit array of repeated tokens, sorted most frequent tokens); both have a
    fixed largest size: 2**filter_bits bits and hot_tokens integers."""
    low = (1 << bounds.filter_bits) - 1
    words = counts.select(F.expr(f"token & {low}").alias("bit")).groupBy(
        F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    table = np.zeros(1 << (bounds.filter_bits - 6), np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    hot = counts.where(F.col("df") > bounds.hot_df).orderBy(F.desc("df"), "token").limit(bounds.hot_tokens) \
        .select("token").toArrow().column("token").to_numpy()
    return table.view(np.uint64), np.sort(hot.astype(np.uint64))


def _prefix(tokens: np.ndarray, repeated: np.ndarray, hot: np.ndarray, bounds: Bounds = BOUNDS) -> tuple[int, np.ndarray]:
    """(unique tokens in the prefix, the other prefix tokens in rare-first order)."""
    p = prefix_length(len(tokens))
    cut = int(np.searchsorted(tokens, bounds.region))
    region, rest = tokens[:cut], tokens[cut:]
    bit = region & np.uint64((1 << bounds.filter_bits) - 1)
    seen = (repeated[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
    unique = int(cut - np.count_nonzero(seen))
    if unique >= p:
        return unique, tokens[:0]
    again = region[seen]
    if len(hot) and len(again):
        at = np.minimum(np.searchsorted(hot, again), len(hot) - 1)
        is_hot = hot[at] == again
    else:
        is_hot = np.zeros(len(again), bool)
    return unique, np.concatenate([again[~is_hot], rest, again[is_hot]])[:p - unique]


def prefix_index(source: DataFrame, repeated: np.ndarray, hot: np.ndarray, bounds: Bounds = BOUNDS) -> DataFrame:
    """Rows of three kinds: ``doc`` (doc_id, n, cls) for every document, and for
    sets that may have a partner ``posting`` (token, cls, n, pos, lone) and
    ``set`` (cls, tokens). ``lone`` is the share of unique tokens in
    thousandths. A task leaves out postings of sets it has just emitted, so
    copies that stand together are not sent one by one."""
    tables = source.sparkSession.sparkContext.broadcast((repeated, hot))
    id_type = to_arrow_type(source.schema["doc_id"].dataType)
    names = ["kind", "doc_id", "token", "cls", "n", "pos", "lone", "tokens"]
    types = [pa.string(), id_type, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(rows, t) for c, t in zip(names, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, frequent = tables.value
        hashes, sent = WordHashes(), set()
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                sizes, classes, found = [], [], []
                for text in byte_list(batch.column(1).slice(at, GROUP)):
                    n, name, tokens = set_of(text, hashes)
                    sizes.append(n)
                    classes.append(name)
                    if n and name not in sent:
                        unique, prefix = _prefix(tokens, bits, frequent, bounds)
                        if len(prefix):
                            found.append((name, tokens, unique, prefix))
                            if len(sent) >= REMEMBERED:
                                sent.clear()
                            sent.add(name)
                m = len(sizes)
                yield batch_of(m, kind=pa.array(["doc"] * m), doc_id=batch.column(0).slice(at, GROUP),
                               cls=pa.array(classes, pa.binary()), n=pa.array(sizes, pa.int64()))
                if not found:
                    continue
                lengths = np.array([len(f[3]) for f in found])
                total = int(lengths.sum())
                begin = np.repeat(np.cumsum(lengths) - lengths - [f[2] for f in found], lengths)
                owner = pa.DictionaryArray.from_arrays(
                    pa.array(np.repeat(np.arange(len(found), dtype=np.int32), lengths)),
                    pa.array([f[0] for f in found], pa.binary())).cast(pa.binary())
                yield batch_of(
                    total, kind=pa.array(["posting"] * total), cls=owner,
                    token=pa.array(np.concatenate([f[3] for f in found]).astype(np.int64)),
                    n=pa.array(np.repeat([len(f[1]) for f in found], lengths).astype(np.int64)),
                    pos=pa.array((np.arange(total) - begin).astype(np.int64)),
                    lone=pa.array(np.repeat([1000 * f[2] // len(f[1]) for f in found], lengths).astype(np.int64)))
                yield batch_of(len(found), kind=pa.array(["set"] * len(found)), cls=pa.array([f[0] for f in found], pa.binary()),
                               tokens=pa.array([pack(f[1]) for f in found], pa.binary()))

    return source.mapInArrow(lean(run), f"kind string, doc_id {source.schema['doc_id'].dataType.simpleString()}, token bigint, "
                                  "cls binary, n bigint, pos bigint, lone bigint, tokens binary")


def _may_link(a: str, b: str) -> Column:
    """Length and positional filters for a token shared at a.pos and b.pos."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    left = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (NUM * F.greatest(na, nb) <= DEN * F.least(na, nb)) & (
        (NUM + DEN) * left >= NUM * (na + nb))


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Prefix tests under ascending and descending hash order, then the count."""
    p, q = prefix_length(len(x)), prefix_length(len(y))
    if not _overlap(x[:p], y[:q]) or not _overlap(x[-p:], y[-q:]):
        return False
    inter = _overlap(x, y)
    return DEN * inter >= NUM * (len(x) + len(y) - inter)


def sketches(sets: DataFrame) -> DataFrame:
    """(cls, s0 .. s7): for each of 512 hash classes of tokens, whether the set
    holds an odd number of them. A token in one of two sets only flips one bit,
    so the bits in which two sketches differ are at most as many as the tokens
    in which the sets differ."""
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.zeros((batch.num_rows, SKETCH), np.uint8)
        for i, blob in enumerate(batch.column(1).to_pylist()):
            at = (mix(unpack(blob)) & np.uint64(SKETCH - 1)).astype(np.int64)
            rows[i] = np.bincount(at, minlength=SKETCH) & 1
        words = np.packbits(rows, axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(np.ascontiguousarray(words[:, k])) for k in range(SKETCH // 64)]],
            ["cls", *SKETCH_COLUMNS])

    return map_batches(sets.select("cls", "tokens"), fn, "cls binary, " + ", ".join(f"{c} bigint" for c in SKETCH_COLUMNS))


def _near_sketches(a: str, b: str) -> Column:
    """Linked sets differ in at most (|a| + |b|) / 9 tokens."""
    apart = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SKETCH_COLUMNS), F.lit(0))
    return (NUM + DEN) * apart <= (DEN - NUM) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the threshold."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
        last, x = None, None
        keep = []
        for i in range(len(a)):
            if a[i] != last:
                last, x = a[i], unpack(ta[i])
            if _linked(x, unpack(tb[i])):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([a[i] for i in keep], pa.binary()), pa.array([b[i] for i in keep], pa.binary())], ["a", "b"])

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return map_batches(joined, fn, "a binary, b binary")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node reachable from each end of an edge,
    by alternating large-star and small-star steps over minima, each a grouped
    minimum joined back to the edges."""
    def fingerprint(df):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    state = cut_lineage(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = fingerprint(state)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut_lineage(large)
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(small, "a").where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        state = cut_lineage(rest.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
        now = fingerprint(state)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _star_pairs(postings: DataFrame) -> DataFrame:
    """Each class of a posting list with the list's leader."""
    leader = postings.groupBy("token").agg(
        F.min(F.struct("lone", "cls", "n", "pos")).alias("lead"), F.count(F.lit(1)).alias("df")).where("df > 1")
    j = postings.alias("m").join(leader.select("token", F.col("lead").alias("l")), "token")
    return j.where((F.col("l.cls") != F.col("m.cls")) & _may_link("l", "m")).select(
        F.least("l.cls", "m.cls").alias("a"), F.greatest("l.cls", "m.cls").alias("b")).distinct()


def _open_lists(postings: DataFrame, links: DataFrame) -> DataFrame:
    """The posting lists that hold several components: their postings with
    ``component`` and ``first``, the component of the list's leader."""
    labels = components(links).select(F.col("node").alias("cls"), "component")
    tagged = postings.select(*POSTING).join(labels, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    lists = tagged.groupBy("token").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.min(F.struct("lone", "cls", "component")).alias("lead")).where("lo <> hi")
    return shared_table(tagged.join(lists.select("token", F.col("lead.component").alias("first")), "token"),
                        "open-lists")


def class_links(postings: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) links of classes that span the same components as all links."""
    links = tried = None
    current = opened = postings
    for _ in range(STAR_ROUNDS):
        pairs = _star_pairs(current)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        found = cut_lineage(verify(pairs, sets))
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        opened = _open_lists(opened, links)
        # The next round's lists: what the leader's component did not take in.
        current = opened.where(F.col("component") != F.col("first"))
    wanted = sets.join(opened.select("cls").distinct(), "cls", "left_semi")
    marked = shared_table(opened.join(sketches(wanted), "cls"), "marked-lists")
    left, right = marked.alias("x"), marked.alias("y")
    crossing = left.join(right, (F.col("x.token") == F.col("y.token")) & (
        F.col("x.component") < F.col("y.component")) & _may_link("x", "y") & _near_sketches("x", "y")).select(
        F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()
    rest = cut_lineage(crossing.join(tried, ["a", "b"], "left_anti"))
    return links.unionByName(verify(rest, sets))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    bounds: Bounds = BOUNDS) -> DataFrame:
    """(id, n_shingles, component_id) of every row: component_id is the
    smallest id reachable over links of Jaccard 0.8 or more."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    repeated, hot = order_tables(cut_lineage(token_counts(source, bounds)), bounds)
    index = shared_table(prefix_index(source, repeated, hot, bounds), "prefix-index", ["kind"])
    # One shuffle by token serves the removal of copies and of lists of one.
    distinct = index.where("kind = 'posting'").repartition("token").groupBy("token", "cls").agg(
        F.min("n").alias("n"), F.min("pos").alias("pos"), F.min("lone").alias("lone"))
    lists = distinct.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    postings = shared_table(distinct.join(lists, "token").select(*POSTING), "postings")
    wanted = postings.select("cls").distinct()
    sets = shared_table(index.where("kind = 'set'").groupBy("cls").agg(F.max("tokens").alias("tokens")).join(
        wanted, "cls", "left_semi"), "sets")
    labels = components(class_links(postings, sets))
    members = index.where("kind = 'doc'").select("doc_id", "n", "cls")
    classes = members.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("least_id"))
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = cut_lineage(named.join(least, "component").select("cls", "component_id"))
    return members.join(ids, "cls", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with
    the smallest id stays (of equal ids the one whose text hash is smallest, of
    rows equal in both the one whose columns come first as JSON). Rows with
    empty sets all stay.

    Rows travel as structs, so no name clashes. A narrow table lists the special
    keys, those that go and those of which one row stays; a bit array of a fixed
    size tells the rows that may be special, and only these meet the table."""
    keyed = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_hash"),
                        F.col(text_col).alias("_text"), F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    named = near_duplicates(keyed.select(F.struct("_id", "_hash").alias("_key"), "_text"), "_key", "_text")
    per_key = named.where("n_shingles > 0").groupBy("_key").agg(
        F.count(F.lit(1)).alias("rows"), F.first("component_id").alias("component_id"))
    leads = F.col("_key") == F.col("component_id")
    special = cut_lineage(per_key.where(~leads | (F.col("rows") > 1)).select(
        F.col("_key._id").alias("_sid"), F.col("_key._hash").alias("_shash"), leads.alias("_one")))
    at = F.pmod(F.xxhash64("_hash"), F.lit(1 << KEY_BITS))
    words = special.select(F.pmod(F.xxhash64("_shash"), F.lit(1 << KEY_BITS)).alias("at")).groupBy(
        F.expr("at div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("_bits"))
    # At most 2**(KEY_BITS - 6) rows, whatever the input.
    marked = keyed.drop("_text").withColumns({"_at": at, "_word_no": F.expr(f"pmod(xxhash64(_hash), {1 << KEY_BITS}) div 64")}).join(
        F.broadcast(words), F.col("_word_no") == F.col("_word"), "left")
    may = F.coalesce(F.expr("shiftrightunsigned(_bits, cast(_at % 64 as int)) & 1") == 1, F.lit(False))
    met = marked.where(may).select("_id", "_hash", "_row").join(
        special, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_hash") == F.col("_shash")), "left")
    # Partial minima before the exchange: a row that is repeated often meets itself task by task.
    ones = met.where("_one").groupBy("_id", "_hash").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return marked.where(~may).select("_row.*").unionByName(
        met.where(F.col("_one").isNull()).select("_row.*")).unionByName(ones.select("_row.*"))


def op10_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_distinct([array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
           FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * common >= 80 * (nx.n + ny.n - common)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents
          UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.seen)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON c.node = d.doc_id
"""
