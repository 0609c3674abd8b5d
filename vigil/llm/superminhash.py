"""Near-duplicate grouping by SuperMinHash signatures.

A document is the set of its distinct 5-word shingles. Its signature has
``Plan.bands * Plan.rows`` slots. Every element of the set draws a random
permutation of the slots and puts the rank ``j + r`` (``r`` in [0, 1)) into its
``j``-th slot; a slot keeps the smallest rank. Two sets agree in a slot with
probability equal to their Jaccard similarity, and because an element's ranks are
those of one permutation, slots are negatively correlated: the estimate varies
less than that of independent minima. Ranks of step ``j`` are all at least
``j``, so a set stops as soon as every slot holds a rank below ``j + 1``: after a
few steps for a text of ordinary length. Steps are taken for the elements of
many documents at once; the permutations are shuffled as far as steps are taken.

Signatures are cut into bands; sets that agree in a whole band are candidates.
Sets of similarity 0.85 share none of 32 bands of 4 rows with probability
(1 - 0.85**4)**32 < 1e-10, so links are lost only with that probability.
Equal sets are one class and never need a band, and sets of five elements or
fewer link with equal sets only (5/6 < 0.85), so they send none.

Candidates are verified on the full sets. Each bucket's classes are first
compared with one leader (the class that stands in the fullest buckets), twice:
this joins families of copies with a linear number of pairs. Then the pairs in a
bucket that are still in different groups are compared, so no link between
groups is lost. All pairs must pass the length filter and a parity sketch (a
lower bound of the difference of two sets) before their sets meet; in the last
step these stand in the join's condition, so families that are alike but below
the threshold are not written out as pairs.

Links are grouped by union-find: every task reduces its links to a forest, then
alternating star steps over the remaining links give each class the smallest
class it reaches, and members the smallest document id of the group.

Nulls, empty texts and texts without words have an empty set and link with
nothing (component: their own id). Repeated rows are one class. A null id
becomes a component id only if its whole group has no other, and ``kept`` is true
where id and component id are both null. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.common import WordHashes, byte_list, lean, map_batches, mix, shared_table
from vigil.llm.ngram_join import components, pack, set_of, unpack
from vigil.session import cut_lineage

NUM, DEN = 17, 20                # fixed value of the contract: 85 %
LEAST = 6                        # smaller sets link with equal sets only
LEADER_ROUNDS = 2
GROUP = 400                      # documents a task holds as arrays at a time
ELEMENTS = 1 << 15               # elements whose permutations a task holds at a time
REMEMBERED = 100_000             # names of sets a task remembers as sent
FOREST = 500_000                 # classes a task's union-find holds
FILTER_BITS = 24                 # bit array of the classes that share a bucket: 2 MB
SKETCH = 512
SKETCH_COLUMNS = [f"s{k}" for k in range(SKETCH // 64)]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Plan:
    """``bands`` of ``rows`` slots; at most 256 slots."""
    bands: int = 32
    rows: int = 4

    @property
    def slots(self) -> int:
        return self.bands * self.rows


PLAN = Plan()


def _lower(values: np.ndarray, owner: np.ndarray, elements: np.ndarray, sets: int, slots: int) -> None:
    """Lower ``values`` (sets x slots, flat) by the ranks of ``elements``."""
    order = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(elements), slots)).copy()
    rows = np.arange(len(elements))
    table = values.reshape(sets, slots)
    for j in range(slots):
        draw = mix(elements[rows] + np.uint64(j + 1) * _STEP)
        k = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        slot = order[rows, k]
        order[rows, k] = order[rows, j]                    # Fisher-Yates: slot j of the permutation is drawn
        rank = (np.uint64(j) << np.uint64(32)) | (draw >> np.uint64(32))
        np.minimum.at(values, owner[rows] * slots + slot, rank)
        open_sets = table.max(axis=1) >= np.uint64(j + 1) << np.uint64(32)
        rows = rows[open_sets[owner[rows]]]                # early stopping
        if not len(rows):
            return


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """The SuperMinHash signature of each set (rows of ``slots`` ranks)."""
    values = np.full(len(sets) * slots, _EMPTY)
    lengths = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(lengths)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(sets):
            size = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, size + ELEMENTS, side="right")))
            elements = np.concatenate(sets[at:to])
            owner = np.repeat(np.arange(to - at), lengths[at:to])
            view = values[at * slots:to * slots]
            # A single long set goes in pieces: its signature is the minimum over them.
            for piece in range(0, len(elements), ELEMENTS):
                _lower(view, owner[piece:piece + ELEMENTS], elements[piece:piece + ELEMENTS], to - at, slots)
            at = to
    return values.reshape(len(sets), slots)


def estimate(x: np.ndarray, y: np.ndarray) -> float:
    """Estimated Jaccard similarity of two signatures."""
    return float(np.mean(x == y))


def band_keys(table: np.ndarray, plan: Plan = PLAN) -> np.ndarray:
    """(sets x bands) 64-bit keys of the bands, the band number included."""
    parts = table.reshape(len(table), plan.bands, plan.rows)
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, plan.bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
        for r in range(plan.rows):
            acc = mix(acc * _STEP + parts[:, :, r])
    return acc


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """For each of 512 hash classes, whether the set holds an odd number of its
    tokens: a token in one of two sets only flips one bit."""
    return np.bincount((mix(tokens) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1


def band_index(source: DataFrame, plan: Plan = PLAN) -> DataFrame:
    """Rows of three kinds: ``doc`` (doc_id, n, cls) for every document, and for
    sets that can have a partner ``band`` (key, cls) and ``set`` (cls, n, sketch,
    tokens). A task leaves out sets it has already sent."""
    id_type = to_arrow_type(source.schema["doc_id"].dataType)
    names = ["kind", "doc_id", "key", "cls", "n", "tokens", *SKETCH_COLUMNS]
    types = [pa.string(), id_type, pa.int64(), pa.binary(), pa.int64(), pa.binary()] + [pa.int64()] * len(SKETCH_COLUMNS)

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(rows, t) for c, t in zip(names, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sent = WordHashes(), set()
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                sizes, classes, new = [], [], []
                for text in byte_list(batch.column(1).slice(at, GROUP)):
                    n, name, tokens = set_of(text, hashes)
                    sizes.append(n)
                    classes.append(name)
                    if n >= LEAST and name not in sent:
                        new.append((name, n, tokens))
                        if len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add(name)
                yield batch_of(len(sizes), kind=pa.array(["doc"] * len(sizes)), doc_id=batch.column(0).slice(at, GROUP),
                               cls=pa.array(classes, pa.binary()), n=pa.array(sizes, pa.int64()))
                if not new:
                    continue
                keys = band_keys(signatures([s[2] for s in new], plan.slots), plan)
                owner = pa.DictionaryArray.from_arrays(
                    pa.array(np.repeat(np.arange(len(new), dtype=np.int32), plan.bands)),
                    pa.array([s[0] for s in new], pa.binary())).cast(pa.binary())
                yield batch_of(keys.size, kind=pa.array(["band"] * keys.size), cls=owner,
                               key=pa.array(keys.reshape(-1).view(np.int64)))
                words = np.packbits(np.stack([_sketch(s[2]) for s in new]).astype(np.uint8), axis=1).view(np.int64)
                yield batch_of(len(new), kind=pa.array(["set"] * len(new)), cls=pa.array([s[0] for s in new], pa.binary()),
                               n=pa.array([s[1] for s in new], pa.int64()),
                               tokens=pa.array([pack(s[2]) for s in new], pa.binary()),
                               **{c: pa.array(np.ascontiguousarray(words[:, i])) for i, c in enumerate(SKETCH_COLUMNS)})

    return source.mapInArrow(lean(run), f"kind string, doc_id {source.schema['doc_id'].dataType.simpleString()}, key bigint, "
                                  "cls binary, n bigint, tokens binary, " + ", ".join(f"{c} bigint" for c in SKETCH_COLUMNS))


def _may_link(a: str, b: str) -> Column:
    """Length filter and parity sketch: linked sets differ in at most
    3/37 (|a| + |b|) elements."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SKETCH_COLUMNS), F.lit(0))
    return (NUM * F.greatest(na, nb) <= DEN * F.least(na, nb)) & (
        (NUM + DEN) * apart <= (DEN - NUM) * (na + nb))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the threshold."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        last, x, keep = None, None, []
        firsts = batch.column(0).to_pylist()
        for i in range(batch.num_rows):
            if firsts[i] != last:
                last, x = firsts[i], unpack(batch.column(2)[i].as_py())
            y = unpack(batch.column(3)[i].as_py())
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            if DEN * common >= NUM * (len(both) - common):
                keep.append(i)
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return map_batches(joined, fn, "a binary, b binary")


def forest(links: DataFrame) -> DataFrame:
    """The links that union-find needs, of those that a task sees: a link whose
    ends are joined already goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:                        # path compression
                parent[x], x = top, parent[x]
            return top

        for batch in batches:
            keep = []
            for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if len(parent) >= FOREST:
                    parent.clear()                         # keeps more links than needed, loses none
                ra, rb = find(a), find(b)
                if ra != rb:
                    parent[max(ra, rb)] = min(ra, rb)
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    return links.select("a", "b").mapInArrow(lean(run), "a binary, b binary")


def shared_buckets(bands: DataFrame) -> DataFrame:
    """(key, cls, weight) of the buckets that hold more than one class; the
    weight of a class is the number of its neighbours over all its buckets."""
    distinct = bands.select("key", "cls").distinct()
    full = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = shared_table(distinct.join(full, "key"), "buckets")
    weights = shared.groupBy("cls").agg(F.sum("size").alias("weight"))
    return shared_table(shared.drop("size").join(weights, "cls"), "weighted-buckets")


def _leader_pairs(buckets: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b): each class of a bucket with the bucket's leader, if they may link."""
    leader = buckets.groupBy("key").agg(F.max(F.struct("weight", "cls")).alias("top")).select(
        "key", F.col("top.cls").alias("lead"))
    pairs = buckets.join(leader, "key").where("cls <> lead").select(
        F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b")).distinct()
    x, y = sketches.alias("x"), sketches.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.cls")).join(y, F.col("b") == F.col("y.cls")).where(
        _may_link("x", "y")).select("a", "b")


def _open_buckets(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """The buckets that hold several groups, with ``component`` and ``first``,
    the group of the bucket's leader."""
    labels = components(forest(links)).select(F.col("node").alias("cls"), "component")
    tagged = buckets.select("key", "cls", "weight").join(labels, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    lists = tagged.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.max(F.struct("weight", "cls", "component")).alias("top")).where("lo <> hi")
    return shared_table(tagged.join(lists.select("key", F.col("top.component").alias("first")), "key"), "open-buckets")


def class_links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) verified links of classes that span the same groups as all links."""
    sketches = sets.select("cls", "n", *SKETCH_COLUMNS)
    links = tried = None
    current = opened = buckets
    for _ in range(LEADER_ROUNDS):
        pairs = _leader_pairs(current, sketches)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = cut_lineage(pairs)
        found = cut_lineage(verify(pairs, sets))
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        opened = _open_buckets(opened, links)
        current = opened.where(F.col("component") != F.col("first"))
    marked = shared_table(opened.select("key", "cls", "component").join(sketches, "cls"), "marked-buckets")
    left, right = marked.alias("x"), marked.alias("y")
    crossing = left.join(right, (F.col("x.key") == F.col("y.key")) & (
        F.col("x.component") < F.col("y.component")) & _may_link("x", "y")).select(
        F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()
    rest = cut_lineage(crossing.join(tried, ["a", "b"], "left_anti"))
    return links.unionByName(verify(rest, sets))


def probable(sets: DataFrame, wanted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``sets`` whose class may be among ``wanted`` (cls): a bit array
    of ``2**bits`` bits, joined as a table of 64-bit words. It holds at most
    ``2**(bits - 6)`` rows, so it is broadcast whatever the input; what it lets
    through falsely the exact join behind it drops."""
    at = F.pmod(F.xxhash64("cls"), F.lit(1 << bits))
    words = wanted.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    marked = sets.withColumn("at", at).withColumn("word", F.expr("at div 64"))
    return marked.join(F.broadcast(words), "word").where(
        F.expr("shiftrightunsigned(bits, cast(at % 64 as int)) & 1") == 1).drop("at", "word", "bits")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: Plan = PLAN) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: component_id is the
    smallest id reachable over links of Jaccard 0.85 or more; ``kept`` marks the
    row that bears it."""
    if not 1 <= plan.slots <= 256:
        raise ValueError("a signature has 1 to 256 slots")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    index = shared_table(band_index(source, plan), "band-index", ["kind"])
    buckets = shared_buckets(index.where("kind = 'band'"))
    wanted = cut_lineage(buckets.select("cls").distinct())
    sets = shared_table(
        probable(index.where("kind = 'set'"), wanted).join(wanted, "cls", "left_semi").groupBy("cls").agg(
            *[F.max(c).alias(c) for c in ("n", *SKETCH_COLUMNS, "tokens")]), "band-sets")
    labels = components(forest(class_links(buckets, sets)))
    members = index.where("kind = 'doc'").select("doc_id", "n", "cls")
    classes = members.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("least_id"))
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = cut_lineage(named.join(least, "component").select("cls", "component_id"))
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return members.join(ids, "cls", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def op13_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


OP13_SQL = r"""
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
          WHERE 100 * common >= 85 * (nx.n + ny.n - common)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents
          UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.seen)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON c.node = d.doc_id
"""
