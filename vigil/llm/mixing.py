"""Mixing sources to target weights by systematic sampling.

A source's target is its share of all words, at most ``max_repeat`` times its
own words; what a capped source cannot take is shared again by weight. Each
document of a source is expected ``target / source words`` times. The expected
copies are prefix-summed within the source in order of document size, one
random offset per source is added, and a document is emitted once for every
integer boundary its interval crosses. Ordering by size makes the sample follow
the source's size distribution, so the words taken land within about one
document of the target.

Expected copies are integers of ``1 / UNIT`` copy, so prefix sums are exact and
reruns agree. Null texts have size 0, a null source is a source of its own
(last in order). An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import WORD
from vigil.operators.sequence import prefix_sums, sequence_number
from vigil.session import cut_lineage

WEIGHTS = (5, 2, 1)            # fixed values of the contract
MAX_REPEAT = 3
UNIT = 1 << 24                 # one copy in the integer prefix sums
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _source_tag(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _id_string(rows: DataFrame) -> Column:
    """The id as text, for the tie order: a struct by its fields."""
    text = F.to_json("_id") if rows.schema["_id"].dataType.typeName() == "struct" else F.col("_id").cast("string")
    return F.coalesce(text, F.lit(""))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sizes`` (source, source_size) -> with weight and target. Capping is
    repeated until no target is above its cap; each pass is one aggregate over
    the source table that returns two sums."""
    ranked = sequence_number(
        sizes.withColumn("_null", F.col("source").isNull()).withColumn("_k", F.coalesce("source", F.lit(""))),
        ["_null", "_k"], name="_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = cut_lineage(ranked.select("source", "source_size", weight.cast("bigint").alias("weight")))
    cap = F.lit(max_repeat) * F.col("source_size")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    rate, capped = None, F.lit(False)
    while True:
        sums = table.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
            F.count(F.when(capped, 1))).first()
        if not sums[1]:
            break
        new_rate = float(total - sums[0]) / float(sums[1])
        if rate is not None and new_rate == rate:
            break
        rate = new_rate
        capped = F.col("weight") * F.lit(rate) > cap
    level = F.lit(rate if rate is not None else 0.0)
    return table.withColumn("target", F.least(F.col("weight") * level, cap.cast("double")))


def systematic_sample(docs: DataFrame, expected: Column, source_col: str, order: list[str],
                      seed: str = SEED, rows: Column | None = None) -> DataFrame:
    """Adds ``copies``: how many integer boundaries the document's interval of
    expected copies crosses. ``expected`` is in copies; ``order`` must order a
    source's rows totally, up to rows that are equal. A row that stands for
    ``rows`` equal ones takes the intervals of all of them."""
    offset = F.conv(F.substring(F.md5(F.concat(
        F.lit(seed + "|"), _source_tag(F.col(source_col))).cast("binary")), 1, 6), 16, 10).cast("bigint")
    units = F.floor(expected * F.lit(float(UNIT))).cast("bigint")
    if rows is not None:
        units = units * rows
    summed = prefix_sums(docs.withColumn("_units", units), order, {"_upto": F.col("_units")}, by=[source_col])
    boundary = lambda x: F.floor(x / F.lit(UNIT))
    whole = F.expr(f"(_upto + _offset) div {UNIT} - (_upto - _units + _offset) div {UNIT}")
    return summed.withColumn("_offset", offset).withColumn("copies", whole.cast("bigint")).drop(
        "_units", "_upto", "_offset")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
                weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
                rows_col: str | None = None) -> DataFrame:
    """``docs`` (id, source, size) -> with source_size, target and copies.
    ``rows_col`` says how many equal rows a row stands for; ``copies`` is then
    what all of them are taken."""
    rows = cut_lineage(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                                   F.col(size_col).cast("bigint").alias("size"),
                                   (F.col(rows_col) if rows_col else F.lit(1)).cast("bigint").alias("_rows")))
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_rows")).alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    # One row per source on the right; a hot source is split by the skew join.
    joined = rows.join(targets.withColumnRenamed("source", "_source"),
                       F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    tie = F.md5(F.concat(F.lit(seed + "|"), _id_string(rows)).cast("binary"))
    return systematic_sample(joined.withColumn("_tie", tie), expected, "source", ["size", "_tie"], seed,
                             F.col("_rows") if rows_col else None).select(
        F.col("_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (rows that
    it does not take go). Equal rows are one entry of the sample, with the
    copies of all of them. Rows travel as structs, so no name clashes."""
    rest = [F.col(c) for c in docs.columns if c not in (id_col, text_col)]
    keyed = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
                 F.md5(F.to_json(F.struct(*rest or [F.lit(0)])).cast("binary")).alias("rest")).alias("_key"),
        F.col(source_col).alias("_src"), word_count(F.col(text_col)).alias("_size"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    entries = keyed.groupBy("_key", "_src", "_size").agg(F.count(F.lit(1)).alias("_n"))
    mixed = mix_sources(entries.select(F.struct("_key", "_n").alias("_entry"), "_src", "_size", "_n"),
                        "_entry", "_src", "_size", rows_col="_n", **options).where("copies > 0").select(
        F.col("_entry._key.id").alias("_mid"), F.col("_entry._key.hash").alias("_mhash"), F.col("_entry._key.rest").alias("_mrest"),
        F.col("_entry._n").alias("_n"), F.col("copies").alias("_copies"))
    met = keyed.select("_key", "_row").join(
        mixed, F.col("_key.id").eqNullSafe(F.col("_mid")) & (F.col("_key.hash") == F.col("_mhash"))
        & (F.col("_key.rest") == F.col("_mrest")))
    # Equal rows meet task by task first; one of them carries the copies.
    ones = met.where("_n > 1").groupBy("_key", "_copies").agg(F.any_value("_row").alias("_row"))
    taken = met.where("_n = 1").select("_row", "_copies").unionByName(ones.select("_row", "_copies"))
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select("_row.*")


def op7_query(docs: DataFrame) -> DataFrame:
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix_sources(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP7_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
         ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{', '.join(map(str, WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}]::BIGINT AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source) AS k,
         coalesce(sum({MAX_REPEAT} * source_size) OVER w, 0) AS capped_before,
         (SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER w, 0) AS weight_left,
         (SELECT sum(source_size) FROM sources) AS total
  FROM sources
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rates AS (
  SELECT *, (total - capped_before)::DOUBLE / weight_left::DOUBLE AS rate FROM ordered),
level AS (
  SELECT rate FROM rates WHERE weight * rate <= {MAX_REPEAT} * source_size ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, coalesce(least(weight * (SELECT rate FROM level), ({MAX_REPEAT} * source_size)::DOUBLE), 0) AS target
  FROM sources),
units AS (
  SELECT doc_id, size, source_size, target, t.source,
         floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * {float(UNIT)})::BIGINT AS e,
         md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS tie,
         ('0x' || substr(md5('{SEED}|' || CASE WHEN t.source IS NULL THEN 'n' ELSE 's' || t.source END), 1, 6))::BIGINT AS o
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
summed AS (
  SELECT *, (sum(e) OVER (PARTITION BY source ORDER BY size, tie ROWS UNBOUNDED PRECEDING))::BIGINT AS upto FROM units)
SELECT doc_id, size, source_size, target,
       (((upto + o) // {UNIT} - (upto - e + o) // {UNIT}) * size)::BIGINT AS taken
FROM summed
"""
