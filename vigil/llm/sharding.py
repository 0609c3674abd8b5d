"""Sharding by balanced label propagation.

Documents that share a link key (here: equal texts) should meet in one shard
while every shard holds the same number of rows.

1. *Coarsen.* Linked documents of one key are gathered into at most
   ``pieces`` nodes (a hash of the id splits them), so a key that holds a third
   of all rows becomes a bounded number of movable nodes and no later step
   handles its rows one by one.
2. *Propagate.* A key's nodes start in neighbouring shards, one more than its
   rows fill, so its votes and the shards' room choose between them. Each round
   joins the nodes with their keys' votes per shard. A key that fits a shard votes for the shard that holds most of it; a larger
   key votes for as many shards as it needs, and its nodes are dealt over
   those by hash. A node asks to move to the shard with the most linked rows,
   other than its own rows. Requests to a shard are granted by falling gain up
   to the shard's quota, and beyond it as exchanges between two shards: a
   histogram over (shards, gain class, hash class), whose size does not grow
   with the data, gives the cut. Rounds end when nothing moves, or after
   ``rounds``.
3. *Place.* The documents of a shard that exceed its quota, and all unlinked
   documents, are dealt out over the shards' remaining places by rank, so the
   row counts differ by at most one. Ranks are per (shard, hash class) row
   numbers plus offsets, never one global sort.

``cut_edges`` reports the links that remain cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import group_offsets, hash_bucket
from vigil.session import cut_lineage

RANK_BUCKETS = 1024            # classes of a rank: rows of one sort = rows / shards / classes
RANK_SPLIT = 8                 # classes within a class of keys
SLACK = 8                      # a shard may run over by this part of its quota until the ranks cut it
GAIN_HASHES = 64


def coarsen(members: DataFrame, pieces: int) -> DataFrame:
    """``members`` (key, piece) of linked documents -> nodes (key, piece, w)."""
    return members.groupBy("key", "piece").agg(F.count(F.lit(1)).alias("w"))


def _votes(links: DataFrame, loads: DataFrame, capacity: int) -> DataFrame:
    """Per key: its shards, those with room first, by falling rows (ties by a
    hash of key and shard), and how many of them the key needs; at most one
    entry per shard."""
    held = links.groupBy("key", "shard").agg(F.sum("w").alias("held")).join(
        F.broadcast(loads), F.col("shard") == loads["load_shard"], "left")
    full = F.coalesce("load", F.lit(0)) >= F.lit(capacity)
    entry = F.struct(full.alias("full"), (-F.col("held")).alias("less"), F.xxhash64("key", "shard").alias("tie"), "shard")
    per_key = held.groupBy("key").agg(F.array_sort(F.collect_list(entry)).alias("shards"),
                                      F.sum("held").alias("total"))
    needed = F.least(F.size("shards"), F.ceil(F.col("total") / F.lit(capacity)).cast("int"))
    return per_key.select("key", "shards", needed.alias("needed"))


def _requests(nodes: DataFrame, links: DataFrame, votes: DataFrame) -> DataFrame:
    """(node, w, shard, to, gain): the best shard of every node that gains."""
    j = links.join(votes, "key")
    pick = F.get("shards", F.pmod(F.xxhash64("node"), F.col("needed")).cast("int"))
    home = F.slice("shards", 1, F.col("needed"))
    settled = F.exists(home, lambda s: s["shard"] == F.col("shard"))
    here = F.aggregate(F.filter("shards", lambda s: s["shard"] == F.col("shard")),
                       F.lit(0).cast("bigint"), lambda a, s: a - s["less"]) - F.col("w")
    wish = F.when(settled, F.col("shard")).otherwise(pick["shard"])
    there = F.when(settled, here).otherwise(-pick["less"])
    asked = j.select("node", "w", "shard", F.explode(F.array(
        F.struct(F.col("shard").alias("to"), here.alias("links")),
        F.struct(wish.alias("to"), F.when(wish == F.col("shard"), F.lit(0).cast("bigint"))
                 .otherwise(there).alias("links")))).alias("o"))
    per_shard = asked.groupBy("node", "w", "shard", F.col("o.to").alias("to")).agg(
        F.sum("o.links").alias("links"))
    best = per_shard.groupBy("node", "w", "shard").agg(
        F.max(F.when(F.col("to") != F.col("shard"),
                     F.struct("links", F.xxhash64("node", "to").alias("tie"), "to"))).alias("other"),
        F.max(F.when(F.col("to") == F.col("shard"), F.col("links"))).alias("own"))
    gain = F.col("other.links") - F.coalesce("own", F.lit(0))
    return best.where(F.col("other").isNotNull() & (gain > 0)).select(
        "node", "w", "shard", F.col("other.to").alias("to"), gain.alias("gain"))


def _upto(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Running sums of requested rows per ``keys``, by falling gain class, then
    hash class: shards x shards x 64 x GAIN_HASHES rows at most."""
    within = Window.partitionBy(*keys).orderBy(F.desc("grade"), "lot").rowsBetween(
        Window.unboundedPreceding, 0)
    return rows.groupBy(*keys, "grade", "lot").agg(F.sum("w").alias("asks")).withColumn(
        "upto", F.sum("asks").over(within))


def _granted(requests: DataFrame, loads: DataFrame, capacity: int) -> DataFrame:
    """Requests that fit in free places, then exchanges: between two shards as
    many rows move one way as the other, which changes no load."""
    graded = cut_lineage(requests.withColumn("grade", F.floor(F.log2(F.col("gain"))).cast("int")).withColumn(
        "lot", hash_bucket([F.col("node"), F.lit("lot")], GAIN_HASHES)))
    fits = _upto(graded, ["to"]).join(
        F.broadcast(loads), F.col("to") == loads["load_shard"], "left").where(
        F.col("upto") + F.coalesce("load", F.lit(0)) <= F.lit(capacity)).select("to", "grade", "lot")
    rest = graded.join(F.broadcast(fits), ["to", "grade", "lot"], "left_anti")
    asked = rest.groupBy("shard", "to").agg(F.sum("w").alias("there"))
    back = asked.select(F.col("shard").alias("to"), F.col("to").alias("shard"), F.col("there").alias("back"))
    swaps = _upto(rest, ["shard", "to"]).join(F.broadcast(asked.join(back, ["shard", "to"])), ["shard", "to"]).where(
        F.col("upto") <= F.least("there", "back")).select("shard", "to", "grade", "lot")
    return graded.join(F.broadcast(fits), ["to", "grade", "lot"]).select("node", F.col("to").alias("new_shard")).unionByName(
        rest.join(F.broadcast(swaps), ["shard", "to", "grade", "lot"]).select("node", F.col("to").alias("new_shard")))


def propagate(nodes: DataFrame, links: DataFrame, capacity: int, rounds: int) -> DataFrame:
    """``nodes`` (node, w, shard) and ``links`` (node, key) -> nodes with the
    shard they end in. No shard is granted rows beyond ``capacity``."""
    state = cut_lineage(nodes)
    for _ in range(rounds):
        linked = links.join(state, "node")
        loads = state.groupBy(F.col("shard").alias("load_shard")).agg(F.sum("w").alias("load"))
        wishes = _requests(state, linked, _votes(linked, loads, capacity))
        moves = cut_lineage(_granted(wishes, loads, capacity))
        if moves.isEmpty():
            break
        state = cut_lineage(state.join(moves, "node", "left").select(
            "node", "w", F.coalesce("new_shard", "shard").alias("shard")))
    return state


def _ranked(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """0-based rank within ``by``, by (hash class of the first column, hash class
    of all, ``order``): equal first columns stand close together, and a hot one is
    still ranked by ``RANK_SPLIT`` tasks."""
    group = hash_bucket([F.col(order[0])], RANK_BUCKETS // RANK_SPLIT)
    bucketed = df.withColumn("_bucket", group * RANK_SPLIT + hash_bucket([F.col(c) for c in order], RANK_SPLIT))
    offsets = group_offsets(bucketed, by, "_bucket", {"_before": F.lit(1)})
    inner = Window.partitionBy(*by, "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    # One offset row per (group, class): shards x RANK_BUCKETS rows at most.
    return bucketed.withColumn("_inner", F.row_number().over(inner) - 1).join(
        F.broadcast(offsets), [*by, "_bucket"]).withColumn(
        name, F.col("_before") + F.col("_inner")).drop("_bucket", "_inner", "_before")


def balanced_shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", key_col: str = "key",
                    rounds: int = 8, pieces_per_shard: int = 8) -> DataFrame:
    """``docs`` (id, key, other columns) -> the same rows with ``shard`` and
    ``slot`` (gapless from 0 in each shard); rows per shard differ by at most
    one. Rows with equal keys are linked; a null key links nothing. Ids may be
    null or repeated: each row gets a place of its own."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    pieces = n_shards * pieces_per_shard
    # The rows' own columns travel in a struct, so no name can clash.
    base = cut_lineage(docs.select(F.col(id_col).alias("_id"), F.col(key_col).alias("_key"),
                                   F.struct(*[F.col(c) for c in docs.columns]).alias("_row")).withColumn(
        "_piece", hash_bucket([F.col("_id"), F.col("_key")], pieces)))
    per_key = base.where(F.col("_key").isNotNull()).groupBy(
        F.col("_key").alias("key"), F.col("_piece").alias("piece")).agg(F.count(F.lit(1)).alias("w"))
    total = base.count()
    quota = total // n_shards
    capacity = max(quota, 1)
    linked_keys = per_key.groupBy("key").agg(F.sum("w").alias("rows"))
    # A key whose rows are one node is already together, but still has to be
    # moved as a whole, so every key of two rows or more takes part.
    # Nodes of a key start in one shard more than its rows fill, side by side;
    # in which of them they meet is decided by their votes and the shards' room.
    spread = F.least(F.lit(n_shards), F.ceil(F.col("rows") / F.lit(capacity)) + 1)
    start = hash_bucket([F.col("key")], n_shards) + F.pmod(F.col("piece"), spread)
    cells = per_key.join(linked_keys.where("rows > 1"), "key").select(
        F.xxhash64("key", "piece").alias("node"), "key", "piece", "w",
        F.pmod(start, F.lit(n_shards)).cast("int").alias("shard"))
    cells = cut_lineage(cells)
    placed = propagate(cells.groupBy("node", "shard").agg(F.sum("w").alias("w")).select("node", "w", "shard"),
                       cells.select("node", "key"), capacity + max(1, capacity // SLACK), rounds)
    homes = cells.join(placed.select("node", F.col("shard").alias("home")), "node").select(
        F.col("key").alias("_home_key"), F.col("piece").alias("_home_piece"), "home")
    rows = cut_lineage(base.join(
        homes, (F.col("_key") == F.col("_home_key")) & (F.col("_piece") == F.col("_home_piece")),
        "left").drop("_home_key", "_home_piece", "_piece"))

    order = ["_key", "_id"]
    quotas = docs.sparkSession.range(n_shards).select(
        F.col("id").cast("int").alias("shard"),
        (F.lit(quota) + (F.col("id") < F.lit(total % n_shards)).cast("int")).alias("quota"))
    linked = _ranked(rows.where(F.col("home").isNotNull()), ["home"], order, "_rank")
    sized = cut_lineage(linked.join(F.broadcast(quotas), F.col("home") == quotas["shard"]).withColumn(
        "_stays", F.col("_rank") < F.col("quota")).drop("quota", "shard"))
    taken = sized.where("_stays").groupBy(F.col("home").alias("shard")).agg(F.count(F.lit(1)).alias("taken"))
    # One row per shard: the running sum below sorts n_shards rows.
    room = quotas.join(taken, "shard", "left").withColumn("taken", F.coalesce("taken", F.lit(0))) \
        .withColumn("upto", F.sum(F.col("quota") - F.col("taken")).over(
            Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("start", F.col("upto") - (F.col("quota") - F.col("taken"))) \
        .select("shard", "taken", "start", "upto")
    places = room.agg(F.array_sort(F.collect_list(F.struct("upto", "start", "taken", "shard"))).alias("places"))
    movers = sized.where(~F.col("_stays")).drop("_rank", "_stays").unionByName(
        rows.where(F.col("home").isNull()))
    ranked = _ranked(movers.withColumn("_all", F.lit(0)), ["_all"], order, "_rank").drop("_all")
    spot = F.get(F.filter("places", lambda p: p["upto"] > F.col("_rank")), F.lit(0))
    dealt = ranked.join(F.broadcast(places.withColumn("_all", F.lit(0))),
                        F.lit(0) == F.col("_all")).withColumn("_spot", spot)
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return sized.where("_stays").select(
        *own, F.col("home").alias("shard"), F.col("_rank").cast("bigint").alias("slot")).unionByName(
        dealt.select(*own, F.col("_spot.shard").alias("shard"),
                     (F.col("_spot.taken") + F.col("_rank") - F.col("_spot.start")).cast("bigint").alias("slot")))


def cut_edges(sharded: DataFrame, key_col: str = "key") -> DataFrame:
    """One row: linked pairs (rows of one key) in all, and those whose ends lie
    in different shards, counted from per-key totals without forming pairs."""
    cells = sharded.where(F.col(key_col).isNotNull()).groupBy(key_col, "shard").agg(
        F.count(F.lit(1)).alias("n"))
    per_key = cells.groupBy(key_col).agg(F.sum("n").alias("n"), F.sum(F.expr("n * (n - 1) div 2")).alias("same"))
    pairs = F.expr("n * (n - 1) div 2")
    return per_key.agg(F.coalesce(F.sum(pairs), F.lit(0)).alias("edges"),
                       F.coalesce(F.sum(pairs - F.col("same")), F.lit(0)).alias("cut"))


def op1_query(docs: DataFrame) -> DataFrame:
    """Equal texts are linked; a null text has no bytes (size 8, CRC 0) and no
    links."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("bigint").alias("size"),
                         F.crc32(body).alias("text_crc32"), F.md5(F.col("text").cast("binary")).alias("key"))
    return balanced_shards(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
