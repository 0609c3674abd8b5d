"""Sharding and mixing: laws, cohesion, edge cases, oracle-independent brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from vigil.llm import mixing, sharding


def check_shards(out, n_shards):
    sizes = Counter(r["shard"] for r in out)
    full = [sizes.get(s, 0) for s in range(n_shards)]
    assert max(full) - min(full) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_op1_on_tricky_rows(tricky, clashing, rows):
    out = sharding.op1_query(tricky).collect()
    assert len(out) == len(rows)
    check_shards(out, 24)
    for r in out:
        texts = [t for d, t, *_ in rows if d == r["doc_id"]]
        assert (r["size"], r["text_crc32"]) in {
            (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts}
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert sorted(map(str, sharding.op1_query(clashing).collect())) == sorted(map(str, out))


def test_op1_empty_table(none):
    assert sharding.op1_query(none).count() == 0


@pytest.mark.parametrize("n_shards", [1, 5])
def test_groups_meet_and_a_hot_group_takes_few_shards(spark, n_shards):
    rows = [(i, f"g{i // 4}") for i in range(400)] + [(1000 + i, "hot") for i in range(300)] + \
        [(2000 + i, None) for i in range(211)]
    df = spark.createDataFrame(rows, "doc_id bigint, key string")
    out = sharding.balanced_shards(df, n_shards).collect()
    assert len(out) == len(rows)
    check_shards(out, n_shards)
    homes = defaultdict(set)
    for r in out:
        if r["key"] is not None:
            homes[r["key"]].add(r["shard"])
    small = [len(s) for k, s in homes.items() if k != "hot"]
    # Four rows in five shards start apart in 99 of 100 groups.
    assert sum(n > 1 for n in small) <= 0.4 * len(small)
    assert len(homes["hot"]) <= math.ceil(300 / (len(rows) / n_shards)) + 1
    cut = sharding.cut_edges(spark.createDataFrame(out)).first()
    pairs = [(a["shard"] != b["shard"]) for i, a in enumerate(out) for b in out[:i]
             if a["key"] is not None and a["key"] == b["key"]]
    assert (cut["edges"], cut["cut"]) == (len(pairs), sum(pairs))


@pytest.mark.parametrize("groups,size,most", [(200, 10, 0.10), (50, 40, 0.35)])
def test_groups_that_nearly_pack_stay_together(spark, groups, size, most):
    df = spark.createDataFrame([(g * size + i, f"k{g}") for g in range(groups) for i in range(size)], "doc_id bigint, key string")
    out = sharding.balanced_shards(df, 24)
    check_shards(out.collect(), 24)
    cut = sharding.cut_edges(out).first()
    assert cut["edges"] == groups * size * (size - 1) // 2 and cut["cut"] <= most * cut["edges"]


def test_all_rows_linked_still_balances(spark):
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(350)], "doc_id bigint, key string")
    out = sharding.balanced_shards(df, 6).collect()
    check_shards(out, 6)


def brute_mix(rows):
    """Targets by repeated capping, then systematic sampling, in plain Python."""
    import hashlib

    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _, s, _ in rows]
    sizes = Counter()
    for _, s, n in sized:
        sizes[s] += n
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rate = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    target = {s: min(weight[s] * rate, 3.0 * sizes[s]) for s in names}
    taken = []
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    for s in names:
        own = sorted((n, md5(f"{mixing.SEED}|{'' if d is None else d}"), d) for d, q, n in sized if q == s)
        at = int(md5(f"{mixing.SEED}|" + ("n" if s is None else "s" + s))[:6], 16)
        e = math.floor((target[s] / sizes[s] if sizes[s] else 0.0) * mixing.UNIT)
        for n, _, d in own:
            taken.append((d, n, sizes[s], target[s], ((at + e) // mixing.UNIT - at // mixing.UNIT) * n))
            at += e
    return taken


def key(row):
    return tuple((x is None, x) for x in row)


def test_op7_equals_brute_force(tricky, clashing, rows):
    want = sorted(brute_mix(rows), key=key)
    for df in (tricky, clashing):
        got = sorted((tuple(r) for r in mixing.op7_query(df).collect()), key=key)
        assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
        assert all(math.isclose(g[3], w[3], rel_tol=1e-12) for g, w in zip(got, want))


def test_op7_reruns_agree_and_reach_targets(spark):
    rows = [(i, ("w " * (1 + i * 7 % 50)), "en", "s%d" % (i % 5), 0) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    first = mixing.op7_query(df).orderBy("doc_id").collect()
    assert first == mixing.op7_query(df.repartition(7)).orderBy("doc_id").collect()
    assert all(r["taken"] <= 3 * r["size"] for r in first)
    source = {i: s for i, _, _, s, _ in rows}
    taken, target = Counter(), {}
    for r in first:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 100


def test_op7_empty_and_wordless(none, spark):
    assert mixing.op7_query(none).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id bigint, text string, source string")
    assert {(r["target"], r["taken"]) for r in mixing.op7_query(blank).collect()} == {(0.0, 0)}


def test_mix_documents_repeats_rows(tricky):
    mixed = mixing.mix_documents(tricky)
    assert mixed.columns == tricky.columns
    want = Counter()
    for r in mixing.op7_query(tricky).where(F.col("size") > 0).collect():
        want[r["doc_id"]] += r["taken"]
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert set(got) <= set(want) | {4, 5, 6}
    assert abs(sum(got.values()) - sum(want.values())) <= 0.2 * sum(want.values())


def test_mix_documents_takes_the_systematic_share(spark, tricky):
    """Each distinct row is taken as often as its expected copies, rounded down
    or up, and a source's copies add up exactly; names of the function's own
    columns and a map column do not clash."""
    names = ("_id", "_hash", "_nth", "_copy", "_copies", "_key", "_src", "_size", "_row", "_n", "_mid", "_mhash",
             "_mrest", "_entry", "id", "hash", "rest", "col", "source_size", "target", "_units", "_upto")
    hot = spark.createDataFrame([(500, prose(77, 60), "en", "hot", 1)] * 25 + [(500, prose(77, 60), "en", "a", 1)] * 3, tricky.schema)
    docs = tricky.unionByName(hot).withColumns({c: F.lit(c) for c in names}).withColumn(
        "tags", F.create_map(F.lit("k"), F.col("lang")))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    out = mixed.collect()
    assert {r[c] for r in out for c in names} == set(names)
    rows = [tuple(r[:5]) for r in docs.collect()]
    own, got = Counter(rows), Counter(tuple(r[:5]) for r in out)
    assert set(got) <= set(own)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    targets = {(size, t) for *_, size, t, _ in brute_mix(rows)}
    for source, size in sizes.items():
        (target,) = {t for n, t in targets if n == size}
        e = math.floor((target / size if size else 0.0) * mixing.UNIT)
        offset = int(hashlib.md5((f"{mixing.SEED}|" + ("n" if source is None else "s" + source)).encode()).hexdigest()[:6], 16)
        mine = {r: k for r, k in own.items() if r[3] == source}
        assert sum(got[r] for r in mine) == (offset + e * sum(mine.values())) // mixing.UNIT
        for r, k in mine.items():
            assert e * k // mixing.UNIT <= got[r] <= -(-e * k // mixing.UNIT)
