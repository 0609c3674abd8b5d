"""N-gram join against all pairs; components; order filters; pipeline."""

import random
import re

import numpy as np
import pytest

from tests.llm.conftest import prose
from vigil.llm import ngram_join as nj


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def families(seed):
    """Copies at every distance around the threshold, chains, shared passages."""
    rng = random.Random(seed)
    rows, passage = [], prose(900 + seed, 60)
    for f in range(8):
        words = prose(seed * 100 + f, rng.choice([6, 12, 30, 80, 150])).split()
        for _ in range(rng.randrange(1, 8)):
            rows.append(" ".join(words))
            if rng.random() < 0.7:
                at = rng.randrange(len(words))
                words = words[:at] + [f"w{rng.randrange(10**6)}"] + words[at + rng.randrange(2):]
    rows += [passage + " " + prose(5000 + seed * 50 + k, rng.choice([4, 10, 20, 60])) for k in range(30)]
    rows += ["", None, " \n", "one", "one", "ONE two", "one two", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def order(t):
    return (t[0] is None, t[0] or 0, t[1], str(t[2]))


@pytest.mark.parametrize("seed,hot", [(1, 64), (2, 3)])
def test_near_duplicates_equal_all_pairs(spark, seed, hot):
    rows = families(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted(map(tuple, nj.near_duplicates(df, bounds=nj.Bounds(hot_df=hot)).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


@pytest.mark.parametrize("region,hot_tokens", [(0, 1), (2**48, 4)])
def test_bounds_do_not_change_the_result(spark, region, hot_tokens):
    rows = families(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bounds = nj.Bounds(region=region, hot_tokens=hot_tokens, hot_df=2, filter_bits=8)
    got = sorted(map(tuple, nj.near_duplicates(df, bounds=bounds).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


def test_op10_on_tricky_rows(tricky, clashing, rows):
    want = sorted(brute([(d, t) for d, t, *_ in rows]), key=order)
    for df in (tricky, clashing):
        assert sorted(map(tuple, nj.op10_query(df).collect()), key=order) == want


def test_op10_empty_table(none):
    assert nj.op10_query(none).count() == 0


def test_prefixes_share_a_token_under_each_order():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        x = np.unique(rng.integers(0, 2**48, n).astype(np.uint64))
        keep = x[rng.random(len(x)) < 0.95]
        y = np.unique(np.concatenate([keep, rng.integers(0, 2**48, int(rng.integers(0, 4))).astype(np.uint64)]))
        if not len(y):
            continue
        inter = len(np.intersect1d(x, y))
        want = nj.DEN * inter >= nj.NUM * (len(x) + len(y) - inter)
        assert nj._linked(x, y) == want
        if want:
            empty = np.zeros(1 << (nj.BOUNDS.filter_bits - 6), np.uint64)
            full = ~empty
            assert len(np.intersect1d(nj._prefix(x, full, x[:3])[1], nj._prefix(y, full, x[:3])[1]))


def test_sketches_bound_the_difference(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**48, 200).astype(np.uint64))]
    for _ in range(30):
        keep = sets[-1][rng.random(len(sets[-1])) < 0.93]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**48, 12).astype(np.uint64)])))
    df = spark.createDataFrame([(bytes([i]), nj.pack(s)) for i, s in enumerate(sets)], "cls binary, tokens binary")
    bits = {r["cls"][0]: [r[c] for c in nj.SKETCH_COLUMNS] for r in nj.sketches(df).collect()}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            apart = sum(bin((a ^ b) & (2**64 - 1)).count("1") for a, b in zip(bits[i], bits[j]))
            assert apart <= len(np.setxor1d(x, y)) and (i != j or apart == 0)


def test_family_of_loose_copies(spark):
    """Edits of one text: the pairs around the threshold decide the components."""
    rng = random.Random(11)
    words = prose(77, 150).split()
    rows = []
    for k in range(120):
        own = list(words)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    got = sorted(map(tuple, nj.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


def test_pack_round_trip():
    x = np.unique(np.random.default_rng(1).integers(0, 2**48, 100).astype(np.uint64))
    assert (nj.unpack(nj.pack(x)) == x).all() and len(nj.pack(x)) == 6 * len(x)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200), (5, 5)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in nj.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_keep_one_of_each(spark, tricky, rows):
    out = nj.keep_one_of_each(tricky)
    assert out.columns == tricky.columns
    want = brute([(d, t) for d, t, *_ in rows])
    empties = sorted((d for d, n, _ in want if n == 0))
    kept = [r["doc_id"] for r in out.collect()]
    full = [d for d, n, c in want if n and (d == c or d is None)]
    assert sorted(kept, key=lambda d: (d is None, d or 0)) == sorted(
        list(dict.fromkeys(full)) + empties, key=lambda d: (d is None, d or 0))


def test_keep_one_carries_any_column_name_and_type(spark):
    from pyspark.sql import functions as F
    text = prose(31, 40)
    rows = [(1, text), (1, text), (2, text), (3, prose(32, 40)), (3, prose(33, 40)), (None, prose(34, 30)), (4, ""), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit("x") for c in ("_id", "_hash", "_row", "_row_hash", "_nth", "_key", "_text", "_at", "_word", "_one", "_sid", "row")}
    ).withColumn("tags", F.create_map(F.lit("a"), F.lit(1)))
    out = nj.keep_one_of_each(df)
    assert out.columns == df.columns
    got = out.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in got) == sorted(
        (d is None, d or 0, t or "") for d, t in [(1, text), *rows[3:]])
    assert all(r["_nth"] == "x" and r["tags"] == {"a": 1} for r in got)
