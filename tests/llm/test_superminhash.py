"""SuperMinHash: the signature against the definition, grouping against all pairs."""

import numpy as np
import pytest

from tests.llm.conftest import prose
from tests.llm.test_ngram_join import families, order, shingles
from vigil.llm import superminhash as sm


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
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    found = [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return [(*r, r[0] == r[2]) for r in found]


def one_element_at_a_time(elements, slots):
    """The signature by its definition: a whole permutation of each element."""
    best = [2**64 - 1] * slots
    for e in elements.tolist():
        order = list(range(slots))
        for j in range(slots):
            with np.errstate(over="ignore"):
                draw = int(sm.mix(np.array([e], np.uint64) + np.uint64(j + 1) * sm._STEP)[0])
            k = j + ((draw & 0xFFFFFFFF) * (slots - j) >> 32)
            order[j], order[k] = order[k], order[j]
            best[order[j]] = min(best[order[j]], (j << 32) | (draw >> 32))
    return best


def test_signature_with_early_stopping_equals_the_definition(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**48, n).astype(np.uint64) for n in (1, 2, 5, 40, 300, 7)]
    want = [one_element_at_a_time(s, 32) for s in sets]
    assert sm.signatures(sets, 32).tolist() == want
    monkeypatch.setattr(sm, "ELEMENTS", 16)                # sets in pieces
    assert sm.signatures(sets, 32).tolist() == want


def test_estimate_is_unbiased_and_varies_less_than_independent_minima():
    rng = np.random.default_rng(1)
    slots, got = 64, []
    for _ in range(400):
        pool = rng.integers(0, 2**48, 30).astype(np.uint64)
        x, y = sm.signatures([pool[:24], pool[6:]], slots)  # 18 of 30 in common
        got.append(sm.estimate(x, y))
    assert abs(np.mean(got) - 0.6) < 0.02
    assert np.var(got) < 0.8 * 0.6 * 0.4 / slots


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_all_pairs(spark, seed):
    rows = families(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted(map(tuple, sm.near_duplicates(df).collect()), key=order)
    assert got == sorted(brute(rows), key=order)


def test_a_family_of_edits_equals_all_pairs(spark):
    """Many edits of one text, most of them below the threshold to each other."""
    import random
    rng = random.Random(4)
    base = prose(77, 100).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            words[rng.randrange(100)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(map(tuple, sm.near_duplicates(df).collect()), key=order) == sorted(brute(rows), key=order)


def test_forest_spans_the_same_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = [(bytes([int(a)]), bytes([int(b)])) for a, b in rng.integers(0, 60, (200, 2)) if a != b]
    df = spark.createDataFrame(edges, "a binary, b binary").coalesce(1)
    kept = sm.forest(df).count()
    nodes = {x for e in edges for x in e}
    groups = {bytes(r["component"]) for r in sm.components(df).collect()}
    assert kept == len(nodes) - len(groups)
    monkeypatch.setattr(sm, "FOREST", 10)
    assert {tuple(map(bytes, r)) for r in sm.components(sm.forest(df)).collect()} == \
        {tuple(map(bytes, r)) for r in sm.components(df).collect()}


def test_op13_on_tricky_rows(tricky, clashing, rows):
    want = sorted(brute([(d, t) for d, t, *_ in rows]), key=order)
    for df in (tricky, clashing):
        assert sorted(map(tuple, sm.op13_query(df).collect()), key=order) == want


def test_op13_empty_table(none):
    assert sm.op13_query(none).count() == 0


def test_plan_of_one_byte_slots():
    with pytest.raises(ValueError):
        sm.near_duplicates(None, plan=sm.Plan(65, 4))
