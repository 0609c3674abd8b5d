"""Periodic runs against a scan of every lag, on texts made to be hard."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from vigil.llm import periodic


def brute_runs(words):
    """Every maximal stretch at every lag; of equal stretches the smallest lag."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(kept)))


def hard_texts(seed, n=60):
    """Repeats of every period, nested, adjacent, interrupted, over few words."""
    rng = random.Random(seed)
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(5)
            letters = [f"v{k}" for k in range(rng.choice([1, 2, 3, 8, 40]))]
            unit = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 33, 40, 70, 130]))]
            if kind == 0:
                words += [rng.choice(letters) for _ in range(rng.randrange(1, 200))]
            elif kind == 1:
                words += unit * rng.randrange(2, 7) + unit[:rng.randrange(len(unit) + 1)]
            elif kind == 2:
                words += (unit * 3 + ["x"]) * 3
            elif kind == 3:
                block = unit * rng.randrange(2, 5)
                block[rng.randrange(len(block))] = "odd"
                words += block * rng.randrange(1, 5)
            else:
                words += prose(rng.randrange(1000), 60).split()
        yield words


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_a_scan_of_every_lag(seed):
    for words in hard_texts(seed):
        words = [w.encode() for w in words]
        assert periodic.find_runs(words) == brute_runs(words)


def test_splitting_keeps_every_run_and_drops_prose():
    words = prose(7, 400).split()
    assert periodic.split_segments(periodic.word_codes(words)) == []
    words = words[:100] + ["a", "b", "c"] * 10 + words[100:]
    assert any(s <= 100 and 130 <= e for s, e in periodic.split_segments(periodic.word_codes(words)))


def test_one_word_repeated_a_million_times_is_one_run():
    assert periodic.lag_scan(np.zeros(1_000_000, np.int32)) == [(0, 1_000_000, 1)]


def test_bounds_of_a_run():
    runs = lambda words: periodic.find_runs([w.encode() for w in words])
    assert runs(["a"] * 23) == [] and runs(["a"] * 24) == [(0, 24, 1)]
    nine = [f"w{k}" for k in range(9)]
    assert runs(nine * 3) == [(0, 27, 9)] and runs(nine * 2 + nine[:8]) == []


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:2] and str(r)))


def test_op12_on_tricky_rows(spark, tricky, clashing, rows):
    want = by_id(brute_row(r[0], r[1]) for r in rows)
    for df in (tricky, clashing.withColumnRenamed("size", "runs").withColumnRenamed("key", "id")):
        assert by_id(periodic.op12_query(df).collect()) == want


def test_op12_plants(spark):
    rows = [(i, " ".join(words)) for i, words in enumerate(hard_texts(50, 120))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert by_id(periodic.op12_query(df).collect()) == by_id(brute_row(*r) for r in rows)


def test_op12_empty_table(none):
    assert periodic.op12_query(none).count() == 0


def test_operator_on_other_columns(spark):
    df = spark.createDataFrame([("k", "a b " * 20, 1), (None, None, 2)], "name string, body string, runs int")
    got = {r["name"]: r for r in periodic.periodic_runs(df, "name", "body").collect()}
    assert got["k"]["collapsed"] == "a b" and tuple(got["k"]["best"]) == (0, 40, 2) and got["k"]["n_words"] == 40
    assert got[None]["runs"] == [] and got[None]["best"] is None and got[None]["collapsed"] == ""
