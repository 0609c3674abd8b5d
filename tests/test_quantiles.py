"""Selection over digits against sorting, on values of every size."""

import math
import struct

import numpy as np
import pytest

from vigil.operators import quantiles

PROBS = [i / 10 for i in range(11)] + [0.003, 0.5001]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


def by_sorting(values):
    s = sorted(v for v in values if v is not None and not math.isnan(v))
    out = []
    for p in PROBS:
        pos = p * (len(s) - 1)
        a, b = s[math.floor(pos)], s[math.ceil(pos)]
        out.append(a if a == b else a + (b - a) * (pos - math.floor(pos)))
    return out


CASES = {
    "normal": np.random.default_rng(1).normal(size=3000).tolist(),
    "every size": [float(struct.unpack("<d", struct.pack("<Q", int(b)))[0]) for b in
                   np.random.default_rng(2).integers(0, 2**63 - 2**53, 1500)] + [-1e-320, 0.0, -0.0, 5e-324, -1.7e308],
    "ties": [7.25] * 500 + [7.250000000000001] * 400 + [-3.0] * 100,
    "neighbours": (1e16 + np.arange(0, 4000, 2.0)).tolist(),
    "one": [math.pi], "infinite": [math.inf] * 3 + [-math.inf] * 2 + [1.0, 2.0, 1e300],
    "holes": [None, math.nan, 4.0, None, 9.0, math.nan, -4.0],
}


@pytest.mark.parametrize("name", list(CASES))
def test_quantiles_equal_sorting(spark, name):
    got = quantiles.exact_quantiles(frame(spark, CASES[name]), "x", PROBS)
    assert got == pytest.approx(by_sorting(CASES[name]), rel=1e-15, nan_ok=True)


def test_no_values(spark):
    assert quantiles.exact_quantiles(frame(spark, [None, math.nan]), "x", [0.5]) == [None]


def test_no_pass_exchanges_rows(spark):
    import contextlib
    import io
    vals = spark.range(100_000).selectExpr("sqrt(id) v")
    cell = quantiles.Cell(0.0, 300.0, 0, (10, 20))
    seen = []
    original = type(vals).collect

    def collect(self):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            self.explain()
        seen.append(out.getvalue())
        return original(self)

    type(vals).collect = collect
    try:
        quantiles._pass(vals, [cell])
    finally:
        type(vals).collect = original
    assert "rangepartitioning" not in seen[0] and seen[0].count("Exchange hashpartitioning(") <= 2
    assert "partial_count" in seen[0]
