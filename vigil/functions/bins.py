"""Equal-width binning with numpy's edge semantics.

Edges are ``start + i*step`` for i < n and exactly ``stop`` for i = n (what
``numpy.linspace`` produces). Bin i holds ``edges[i] <= x < edges[i+1]``; the
last bin is closed on the right. A value outside [start, stop] has no bin
(NULL). ``width_bucket`` is not used: it returns n+1 for the maximum, NULL when
start = stop, and disagrees with the edge array at exact edges.

The bin index is computed arithmetically and then corrected by one against the
two neighbouring edges — the same scheme numpy uses — so the expression stays
scalar and inside whole-stage codegen (no per-row array of edges).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def edge(i, start, step, n, stop) -> Column:
    i, start, step, stop = _lit(i), _lit(start), _lit(step), _lit(stop)
    return F.when(i >= F.lit(n), stop).otherwise(i.cast("double") * step + start)


def equal_width_bin(x, start, stop, n: int) -> Column:
    """0-based bin index of ``x`` over ``n`` equal-width bins on [start, stop]."""
    x = x if isinstance(x, Column) else F.col(x)
    start, stop = _lit(start).cast("double"), _lit(stop).cast("double")
    step = (stop - start) / F.lit(float(n))
    guess = F.floor(F.try_divide(x - start, step))
    i0 = F.least(F.greatest(F.coalesce(guess, F.lit(n - 1)), F.lit(0)), F.lit(n - 1))
    down = x < edge(i0, start, step, n, stop)
    up = (i0 < F.lit(n - 1)) & (x >= edge(i0 + 1, start, step, n, stop))
    idx = F.when(down, i0 - 1).when(up, i0 + 1).otherwise(i0)
    # All-equal range: every value sits in the last bin (numpy behaviour).
    idx = F.when(step == 0, F.lit(n - 1)).otherwise(idx)
    inside = (x >= start) & (x <= stop)
    return F.when(inside, idx.cast("int"))


def fixed_unit_bin(score, n: int) -> Column:
    """Bins of width 1/n over [0, 1] (A12): ``least(floor(score*n), n-1)``."""
    s = score if isinstance(score, Column) else F.col(score)
    return F.when((s >= 0) & (s <= 1), F.least(F.floor(s * n), F.lit(n - 1)).cast("int"))
