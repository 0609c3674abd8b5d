"""Exact quantiles with linear interpolation by selection over digits.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, and sorting a column to find a few ranks moves all of it. Here a pass
counts rows by a digit of their value, a partial aggregation of at most
``CELLS`` rows per open cell that also keeps each digit's smallest and largest
value. Running counts over that small table tell which digits hold the wanted
ranks; the next pass reads only the values between a held digit's ends and cuts
them by the next digit, until a digit holds one value. The first digit is the
sign and the leading bits of the logarithm, so values of all magnitudes come
apart at once; later ones are equal parts of the cell. Each digit is a
nondecreasing function of the value, so the values between a digit's ends are
exactly its rows. A cell of doubles shrinks by ``CELLS`` in every pass, hence a
handful of passes; no row is exchanged, sorted or checkpointed.

Only the (at most 2 × len(probs)) digits of the wanted ranks reach the driver.
Interpolation is ``lo + (hi − lo)·frac`` at position ``p·(n−1)`` (numpy/pandas
"linear", DuckDB ``quantile_cont``, Spark ``percentile``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16
_PER_OCTAVE, _OFFSET, _TOP = 16, 20_000, 16_390      # 16 digits for each power of two, all of them positive


@dataclass(frozen=True)
class Cell:
    """Rows with low <= value <= high; ``before`` rows are smaller."""
    low: float | None
    high: float | None
    before: int
    ranks: tuple[int, ...]


def _first_digit(v: Column) -> Column:
    size = F.floor(F.least(F.log2(F.abs(v)) * F.lit(_PER_OCTAVE), F.lit(float(_TOP)))) + F.lit(_OFFSET)
    return F.when(v == 0, F.lit(0)).otherwise(F.when(v > 0, size).otherwise(-size)).cast("bigint")


def _later_digit(v: Column, cell: Cell) -> Column:
    low, high = F.lit(cell.low), F.lit(cell.high)
    return F.least(F.floor((v - low) / (high - low) * F.lit(float(CELLS))), F.lit(CELLS - 1)).cast("bigint")


def _pass(vals: DataFrame, cells: list[Cell]) -> list[Cell]:
    """The digits of ``cells`` that hold their ranks, as cells."""
    v = F.col("v")
    inside = [F.lit(True) if c.low is None else v.between(F.lit(c.low), F.lit(c.high)) for c in cells]
    digit = reduce(lambda rest, i: F.when(inside[i], F.struct(
        F.lit(i).alias("cell"), (_first_digit(v) if cells[i].low is None else _later_digit(v, cells[i])).alias("digit"))
    ).otherwise(rest), range(len(cells)), F.lit(None))
    counts = vals.where(reduce(lambda a, b: a | b, inside)).select("v", digit.alias("d")).groupBy("d.cell", "d.digit").agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("low"), F.max("v").alias("high"))
    upto = Window.partitionBy("cell").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)   # CELLS rows a cell
    summed = counts.withColumn("upto", F.sum("c").over(upto))
    holds = reduce(lambda a, b: a | b, [
        (F.col("cell") == i) & (F.col("upto") > r - c.before) & (F.col("upto") - F.col("c") <= r - c.before)
        for i, c in enumerate(cells) for r in c.ranks])
    out = []
    for r in summed.where(holds).select("cell", "c", "low", "high", "upto").collect():
        cell = cells[r["cell"]]
        first, last = cell.before + r["upto"] - r["c"], cell.before + r["upto"]
        out.append(Cell(r["low"], r["high"], first, tuple(k for k in cell.ranks if first <= k < last)))
    return out


def values_at(vals: DataFrame, ranks: list[int]) -> dict[int, float]:
    """The values of the column ``v`` at 0-based ranks."""
    found: dict[int, float] = {}
    cells = [Cell(None, None, 0, tuple(sorted(set(ranks))))]
    while cells:
        cells = _pass(vals, cells)
        for c in cells:
            if c.low == c.high:
                found |= dict.fromkeys(c.ranks, c.low)
        cells = [c for c in cells if c.low != c.high]
    return found


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    v = F.col(col).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    n = vals.count()
    if not n:
        return [None for _ in probs]
    at = [p * (n - 1) for p in probs]
    value = values_at(vals, [r for pos in at for r in (math.floor(pos), math.ceil(pos))])
    out = []
    for pos in at:
        lo, hi = math.floor(pos), math.ceil(pos)
        a, b = value[lo], value[hi]
        out.append(a if lo == hi or a == b else a + (b - a) * (pos - lo))
    return out
