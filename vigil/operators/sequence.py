"""W1 sequence numbers and W2 running sums without a single-task window.

An un-partitioned ``row_number()`` or running ``sum`` moves every row into one
task, and a window partitioned by the range-partition id re-shuffles every row
a second time (the range layout does not satisfy its clustering). Instead:

1. range-partition on the (unique) ordering key and sort within partitions —
   Spark samples the key to choose boundaries, so partitions are balanced
   even when one hour or one symbol holds a third of the rows, and AQE merges
   adjacent small ones up to the advisory partition size; the layout is
   checkpointed to the shared folder so both passes below see the same
   partitions and a lost executor does not re-sample;
2. per (partition, group) totals — a partial aggregation, at most
   partitions + groups rows;
3. offsets = running totals over that small table, ordered by partition id.
   Only a group that already had rows in an earlier partition gets one, and
   in a range layout that is at most the first group of each partition, so
   the offset table is bounded by the partition count and is broadcast;
4. running values inside each partition: one streaming pass over the sorted
   partition (numpy/pandas per Arrow batch, the carry passed between
   batches), then + offset. No second shuffle of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import cut_lineage

_PID = "_vigil_pid"


def _row_keys(pdf: pd.DataFrame, by: list[str]) -> tuple[np.ndarray, list[tuple]]:
    """``starts[i]`` is True where row i's group differs from row i−1's
    (null-safe); also the key tuple of the first and last row."""
    m = len(pdf)
    differs = np.zeros(max(m - 1, 0), dtype=bool)
    for b in by:
        a = pdf[b].to_numpy(dtype=object)
        na = pdf[b].isna().to_numpy()
        same = (a[1:] == a[:-1]) | (na[1:] & na[:-1])
        same &= na[1:] == na[:-1]
        differs |= ~same
    starts = np.empty(m, dtype=bool)
    starts[:1] = True
    starts[1:] = differs

    def key(i):
        return tuple(None if pd.isna(pdf[b].iat[i]) else pdf[b].iat[i] for b in by)
    return starts, [key(0), key(m - 1)]


def _local_running_sums(by: list[str], vcols: list[str], lcols: list[str]):
    """Inclusive running sums of ``vcols`` within each ``by`` run of a
    partition that arrives sorted by ``by`` + order. Summation is sequential
    in row order, like a running window ``sum``."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry_key, carry = None, None
        for pdf in batches:
            m = len(pdf)
            if m == 0:
                continue
            if by:
                starts, (first_key, last_key) = _row_keys(pdf, by)
            else:
                starts, first_key, last_key = np.zeros(m, dtype=bool), (), ()
                starts[0] = True
            continues = carry is not None and first_key == carry_key
            run = np.cumsum(starts)
            out = {}
            for v, lc in zip(vcols, lcols):
                x = pdf[v].to_numpy().copy()
                if continues:
                    x[0] = carry[v] + x[0]
                out[lc] = pd.Series(x).groupby(run).cumsum().to_numpy()
            carry_key = last_key
            carry = {v: out[lc][-1] for v, lc in zip(vcols, lcols)}
            yield pdf.assign(**out)
    return fn


def prefix_sums(df: DataFrame, order_cols: list[str], values: dict[str, object],
                by: list[str] | tuple = (), num_partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums ``{name: expr}`` over ``order_cols`` within
    each ``by`` group. ``order_cols`` must make the order total (add an id).
    Integral values sum as bigint, others as double; nulls count as 0. Every
    column of ``df`` passes through the per-partition pass, so callers hand
    in narrow frames."""
    by = list(by)
    keys = by + list(order_cols)
    vcols, lcols = [f"_v_{k}" for k in values], [f"_l_{k}" for k in values]
    staged = df.select("*", *[(e if isinstance(e, Column) else F.lit(e)).alias(v)
                              for v, e in zip(vcols, values.values())])
    kinds = ["bigint" if isinstance(staged.schema[v].dataType, T.IntegralType) else "double"
             for v in vcols]
    staged = staged.select(*df.columns, *[F.coalesce(F.col(v).cast(t), F.lit(0).cast(t)).alias(v)
                                          for v, t in zip(vcols, kinds)])
    # Without an explicit count AQE may merge adjacent range partitions up to
    # the advisory size; the partition id is read after that, so it still
    # follows the key order.
    spread = (staged.repartitionByRange(num_partitions, *keys) if num_partitions
              else staged.repartitionByRange(*keys))
    ranged = cut_lineage(spread.withColumn(_PID, F.spark_partition_id())
                         .sortWithinPartitions(*keys))

    totals = ranged.groupBy(_PID, *by).agg(
        *[F.sum(v).alias(f"_t_{k}") for v, k in zip(vcols, values)])
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    first = next(iter(values))
    offsets = (totals.select(_PID, *by, *[F.sum(f"_t_{k}").over(before).alias(f"_o_{k}")
                                          for k in values])
               .where(F.col(f"_o_{first}").isNotNull())
               .select(F.col(_PID).alias("_j_pid"), *[F.col(b).alias(f"_j_{b}") for b in by],
                       *[f"_o_{k}" for k in values]))

    schema = T.StructType(ranged.schema.fields + [
        T.StructField(lc, ranged.schema[v].dataType, False) for v, lc in zip(vcols, lcols)])
    local = ranged.sortWithinPartitions(*keys).mapInPandas(
        _local_running_sums(by, vcols, lcols), schema)
    cond = [local[_PID] == F.col("_j_pid")] + [local[b].eqNullSafe(F.col(f"_j_{b}")) for b in by]
    # At most one continuing group per partition: bounded by the partition count.
    out = local.join(F.broadcast(offsets), cond, "left")
    return out.select(*df.columns, *[(F.col(f"_l_{k}") + F.coalesce(F.col(f"_o_{k}"), F.lit(0)))
                                     .cast(t).alias(k) for k, t in zip(values, kinds)])


def sequence_number(df: DataFrame, order_cols: list[str], by: list[str] | tuple = (),
                    name: str = "seq") -> DataFrame:
    """1-based position of each row in ``order_cols`` order within ``by``."""
    return prefix_sums(df, order_cols, {name: F.lit(1).cast("bigint")}, by)
