"""Boosted trees as a table.

One row per node: (tree, weight, node, feature, split, left, right, leaf, gain,
n: the weight of its training rows). An inner node names the feature it asks and the bound: values up to the
bound go left, greater ones and NaN right. The table has at most
``maxIter * 2**(maxDepth + 1)`` rows whatever the input, so a task may hold it
whole. ``save_trees`` writes it beside the model; scoring, importances and the
validation curve below need nothing else.

Validation AUC per boosting round does not explode rows by rounds: a task adds
its rows' running margins to one histogram per round (fixed bins between the
smallest and largest margin the trees can give), so what is exchanged is bounded
by tasks x rounds x bins. Pairs in different bins are ordered by their bins, so
the histogram bounds each round's AUC from both sides; only rounds whose order
these bounds leave open are recounted, and of these only the bins that hold
both classes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TREE_SCHEMA = ("tree int, weight double, node int, feature string, split double, left int, right int, leaf double, "
               "gain double, n double")
BINS = 1 << 14
MERGED_PARTS = 32              # partitions of the rows that one task of a curve takes at most


def read_saved_trees(spark: SparkSession, model_path: str, feature_cols: list[str]) -> DataFrame:
    """The node table of a fitted pipeline that Spark ML has written."""
    stages = f"{model_path.rstrip('/')}/stages/1_*"
    weights = spark.read.parquet(f"{stages}/treesMetadata").toDF("tree", "metadata", "weight").select("tree", "weight")
    names = F.array(*map(F.lit, feature_cols))
    inner = F.col("nodeData.leftChild") >= 0
    nodes = spark.read.parquet(f"{stages}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.when(inner, F.get(names, F.col("nodeData.split.featureIndex"))).alias("feature"),
        F.when(inner, F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0))).alias("split"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"), F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.when(~inner, F.col("nodeData.prediction")).alias("leaf"),
        F.when(inner, F.col("nodeData.gain")).alias("gain"), F.get("nodeData.impurityStats", F.lit(0)).alias("n"))
    return nodes.join(F.broadcast(weights), "tree").select(*[c.split()[0] for c in TREE_SCHEMA.split(", ")])


def save_trees(trees: DataFrame, path: str) -> None:
    trees.coalesce(1).write.mode("overwrite").parquet(path)


def load_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE_SCHEMA).parquet(path)


def importance(trees: DataFrame) -> DataFrame:
    """(feature, importance): the share of the rows' gains that the splits on
    a feature bring, over all trees; features that are never asked do not show."""
    gains = trees.where(F.col("feature").isNotNull()).groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("n")).alias("g"))
    total = gains.agg(F.sum("g").alias("total"))
    return gains.crossJoin(F.broadcast(total)).select(       # one row per feature, one row of totals
        "feature", F.try_divide("g", "total").alias("importance"))


@dataclass(frozen=True)
class TreeModel:
    """The node table as arrays; scores like a fitted pipeline."""
    feature_cols: tuple[str, ...]
    weights: np.ndarray
    roots: np.ndarray                 # position of each tree's root
    feature: np.ndarray               # position in feature_cols, -1 for a leaf
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray
    depth: int

    @classmethod
    def of(cls, trees: DataFrame, feature_cols: list[str] | None = None) -> TreeModel:
        """From the node table (bounded by trees x nodes, see above)."""
        rows = trees.orderBy("tree", "node").collect()
        names = tuple(feature_cols or sorted({r["feature"] for r in rows if r["feature"] is not None}))
        at = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
        children = {c for r in rows for c in ((r["tree"], r["left"]), (r["tree"], r["right"]))}
        roots = [i for (key, i) in at.items() if key not in children]
        number = lambda xs, t: np.array(xs, t)
        inner = [r["feature"] is not None for r in rows]
        left = [at[r["tree"], r["left"]] if ok else i for i, (r, ok) in enumerate(zip(rows, inner))]
        right = [at[r["tree"], r["right"]] if ok else i for i, (r, ok) in enumerate(zip(rows, inner))]
        depth, level = 0, set(roots)
        while level := {c for i in level if inner[i] for c in (left[i], right[i])}:
            depth += 1
        return cls(names, number([rows[i]["weight"] for i in roots], float), number(roots, np.int64),
                   number([names.index(r["feature"]) if ok else -1 for r, ok in zip(rows, inner)], np.int64),
                   number([r["split"] if ok else 0.0 for r, ok in zip(rows, inner)], float), number(left, np.int64),
                   number(right, np.int64), number([0.0 if ok else r["leaf"] for r, ok in zip(rows, inner)], float), depth)

    def contributions(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Each tree's weighted leaf for the rows of ``x``."""
        rows = np.arange(len(x))
        for w, root in zip(self.weights, self.roots):
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, np.maximum(self.feature[node], 0)] <= self.split[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            yield w * self.leaf[node]

    def margin_range(self) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and largest margin after each round."""
        ends = np.append(self.roots[1:], len(self.leaf))
        low, high = [], []
        for w, start, end in zip(self.weights, self.roots, ends):
            leaves = w * self.leaf[start:end][self.feature[start:end] < 0]
            low.append(leaves.min())
            high.append(leaves.max())
        return np.cumsum(low), np.cumsum(high)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` as Spark's boosted classifier does."""
        def margins(parts: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for part in parts:
                x = part.to_numpy(dtype=float, na_value=np.nan)
                yield pd.Series(sum(self.contributions(x), np.zeros(len(x))))

        udf = F.pandas_udf(margins, "double")
        margin = udf(F.struct(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(self.feature_cols)]))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))
        return df.withColumn("_p", p).withColumn(
            "probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p")))).drop("_p")


def model_of(model: PipelineModel, feature_cols: list[str]) -> TreeModel:
    """The tables of a fitted pipeline that is not written yet, from the trees'
    public text form (bounds and leaves in full precision)."""
    gbt = model.stages[-1]
    spark = SparkSession.active()
    rows = []
    for t, (tree, weight) in enumerate(zip(gbt.trees, gbt.treeWeights)):
        lines = [line.strip() for line in tree.toDebugString.splitlines()[1:] if line.strip()]
        at = 0

        def node() -> int:
            nonlocal at
            number, line = len(made), lines[at]
            made.append(None)
            at += 1
            if line.startswith("Predict:"):
                made[number] = (t, float(weight), number, None, None, None, None, float(line.split(": ")[1]), None, None)
                return number
            feature, bound = line.removeprefix("If (feature ").removesuffix(")").split(" <= ")
            left = node()
            at += 1                                        # the line with Else
            right = node()
            made[number] = (t, float(weight), number, feature_cols[int(feature)], float(bound), left, right, None, None, None)
            return number

        made: list = []
        node()
        rows += made
    return TreeModel.of(spark.createDataFrame(rows, TREE_SCHEMA), feature_cols)


@dataclass(frozen=True)
class Binning:
    """Where a round's margins fall: what the tasks of a curve need."""
    model: TreeModel
    low: np.ndarray
    scale: np.ndarray
    bins: int

    def batches(self, batches: Iterator[pa.RecordBatch], wanted=None) -> Iterator[tuple[np.ndarray, Iterator[tuple]]]:
        """(positive?, (round, bins, margins) of each round, or of the
        ``wanted`` ones) of each batch."""
        last = len(self.model.weights) if wanted is None else max(wanted, default=-1) + 1

        def rounds(x):
            margin = np.zeros(len(x))
            for k, c in zip(range(last), self.model.contributions(x)):
                margin = margin + c
                if wanted is not None and k not in wanted:
                    continue
                at = ((margin - self.low[k]) * self.scale[k]).astype(np.int64)
                yield k, np.clip(at, 0, self.bins - 1), margin

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(1, batch.num_columns)]
            yield batch.column(0).to_numpy(zero_copy_only=False) == 1, rounds(np.column_stack(columns))


class ValidationCurve:
    """AUC of each round's margins over ``valid``."""

    def __init__(self, model: TreeModel, valid: DataFrame, label: str, bins: int = BINS):
        self._model, self._bins = model, bins
        rows = valid.where(F.col(label).isNotNull()).select(
            F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_x{i}")
                                                       for i, c in enumerate(model.feature_cols)])
        # Each task of the curve sends a table of rounds x bins, so it takes several partitions when there are
        # more of them than cores; rows stream through it.
        parts = rows.rdd.getNumPartitions()
        self._rows = rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-parts // MERGED_PARTS)))
        low, high = model.margin_range()
        self._binning = Binning(model, low, np.where(high > low, bins / np.where(high > low, high - low, 1.0), 0.0), bins)
        table = self._histogram()
        below = Window.partitionBy("k").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        # At most rounds x bins rows, a window per round.
        bounds = table.withColumn("before", F.coalesce(F.sum("neg").over(below), F.lit(0))).groupBy("k").agg(
            F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(F.col("pos") * F.col("before")).alias("sure"),
            F.sum(F.col("pos") * F.col("neg")).alias("open"),
            F.collect_list(F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("bin"))).alias("mixed"))
        self._bounds = {r["k"]: r for r in bounds.collect()}
        self.rounds = sorted(self._bounds)

    def _histogram(self) -> DataFrame:
        binning, bins, rounds = self._binning, self._bins, len(self._model.weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((rounds, 2, bins), np.int64)
            for positive, each in binning.batches(batches):
                for k, at, _ in each:
                    counts[k, 1] += np.bincount(at[positive], minlength=bins)
                    counts[k, 0] += np.bincount(at[~positive], minlength=bins)
            for k in range(rounds):
                held = np.flatnonzero(counts[k].any(axis=0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held), k + 1)), pa.array(held), pa.array(counts[k, 1, held]),
                     pa.array(counts[k, 0, held])], ["k", "bin", "pos", "neg"])

        return self._rows.mapInArrow(run, "k bigint, bin bigint, pos bigint, neg bigint").groupBy("k", "bin").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))

    def bounds(self, k: int) -> tuple[float, float] | None:
        """(least, greatest) AUC the histogram allows; None without both classes."""
        r = self._bounds[k]
        pairs = float(r["p"]) * float(r["n"])
        return (r["sure"] / pairs, (r["sure"] + r["open"]) / pairs) if pairs else None

    def exact(self, rounds: list[int]) -> dict[int, float | None]:
        """Exact AUC (ties one half) of the given rounds: their mixed bins are
        counted again by margin."""
        wanted = {k - 1: set(self._bounds[k]["mixed"]) for k in rounds if self.bounds(k)}
        masks = {}
        for k, held in wanted.items():
            masks[k] = np.zeros(self._bins, bool)
            masks[k][list(held)] = True
        binning = self._binning

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for positive, each in binning.batches(batches, masks):
                for k, at, margin in each:
                    chosen = masks[k][at]
                    values, which = np.unique(margin[chosen], return_inverse=True)
                    pos = np.bincount(which, weights=positive[chosen], minlength=len(values)).astype(np.int64)
                    neg = np.bincount(which, minlength=len(values)) - pos
                    _, bins = np.unique(margin[chosen], return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), k + 1)), pa.array(at[chosen][bins]), pa.array(values), pa.array(pos),
                         pa.array(neg)], ["k", "bin", "margin", "pos", "neg"])

        counts = self._rows.mapInArrow(run, "k bigint, bin bigint, margin double, pos bigint, neg bigint").groupBy(
            "k", "bin", "margin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        below = Window.partitionBy("k", "bin").orderBy("margin").rowsBetween(Window.unboundedPreceding, -1)
        inside = counts.withColumn("before", F.coalesce(F.sum("neg").over(below), F.lit(0))).groupBy("k").agg(
            F.sum(F.col("pos") * (2 * F.col("before") + F.col("neg"))).alias("u2"))
        got = {r["k"]: r["u2"] for r in inside.collect()} if masks else {}      # one row per round
        out: dict[int, float | None] = {}
        for k in rounds:
            r = self._bounds[k]
            pairs = float(r["p"]) * float(r["n"])
            out[k] = (r["sure"] + got.get(k, 0) / 2.0) / pairs if pairs else None
        return out

    def settled(self) -> list[tuple[int, float | None]]:
        """(round, AUC) in which every running maximum and its round is exact:
        rounds are recounted until the bounds decide each comparison of a round
        with the best before it. Other rounds carry an upper bound that is not
        above the best so far."""
        known: dict[int, float | None] = {}
        while True:
            low = high = None
            leading: list[int] = []                        # rounds that may hold the maximum so far
            need: set[int] = set()
            for k in self.rounds:
                b = (known[k],) * 2 if k in known else self.bounds(k)
                if b is None or b[0] is None:
                    continue
                if low is None or b[0] > high:
                    leading = [k]
                elif b[1] > low:
                    leading = [j for j in leading if self._upper(j, known) > b[0]] + [k]
                    need |= {j for j in leading if j not in known}
                low, high = max(low or 0.0, b[0]), max(high or 0.0, b[1])
            need |= {j for j in leading if j not in known}
            if not need:
                break
            known |= self.exact(sorted(need))
        return [(k, known[k] if k in known else (self.bounds(k) or (None, None))[1]) for k in self.rounds]

    def _upper(self, k: int, known: dict) -> float:
        return known[k] if k in known else self.bounds(k)[1]
