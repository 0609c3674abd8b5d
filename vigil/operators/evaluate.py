"""Evaluation of a scored, labelled table.

Everything is grouped (``by=[...]``; global = ``by=[]``) and computed in one
or two passes over the scores:

* E2 exact ROC-AUC is Mann–Whitney on per-score counts: one aggregation to
  distinct scores, running negative counts via the distributed prefix sums
  (no single-task window), one final aggregation.
* E3/E4/E5 are one scan with conditional counts (4 per threshold) — no join
  with a threshold table.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.scalars import round_half_even_exact
from vigil.operators.sequence import prefix_sums

# Fixed values of the reference's evaluation.
THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
MIN_RECALL = 0.70
TEST_FRACTION = 0.2
SEED = 42
DIGITS = 4
HASH_BITS, RANGE_BITS = 64, 16


def _ratio(num, den):
    """0 when undefined (the reference's convention), never an ANSI error."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def stratified_split(df: DataFrame, label: str, key_cols: list[str],
                     test_fraction: float = TEST_FRACTION, seed: int = SEED) -> DataFrame:
    """E1 (W4): adds ``is_test``. Within each class, rows are ordered by a
    seeded ``xxhash64`` of the key (ties by the key) and the first
    k = round(f·n) (at least 1 and at most n−1 when n ≥ 2) go to test — exact
    class proportions, deterministic, and without a per-class single-task
    sort.

    The hash is uniform, so the cut of a class is found without sorting its
    rows: counts per 16-bit hash range (at most 65,536 per class) tell which
    range holds the k-th row, and only that range (n / 65,536 rows, with
    repeated keys counted first) is ranked. The wide table is split by
    comparing each row with its class's cut (one row per class reaches the
    driver) — a projection, so the wide rows never shuffle."""
    h = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    narrow = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_y"), h.alias("_h"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(key_cols)])
    order = ["_h", *[f"_k{i}" for i in range(len(key_cols))]]
    ranged = narrow.withColumn("_range", F.shiftright("_h", HASH_BITS - RANGE_BITS))
    upto = Window.partitionBy("_y").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    counts = ranged.groupBy("_y", "_range").agg(F.count(F.lit(1)).alias("c")).withColumns({
        "_upto": F.sum("c").over(upto), "_n": F.sum("c").over(Window.partitionBy("_y"))})
    k = F.when(F.col("_n") < 2, F.lit(0)).otherwise(F.greatest(F.lit(1), F.least(
        F.col("_n") - 1, F.floor(F.lit(test_fraction) * F.col("_n") + F.lit(0.5)))))
    holding = counts.withColumn("_k", k).where(
        (F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("c") < F.col("_k"))).select(
        "_y", "_range", "_k", (F.col("_upto") - F.col("c")).alias("_before"))
    inside = ranged.join(F.broadcast(holding), ["_y", "_range"])        # one row per class
    keyed = inside.groupBy("_y", "_k", "_before", *order).agg(F.count(F.lit(1)).alias("c"))
    within = Window.partitionBy("_y").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cuts = keyed.withColumn("_rank", F.col("_before") + F.sum("c").over(within)).where(
        (F.col("_rank") >= F.col("_k")) & (F.col("_rank") - F.col("c") < F.col("_k"))).select("_y", *order).collect()

    types = [narrow.schema[c].dataType for c in order]
    row_key = F.struct(*[c.alias(f"c{i}") for i, c in
                         enumerate([h, *[F.col(k) for k in key_cols]])])
    test = F.lit(False)
    for r in cuts:      # one row per class
        cut_key = F.struct(*[F.lit(r[c]).cast(t).alias(f"c{i}")
                             for i, (c, t) in enumerate(zip(order, types))])
        test = test | ((F.col(label) == F.lit(r["_y"])) & (row_key <= cut_key))
    return df.withColumn("is_test", F.coalesce(test, F.lit(False)))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by=()) -> DataFrame:
    """E2 (W3): exact AUC with tied scores counted one half; NULL when a class
    is absent."""
    by = list(by)
    y = F.col(label)
    g = (df.where(F.col(score).isNotNull() & y.isNotNull())
         .groupBy(*by, F.col(score).alias("_s"))
         .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))
    cum = prefix_sums(g, ["_s"], {"neg_le": F.col("neg")}, by)
    u = F.col("pos") * (F.col("neg_le") - F.col("neg") / 2.0)
    res = cum.groupBy(*by).agg(F.sum(u).alias("u"), F.sum("pos").alias("n_pos"),
                               F.sum("neg").alias("n_neg"))
    return res.select(*by, F.try_divide(F.col("u"), F.col("n_pos").cast("double")
                                        * F.col("n_neg").cast("double")).alias("auc"),
                      F.col("n_pos").cast("bigint").alias("n_pos"),
                      F.col("n_neg").cast("bigint").alias("n_neg"))


def _counts(df, label, score, thresholds, by):
    y, s = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        p = F.coalesce(s >= F.lit(float(t)), F.lit(False))
        aggs += [F.count_if(p & (y == 1)).alias(f"tp{i}"), F.count_if(p & (y != 1)).alias(f"fp{i}"),
                 F.count_if(~p & (y == 1)).alias(f"fn{i}"), F.count_if(~p & (y != 1)).alias(f"tn{i}")]
    one = df.where(y.isNotNull()).groupBy(*by).agg(*aggs)
    rows = F.inline(F.array(*[F.struct(F.lit(float(t)).alias("threshold"),
                                       F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                                       F.col(f"fn{i}").alias("fn"), F.col(f"tn{i}").alias("tn"))
                              for i, t in enumerate(thresholds)]))
    return one.select(*by, rows)


def threshold_metrics(df: DataFrame, label: str = "label", score: str = "score",
                      thresholds=THRESHOLDS, by=(), digits: int | None = DIGITS) -> DataFrame:
    """Per threshold tp/fp/fn/tn, precision, recall, f1, fpr (0 when
    undefined), flagged and missed; ratios rounded to ``digits`` exactly as
    Python's ``round`` (17/32 → 0.5312)."""
    by = list(by)
    c = _counts(df, label, score, thresholds, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    fpr = _ratio(fp, fp + tn)
    rd = (lambda x: round_half_even_exact(x, digits)) if digits is not None else (lambda x: x)
    return c.select(*by, "threshold", rd(p).alias("precision"), rd(r).alias("recall"),
                    rd(f1).alias("f1"), rd(fpr).alias("fpr"), "tp", "fp", "fn", "tn",
                    (tp + fp).alias("flagged"), fn.alias("missed"))


def recommend_threshold(metrics: DataFrame, min_recall: float = MIN_RECALL, by=()) -> DataFrame:
    """Among thresholds with recall ≥ min_recall the highest precision
    (lowest threshold on ties); if none qualifies, the highest recall."""
    by = list(by)
    cand = F.col("recall") >= F.lit(min_recall)
    w = Window.partitionBy(*by).orderBy(F.desc(cand), F.desc(F.when(cand, F.col("precision"))),
                                        F.desc(F.when(~cand, F.col("recall"))), F.asc("threshold"))
    return (metrics.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select(*by, "threshold", "precision", "recall", cand.alias("meets_min_recall")))


def confusion_matrix(df: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = 0.5, by=()) -> DataFrame:
    """(actual, predicted, n) for all four cells, zero-filled."""
    by = list(by)
    c = _counts(df, label, score, [threshold], by)
    cells = F.inline(F.array(
        *[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(col).alias("n"))
          for a, p, col in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]))
    return c.select(*by, cells)


def classification_report(df: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5, by=(), digits: int | None = DIGITS) -> DataFrame:
    """E5: per-class precision/recall/f1/support, accuracy, macro and
    support-weighted averages (the accuracy row carries only f1 = accuracy)."""
    by = list(by)
    c = _counts(df, label, score, [threshold], by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f = lambda p, r: F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    f1_, f0 = f(p1, r1), f(p0, r0)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    n = s0 + s1
    acc = _ratio(tp + tn, n)
    wavg = lambda a, b: _ratio(a * s0 + b * s1, n)
    rd = (lambda x: round_half_even_exact(x, digits)) if digits is not None else (lambda x: x)
    null = F.lit(None).cast("double")
    rows = [("0", p0, r0, f0, s0), ("1", p1, r1, f1_, s1), ("accuracy", null, null, acc, n),
            ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, n),
            ("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1_), n)]
    return c.select(*by, F.inline(F.array(*[
        F.struct(F.lit(k).alias("class"), rd(p).alias("precision"), rd(r).alias("recall"),
                 rd(fs).alias("f1"), sup.cast("bigint").alias("support"))
        for k, p, r, fs, sup in rows])))
