"""Exact, distributed ranking metrics.

Everything here reduces rows to *distinct values with counts* first (a
partial-aggregated groupBy), then needs cumulative counts in value order.
A global running sum is the classic trap (``Window.orderBy`` with no
partition moves every row to one task), so prefix sums are computed in two
levels: distinct values are cut into range buckets (boundaries from
``approxQuantile``: ``n_buckets - 1`` numbers on the driver, as many buckets as
shuffle partitions unless given), each bucket gets its own running sum, and a
per-bucket offset (a table of ``n_buckets`` rows per group) is added back. The
results are exact; the approximate quantiles only decide
where bucket borders fall.

Metric identities used (``pos``/``neg`` counts per distinct score):
* ROC AUC = (sum of average ranks of positives - P(P+1)/2) / (P N)
* PR AUC (trapezoid over the PR curve incl. the (recall 0, precision 1) end)
  = sum_k pos_k / P * (prec_k + prec_{k-1}) / 2
* average precision = sum_k pos_k / P * prec_k
where k runs over distinct scores in descending order and prec_{k-1} is the
precision at the previous (higher) threshold, 1 for the first.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.session import cut_lineage


def _bucket(df: DataFrame, col: str, n_buckets: int | None) -> Column:
    """Range bucket id of ``col`` (0..n_buckets-1) from approximate quantiles."""
    if n_buckets is None:
        n_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n_buckets <= 1:
        return F.lit(0)
    qs = [i / n_buckets for i in range(1, n_buckets)]
    # borders only balance the buckets (results stay exact), so a coarse sketch suffices
    bounds = sorted({b for b in df.approxQuantile(col, qs, min(0.01, 0.5 / n_buckets)) if b is not None and not np.isnan(b)})
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    return F.size(F.filter(arr, lambda b: b < F.col(col)))


def cumulative(
    df: DataFrame,
    order_col: str,
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    n_buckets: int | None = None,
) -> DataFrame:
    """Add ``cum_<c>``: running sums of ``sum_cols`` in ascending ``order_col``
    within ``group_cols`` (rows are expected distinct per group and value).

    The borders, the running sums and the offsets each read ``df``: it is written once."""
    g, df = list(group_cols), cut_lineage(df)
    d = df.withColumn("_b", _bucket(df, order_col, n_buckets))
    local = Window.partitionBy(*g, "_b").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.select("*", *[F.sum(c).over(local).alias(f"_loc_{c}") for c in sum_cols])
    tot = d.groupBy(*g, "_b").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*g, "_b", *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    out = d.join(off, [*g, "_b"])
    keep = [c for c in df.columns]
    return out.select(*keep, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols])


def with_average_rank(
    df: DataFrame, col: str, weight: str, group_cols: Sequence[str] = (), n_buckets: int | None = None
) -> DataFrame:
    """Add ``rank_<col>``, the tie-shared 1-based rank of ``col`` in a folded
    table whose rows stand for ``weight`` rows each.

    Rows of equal value are window peers in their range bucket, so the rank is
    (rows below) + (peers + 1) / 2 from two range frames over one ordering: no
    join back on a value. The borders, the ranks and the offsets each read
    ``df``: it is written once."""
    g, df = list(group_cols), cut_lineage(df)
    d = df.withColumn("_b", _bucket(df, col, n_buckets))
    order = Window.partitionBy(*g, "_b").orderBy(col)
    upto = F.sum(weight).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    peers = F.sum(weight).over(order.rangeBetween(Window.currentRow, Window.currentRow))
    d = d.select("*", upto.alias("_upto"), peers.alias("_peers"))
    tot = d.groupBy(*g, "_b").agg(F.sum(weight).alias("_tot"))
    before = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*g, "_b", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    rank = F.col("_off") + F.col("_upto") - F.col("_peers") + (F.col("_peers") + 1) / 2.0
    return d.join(off, [*g, "_b"]).select(*df.columns, rank.alias(f"rank_{col}"))


def spearman(df: DataFrame, x: str, y: str, group_cols: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Spearman correlation = Pearson correlation of average ranks.

    Rows fold to distinct (x, y) with their counts and x is ranked there; then
    they fold to distinct y, keeping the sums of x ranks that the correlation
    needs, and y is ranked on that table. So a y with few values (the future
    intensity has five) is never a join or window key of many rows; ``x`` should
    be the finer of the two."""
    g = list(group_cols)
    folded = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*g, x, y).agg(F.count(F.lit(1)).alias("_n"))
    rx = F.col(f"rank_{x}")
    by_y = with_average_rank(folded, x, "_n", g, n_buckets).groupBy(*g, y).agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") * rx).alias("_sx"), F.sum(F.col("_n") * rx * rx).alias("_sxx")
    )
    ry, n = F.col(f"rank_{y}"), F.col("_n").cast("double")
    sums = with_average_rank(by_y, y, "_n", g, n_buckets).groupBy(*g).agg(
        F.sum(n).alias("m"), F.sum("_sx").alias("sx"), F.sum("_sxx").alias("sxx"),
        F.sum(n * ry).alias("sy"), F.sum(n * ry * ry).alias("syy"), F.sum(F.col("_sx") * ry).alias("sxy"),
    )
    m, sx, sy = F.col("m"), F.col("sx"), F.col("sy")
    vx, vy = F.col("sxx") - sx * sx / m, F.col("syy") - sy * sy / m
    corr = F.when((vx > 0) & (vy > 0), (F.col("sxy") - sx * sy / m) / F.sqrt(vx * vy))
    return sums.select(*g, corr.alias("spearman"))


def _score_counts(df: DataFrame, score: str, label: str, group_cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*group_cols, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )


def roc_auc(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC (Mann-Whitney with tie-averaged ranks); NULL if a class is empty."""
    g = list(group_cols)
    sc = _score_counts(df, score, label, g).withColumn("_n", F.col("_pos") + F.col("_neg"))
    c = cumulative(sc, score, ["_n"], g, n_buckets)
    rank = (F.col("cum__n") - F.col("_n")) + (F.col("_n") + 1) / 2.0
    agg = c.groupBy(*g).agg(
        F.sum(F.col("_pos") * rank).alias("_rpos"), F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N")
    )
    P = F.col("_P").cast("double")
    N = F.col("_N").cast("double")
    auc = (F.col("_rpos") - P * (P + 1) / 2.0) / F.nullif(P * N, F.lit(0.0))
    return agg.select(*g, auc.alias("roc_auc"))


def pr_metrics(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """PR AUC by trapezoid over the precision-recall curve, and average precision."""
    g = list(group_cols)
    sc = _score_counts(df, score, label, g).withColumn("_neg_score", -F.col(score))
    c = cumulative(sc, "_neg_score", ["_pos", "_neg"], g, n_buckets)
    tp, fp = F.col("cum__pos").cast("double"), F.col("cum__neg").cast("double")
    tp0, fp0 = tp - F.col("_pos"), fp - F.col("_neg")
    prec = tp / (tp + fp)
    prec_prev = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    c = c.select(*g, "_pos", prec.alias("_prec"), prec_prev.alias("_prev"))
    agg = c.groupBy(*g).agg(
        F.sum(F.col("_pos") * (F.col("_prec") + F.col("_prev")) / 2.0).alias("_trap"),
        F.sum(F.col("_pos") * F.col("_prec")).alias("_ap"),
        F.sum("_pos").alias("_P"),
    )
    P = F.nullif(F.col("_P").cast("double"), F.lit(0.0))
    return agg.select(*g, (F.col("_trap") / P).alias("pr_auc"), (F.col("_ap") / P).alias("average_precision"))


def confusion_metrics(df: DataFrame, prob: str, label: str, threshold: float | Column = 0.5, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy / precision / recall / F1 at ``prob >= threshold`` (0 on zero division)."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = (F.col(prob) >= thr).cast("int")
    y = F.col(label)
    agg = df.groupBy(*group_cols).agg(
        F.count_if((pred == 1) & (y == 1)).alias("tp"),
        F.count_if((pred == 1) & (y != 1)).alias("fp"),
        F.count_if((pred == 0) & (y == 1)).alias("fn"),
        F.count_if((pred == 0) & (y != 1)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    return agg.select(
        *group_cols,
        ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def threshold_grid(lo: float = 0.1, hi: float = 0.9, n: int = 81) -> list[float]:
    """The candidate cut-offs (same doubles as ``numpy.linspace``)."""
    return [float(x) for x in np.linspace(lo, hi, n)]


def threshold_search(
    df: DataFrame, prob: str, label: str, target_accuracy: float = 0.75, group_cols: Sequence[str] = (),
    grid: Sequence[float] | None = None,
) -> DataFrame:
    """M9: cut-off whose accuracy is nearest ``target_accuracy``; the first (lowest) wins ties.

    Each row only needs how many grid points lie at or below its probability
    (k): it is predicted positive exactly for grid indices j < k. Rows fold to
    at most len(grid)+1 groups per key; per-threshold counts follow from a
    bounded explode of those few groups."""
    grid = list(grid or threshold_grid())
    g = list(group_cols)
    arr = F.array(*[F.lit(t) for t in grid])
    k = F.size(F.filter(arr, lambda t: t <= F.col(prob)))
    per_k = df.groupBy(*g, k.alias("_k")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    totals = per_k.groupBy(*g).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    idx = F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    above = per_k.where(F.col("_k") > 0).select(*g, idx.alias("_j"), "_pos", "_neg")
    tp_fp = above.groupBy(*g, "_j").agg(F.sum("_pos").alias("_tp"), F.sum("_neg").alias("_fp"))
    js = totals.select(*g, "_P", "_N", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))).alias("_j"))
    full = js.join(tp_fp, [*g, "_j"], "left").fillna(0, subset=["_tp", "_fp"])
    n = (F.col("_P") + F.col("_N")).cast("double")
    acc = (F.col("_tp") + (F.col("_N") - F.col("_fp"))).cast("double") / n
    scored = full.select(*g, "_j", acc.alias("accuracy"), F.abs(acc - F.lit(target_accuracy)).alias("_d"))
    best = scored.groupBy(*g).agg(F.min_by(F.struct("_j", "accuracy"), F.struct("_d", "_j")).alias("_best"))
    return best.select(
        *g, F.element_at(arr, F.col("_best._j") + 1).alias("threshold"), F.col("_best.accuracy").alias("accuracy")
    )


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], n_buckets: int | None = None) -> list[float | None]:
    """Linear-interpolated quantiles (numpy's default) computed exactly.

    Only the order statistics at floor/ceil of (n-1)q are located (filters on
    the distinct-value prefix counts); the handful of values come to the driver
    as fitted cut points."""
    counts = cut_lineage(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0]
    if not total:
        return [None for _ in qs]
    wanted: dict[int, float] = {}
    plan = []
    for q in qs:
        h = (total - 1) * q
        lo = int(np.floor(h))
        hi = min(lo + 1, total - 1)
        plan.append((lo, hi, h - lo))
        wanted[lo] = wanted[hi] = None
    idx = sorted(wanted)
    c = cumulative(counts, col, ["_n"], (), n_buckets)
    cond = None
    for i in idx:
        term = (F.col("cum__n") - F.col("_n") <= i) & (F.lit(i) < F.col("cum__n"))
        cond = term if cond is None else cond | term
    rows = c.where(cond).select(col, (F.col("cum__n") - F.col("_n")).alias("lo"), F.col("cum__n").alias("hi")).collect()
    for i in idx:
        for r in rows:
            if r["lo"] <= i < r["hi"]:
                wanted[i] = float(r[col])
    out = []
    for lo, hi, t in plan:
        a, b = wanted[lo], wanted[hi]
        out.append(a + (b - a) * t)
    return out
