import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.operators import metrics as M
from pulsegrid.operators import scoring as SC


def _data(n=300, seed=3):
    rnd = random.Random(seed)
    return [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(n)]  # many ties


def _brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _brute_pr(rows):
    P = sum(y for _, y in rows)
    th = sorted({s for s, _ in rows}, reverse=True)
    pts, trap, ap, prev_r, prev_p = [], 0.0, 0.0, 0.0, 1.0
    for t in th:
        tp = sum(1 for s, y in rows if s >= t and y == 1)
        fp = sum(1 for s, y in rows if s >= t and y == 0)
        r, p = tp / P, tp / (tp + fp)
        trap += (r - prev_r) * (p + prev_p) / 2
        ap += (r - prev_r) * p
        prev_r, prev_p = r, p
    return trap, ap


def test_auc_pr_vs_brute_force(spark):
    rows = _data()
    df = spark.createDataFrame(rows, "s double, y int")
    auc = M.roc_auc(df, "s", "y", n_buckets=4).collect()[0][0]
    pr = M.pr_metrics(df, "s", "y", n_buckets=4).collect()[0]
    trap, ap = _brute_pr(rows)
    assert abs(auc - _brute_auc(rows)) < 1e-12
    assert abs(pr.pr_auc - trap) < 1e-12 and abs(pr.average_precision - ap) < 1e-12


def test_spearman_and_ranks(spark):
    import pandas as pd

    rows = [(float(a), float(b)) for a, b in zip([1, 2, 2, 3, 5, 5, 5, 9], [3, 1, 4, 1, 5, 9, 2, 6])]
    df = spark.createDataFrame(rows, "x double, y double")
    got = M.spearman(df, "x", "y", n_buckets=3).collect()[0][0]
    pdf = pd.DataFrame(rows, columns=["x", "y"])
    assert abs(got - pdf["x"].rank().corr(pdf["y"].rank())) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    vals = [float(v) for v in [5, 1, 9, 9, 2, 7, 3, 3, 3, 10, 0.5]]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = M.exact_quantiles(df, "v", [0.3333, 0.6667, 0.0, 1.0], n_buckets=3)
    want = [np.percentile(vals, q * 100) for q in (0.3333, 0.6667, 0.0, 1.0)]
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_threshold_search_vs_brute(spark):
    rows = _data(200, 7)
    df = spark.createDataFrame(rows, "p double, y int")
    got = M.threshold_search(df, "p", "y").collect()[0]
    best, bd = None, 1.0
    for t in M.threshold_grid():
        acc = sum((p >= t) == (y == 1) for p, y in rows) / len(rows)
        if abs(acc - 0.75) < bd:
            best, bd = t, abs(acc - 0.75)
    assert got.threshold == best


def test_next_best_channel_first_wins_ties(spark):
    df = spark.createDataFrame([(0.3, 0.5, 0.5, 0.1), (0.2, 0.2, 0.2, 0.2)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(SC.next_best_channel([F.col(c) for c in "abcd"], SC.channel_labels())).collect()]
    assert got == ["Website", "Email"]


def test_tiers_inclusive_vs_exclusive(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (30.0,)], "s double")
    inc = [r[0] for r in df.select(SC.tiers("s", 10.0, 20.0, True)).collect()]
    exc = [r[0] for r in df.select(SC.tiers("s", 10.0, 20.0, False)).collect()]
    assert inc == ["Low", "Medium", "High"] and exc == ["Medium", "High", "High"]


def test_simplex_qp_vs_grid():
    rng = np.random.default_rng(0)
    Pm = rng.random((50, 4))
    y = rng.random(50)
    G, b = Pm.T @ Pm, Pm.T @ y
    w = SC.solve_simplex_qp(G, b)
    f = lambda v: v @ G @ v - 2 * b @ v
    grid = [np.array(c) / 20 for c in itertools.product(range(21), repeat=4) if sum(c) == 20]
    assert abs(w.sum() - 1) < 1e-9 and (w >= -1e-12).all()
    assert f(w) <= min(f(g) for g in grid) + 1e-12


def test_top_drivers(spark):
    df = spark.createDataFrame([([0.1, -0.2, 0.5, 0.3],), ([-0.1, -0.2, -0.05, -0.3],)], "a array<double>")
    got = [r[0] for r in df.select(SC.top_drivers("a", ["f0", "f1", "f2", "f3"])).collect()]
    assert got == [["f2", "f3"], ["f2"]]


def test_ranked_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = [(float(i % 37), float(i % 5), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, label int").mapInPandas(counted, "x double, y double, label int")
    for run in (
        lambda: M.spearman(df, "x", "y", n_buckets=3),
        lambda: M.roc_auc(df, "x", "label", n_buckets=3),
        lambda: M.pr_metrics(df, "x", "label", n_buckets=3),
    ):
        seen.value = 0
        run().collect()
        assert seen.value == len(rows)
    seen.value = 0
    M.exact_quantiles(df, "x", [0.25, 0.75], n_buckets=3)
    assert seen.value == len(rows)
