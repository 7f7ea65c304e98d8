"""Merged co-moments against numpy on all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import models as ML
from pulsegrid.operators.comoments import Moments, comoments


def test_states_merge_like_one_pass():
    x = np.random.default_rng(1).normal(size=(500, 4)) * [1, 1e6, 1e-3, 0] + [100, 5, 0, 0.1]
    parts = [Moments.of(x[a:b]) for a, b in ((0, 1), (1, 200), (200, 500))]
    m = Moments.empty(4)
    for p in parts:
        m = m.merged(p)
    assert np.allclose(m.mean, x.mean(0)) and np.allclose(np.diag(m.products)[:3] / 500, x.var(0)[:3])
    assert m.deviations()[3] == 1.0 and (m.correlations()[3] == 0).all()  # constant column
    assert np.allclose(m.correlations()[:3, :3], np.corrcoef(x[:, :3].T))


def test_history_score_from_one_matrix(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=300)
    x = np.stack([base * k + r.normal(size=300) for k in (3, -2, 1)] + [np.full(300, 0.1)], axis=1)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, total_touchpoints double, k double").repartition(5)
    cols = ["a", "b", "total_touchpoints", "k"]
    m = comoments(df, cols)
    assert m.n == 300 and np.allclose(m.mean, x.mean(0))
    z = (x - x.mean(0)) / np.where(x.std(0) > 1e-12, x.std(0), 1)
    values, vectors = np.linalg.eigh(np.cov(z.T, bias=True))
    pc = z @ vectors[:, -1]
    pc = pc if np.corrcoef(pc, x[:, 2])[0, 1] >= 0 else -pc
    want = (pc - pc.min()) / (pc.max() - pc.min()) * 100
    got = {r.id: r.hist_score for r in ML.history_score(df, df, cols).collect()}
    assert np.allclose([got[i] for i in range(300)], want)
    assert abs(ML.fit_history(df, cols, cols, "total_touchpoints")["explained"] - values[-1] / 3) < 1e-9


def test_no_rows(spark):
    none = spark.range(0).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("total_touchpoints"))
    assert comoments(none, ["a", "total_touchpoints"]).n == 0
    assert ML.history_score(none, none, ["a", "total_touchpoints"]).count() == 0


def test_training_matrix_is_not_written_for_one_pass(spark, monkeypatch):
    from pulsegrid.plans import queries as Q

    snap = spark.createDataFrame([(str(i), "train" if i % 3 else "val", float(i), float(i * i % 7), None) for i in range(30)], "hcp_id string, split string, a double, b double, c double")
    monkeypatch.setattr(Q, "snapshot_table", lambda *a, **k: snap)
    monkeypatch.setattr(Q, "cut_lineage", lambda df: pytest.fail("written"))
    train, cols = Q._train_features(spark, "unread")
    assert cols == ["a", "b", "c"] and train.count() == 20 and train.where("c = 0").count() == 20
    assert {(r.a, r.b): r.r for r in Q._q_feature_correlation(spark, "unread").collect()}[("a", "a")] == 1.0
