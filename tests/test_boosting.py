"""Boosted trees grown together against MLlib's own training."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from pulsegrid.config import PROFILE_A
from pulsegrid.operators import boosting as B
from pulsegrid.operators import models as ML

COLS = [f"f{i}" for i in range(7)]


def _rows(spark, n=4000):
    """Labels with noise everywhere: where a node is pure, MLlib's rounding errors decide."""
    u = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0
    x = spark.range(0, n, 1, 3).select("id", *[F.floor(u(i) * [2, 5, 40, 900][i % 4]).cast("double").alias(c) for i, c in enumerate(COLS)], F.lit(3.0).alias("same"))
    x = x.withColumn("t0", ((F.col("f2") > 22) != (u(90) < 0.2)).cast("int")).withColumn("t1", ((F.col("f1") * F.col("f3") > 1100) != (u(91) < 0.3)).cast("int"))
    return x.withColumn("split", F.when(F.col("id") < n // 3, "val").otherwise("train")).persist()  # a partition without train rows


def test_generators_are_those_of_the_jvm(spark):
    for seed in (0, 42, -7, 2**40 + 1):
        theirs = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        first, state = B.xorshift_doubles(B.xorshift_seed(seed), 77)
        more, _ = B.xorshift_doubles(state, 50)
        assert [*first, *more] == [theirs.nextDouble() for _ in range(127)]
        theirs, mine = spark._jvm.scala.util.Random(seed), B.JavaRandom(seed)
        assert [mine.next_long() for _ in range(20)] == [theirs.nextLong() for _ in range(20)]


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("plain_rows", [B.PLAIN_ROWS, 0])
def test_ensembles_equal_mllib(spark, monkeypatch, weighted, plain_rows):
    monkeypatch.setattr(B, "PLAIN_ROWS", plain_rows)
    monkeypatch.setattr(B, "FAN_IN", B.FAN_IN if plain_rows else 1)  # then merged in Spark
    cols = [*COLS, "same"]
    train = _rows(spark).where("split = 'train'")
    got = B.fit(train, cols, ["t0", "t1"], 0.05, weighted, 4, 42)
    for t in ("t0", "t1"):
        x = ML.with_features(train, cols).select("id", "features", F.col(t).cast("double").alias("label"))
        pos, n = x.where("label = 1").count(), x.count()
        x = x.withColumn("w", F.when(F.col("label") == 1, (n - pos) / pos if weighted else 1.0).otherwise(1.0))
        theirs = GBTClassifier(maxIter=4, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42, weightCol="w").fit(x)
        a, b = ({r.id: r.probability[1] for r in m.transform(x).select("id", "probability").collect()} for m in (theirs, got[t]))
        assert a == pytest.approx(b, abs=1e-9)
        assert [m.numNodes for m in got[t].trees] == [m.numNodes for m in theirs.trees] and got[t].treeWeights == theirs.treeWeights
        leaves, wanted = (sorted(v for _, v, _ in ML.leaf_paths(ML.extract_trees(m))) for m in (got[t], theirs))
        assert leaves == pytest.approx(wanted, abs=1e-9)


def test_targets_share_their_jobs(spark):
    """One job a level for all targets, not one a level and target."""
    sc = spark.sparkContext
    frames = _rows(spark)
    frames.count()
    trees = 6
    sc.setJobGroup("boosting", "boosting")
    try:
        got = ML.fit_channel_models(frames, COLS, PROFILE_A, ["t0", "t1"], n_trees=trees)
        jobs = len(sc.statusTracker().getJobIdsForGroup("boosting"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert all(m.getNumTrees == trees for m in got.values())
    assert 0 < jobs <= 4 * trees + 8


def test_groups_keep_every_bin():
    g = B.Groups([3, 1, 32, 33, 5, 2000, 2])
    assert all(s <= max(B.CELLS, 2000) for s in g.sizes) and g.group[1] == -1
    rng = np.random.default_rng(3)
    bins = np.array([rng.integers(0, b, 500) for b in g.bins])
    index = np.zeros((len(g.sizes), 500), np.uint16)
    for f in range(len(bins)):
        if g.group[f] >= 0:
            index[g.group[f]] += (bins[f] * g.stride[f]).astype(np.uint16)
    for f in range(len(bins)):
        assert (g.bin_of(index, f, np.arange(500)) == bins[f]).all()
    place = rng.integers(0, 3, 500)
    joint = [np.bincount(place * s + i, minlength=3 * s).reshape(1, 3, s).astype(float) for s, i in zip(g.sizes, index)]
    sums = g.marginals(joint)
    for f, b in enumerate(bins):
        for k in range(3):
            assert (sums[k, 0, f] == np.bincount(b[place == k], minlength=2000)).all()
