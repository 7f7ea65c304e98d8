import threading

import pytest
from pyspark.sql import functions as F

from pulsegrid.config import PROFILE_A
from pulsegrid.operators import models as ML
from pulsegrid.operators import scoring as SC
from pulsegrid.plans import queries as Q
from pulsegrid.session import cut_lineage

COLS = ["a", "b", "total_touchpoints"]


def _snapshots(spark, n=400):
    split = F.element_at(F.array(*map(F.lit, ("train", "train", "val", "test", "current"))), (F.col("id") % 5 + 1).cast("int"))
    noise = F.pmod(F.xxhash64("id"), F.lit(100))
    rows = spark.range(0, n, 1, 4).select(
        F.col("id").cast("string").alias("hcp_id"), F.lit("2024-01-10").cast("date").alias("snapshot_date"), split.alias("split"),
        (F.col("id") % 17).alias("a"), F.when(F.col("id") % 11 != 0, noise / 10.0).alias("b"), (F.col("id") % 7 + noise % 3).alias("total_touchpoints"),
        *[((F.col("id") * k + noise) % 5 < 2).cast("int").alias(t) for k, t in enumerate(SC.TARGETS, 1)],
    )
    return cut_lineage(rows)


def test_four_models_read_their_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def noted(x):
        read.add(1)
        return x

    frames = ML.coerce_features(_snapshots(spark), COLS).withColumn("a", noted("a"))
    models = ML.fit_channel_models(frames, COLS, PROFILE_A, SC.TARGETS, n_trees=2)
    assert set(models) == set(SC.TARGETS) and all(m.getNumTrees == 2 for m in models.values())
    assert read.value == frames.where(F.col("split") == "train").count()


def test_only_the_scored_rows_are_written(spark, monkeypatch):
    snap, writes = _snapshots(spark), []
    monkeypatch.setattr(Q, "cut_lineage", lambda df: writes.append(df.columns) or cut_lineage(df))
    r = Q.calibrate_models(Q.train_models(snap, PROFILE_A, n_trees=2), PROFILE_A)
    assert len(writes) == 1
    got = {x.hcp_id: x for x in r["scored"].collect()}
    assert len(got) == snap.count() and r["cols"] == COLS

    frames = ML.coerce_features(snap, COLS)
    want = ML.history_score(frames.where(F.col("split") == "train"), frames, COLS)
    assert {x.hcp_id: x.hist_score for x in want.collect()} == {k: x.hist_score for k, x in got.items()}
    assert got["0"].b == 0.0  # a NULL feature counts as 0
    for p, t in zip(SC.PROBS, SC.TARGETS):
        alone = r["models"][t].transform(ML.with_features(frames, COLS)).select("hcp_id", "probability")
        for x in alone.collect():
            assert got[x.hcp_id][f"_raw_{t}"] == x.probability[1]
        slope, cut = r["platt"][t]
        assert (slope, cut) == pytest.approx(ML.fit_platt(r["scored"].where(F.col("split") == "val"), f"_raw_{t}", t))
        assert got["3"][p] == pytest.approx(1 / (1 + 2.718281828459045 ** -(slope * got["3"][f"_raw_{t}"] + cut)))
    total = sum(w * got["3"][p] for w, p in zip(PROFILE_A.channel_weights, SC.PROBS))
    assert got["3"].pred_score == pytest.approx(100 * total)


def test_silver_logs_are_written_at_the_same_time(spark, monkeypatch):
    together = threading.Barrier(4, timeout=30)  # broken if one waits for another's job

    def waiting(spark, sf_dir, ch):
        together.wait()
        return spark.createDataFrame([(ch,)], "channel string")

    monkeypatch.setattr(Q.SV, "silver", waiting)
    assert {k: v.first().channel for k, v in Q.silvers(spark, "unread").items()} == {c: c for c in Q.CHANNELS}
