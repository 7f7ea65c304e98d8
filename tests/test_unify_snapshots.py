import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.config import PROFILE_A, PROFILE_B
from pulsegrid.operators import snapshots as SN
from pulsegrid.operators import unify as U


def test_minmax_constant_column_and_inversion(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", 2.0, 5.0)], "hcp_id string, x double, k double")
    stats = {"min_x": 1.0, "max_x": 3.0, "min_k": 5.0, "max_k": 5.0}
    got = df.select("hcp_id", U._scaled(F.col("x"), stats["min_x"], stats["max_x"], False).alias("n"),
                    U._scaled(F.col("x"), 1.0, 3.0, True).alias("inv"),
                    U._scaled(F.col("k"), 5.0, 5.0, False).alias("c")).orderBy("hcp_id").collect()
    assert [(r.n, r.inv, r.c) for r in got] == [(0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.5, 0.5, 0.0)]


def _windows(spark, p, history):
    T = p.current_date
    d = p.hist_days if history else p.fut_days
    base = dt.datetime.combine(T, dt.time())
    pts = {"at_T": base, "start": base - dt.timedelta(days=d), "end": base + dt.timedelta(days=d),
           "before_start": base - dt.timedelta(days=d, microseconds=1)}
    df = spark.createDataFrame([(k, v) for k, v in pts.items()], "name string, ts timestamp_ntz")
    one = dataclasses.replace(p, train_dates=(), val_dates=(), test_dates=())
    w = SN.history_windows(one) if history else SN.label_windows(one)
    return {r.name for r in w.inside(df, "ts").select("name", F.explode(w.dates_of_pane()).alias("d")).where(F.col("d") == F.lit(T)).collect()}


def test_window_boundaries_profiles(spark):
    assert _windows(spark, PROFILE_A, True) == {"at_T", "start"}          # [T-h, T]
    assert _windows(spark, PROFILE_B, True) == {"start"}                  # [T-h, T)
    assert _windows(spark, PROFILE_A, False) == {"end"}                   # (T, T+f]
    assert _windows(spark, PROFILE_B, False) == {"at_T"}                  # [T, T+f)


def test_spine_every_entity_every_date(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "hcp_id string")
    sp = SN.spine(ids, PROFILE_A)
    assert sp.count() == 2 * len(PROFILE_A.all_dates())
    assert sp.select("hcp_id", "snapshot_date").distinct().count() == sp.count()
