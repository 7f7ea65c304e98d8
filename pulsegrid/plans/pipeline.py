"""The layered batch run: bronze -> silver -> features -> unified -> snapshots -> gold.

Each layer is written once (S5, S6) as a new version that readers see whole or
not at all (``sources.layers``), and the next layer reads it back. Written
layers also cut lineage: a lost executor recomputes from the last written
layer, never from the raw logs. ``out_dir`` must be shared storage on a
cluster (by default the session's checkpoint folder).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import PROFILE_A, Profile, RunConfig
from pulsegrid.operators import features as FT
from pulsegrid.operators import quality as Q
from pulsegrid.operators import serving as SE
from pulsegrid.operators import silver as SV
from pulsegrid.operators import snapshots as SN
from pulsegrid.operators import unify as U
from pulsegrid.session import ensure_checkpoint_dir
from pulsegrid.sources.adapters import BRONZE, bronze_master
from pulsegrid.sources.layers import read_layer, replace_layer

CHANNELS = ("email", "web", "rep", "event")


class Timer:
    def __init__(self) -> None:
        self.times: dict[str, float] = {}

    def run(self, name: str, fn: Callable[[], object]):
        t = time.time()
        out = fn()
        self.times[name] = round(time.time() - t, 3)
        return out


def run_pipeline(
    spark: SparkSession,
    sf_dir: str,
    out_dir: str | None = None,
    p: Profile = PROFILE_A,
    cfg: RunConfig = RunConfig(),
    timer: Timer | None = None,
    n_trees: int = 100,
) -> dict[str, str]:
    """Run every layer; returns the written paths. Timings go to ``timer``."""
    from pulsegrid.plans import queries as QY

    timer = timer or Timer()
    out = (out_dir or ensure_checkpoint_dir(spark)).rstrip("/")
    paths: dict[str, str] = {}

    def rd(path: str):
        return read_layer(spark, path)


    def each_channel(fn) -> None:
        """Independent per-channel jobs are submitted together; Spark interleaves
        their stages on the shared executors."""
        with ThreadPoolExecutor(max_workers=len(CHANNELS)) as ex:
            list(ex.map(inheritable_thread_target(fn), CHANNELS))

    def silver_one(ch):
        paths[f"silver_{ch}"] = f"{out}/silver_{ch}"
        path, rows = paths[f"silver_{ch}"], SV.to_silver(BRONZE[ch](spark, sf_dir), SV.SPECS[ch])
        checks = Q.observed(rows, Q.scalar_checks(SV.SPECS[ch]), lambda df: replace_layer(df, path))
        paths[f"quality_{ch}"] = f"{out}/quality_{ch}"
        replace_layer(checks.coalesce(1), paths[f"quality_{ch}"])

    def silver_layer():
        each_channel(silver_one)

    timer.run("silver", silver_layer)
    sv = {ch: rd(paths[f"silver_{ch}"]) for ch in CHANNELS}

    def feature_one(ch):
        paths[f"feat_{ch}"] = f"{out}/feat_{ch}"
        replace_layer(FT.FEATURES[ch](sv[ch], cfg.as_of), paths[f"feat_{ch}"])

    def feature_layer():
        each_channel(feature_one)

    timer.run("features", feature_layer)
    feats = {ch: rd(paths[f"feat_{ch}"]) for ch in CHANNELS}
    master = bronze_master(spark, sf_dir)

    def quality_one(ch):
        spec = SV.SPECS[ch]
        Q.duplicate_key_count(sv[ch], spec.key).collect()
        Q.category_distribution(sv[ch], spec.categories).collect()
        extra = {"email": Q.clicks_without_open, "event": Q.attendance_without_registration, "web": Q.session_validation}
        if ch in extra:
            extra[ch](sv[ch]).collect()

    def quality_layer():
        # scalar checks were observed while silver was written; these need a shuffle
        each_channel(quality_one)

    timer.run("quality", quality_layer)

    def unify_layer():
        paths["features_complete"] = f"{out}/features_complete"
        replace_layer(U.features_complete(U.features_raw(master, feats), cfg.recency_fill), paths["features_complete"])
        complete = rd(paths["features_complete"])
        paths["features_final"] = f"{out}/features_final"
        replace_layer(U.features_final_direct(complete), paths["features_final"])

    timer.run("unify", unify_layer)
    final = rd(paths["features_final"])
    normalized = final.select("hcp_id", *U.NORM_COLUMNS)

    def snapshot_layer():
        ids = master.select("hcp_id").where(F.col("hcp_id").isNotNull()).distinct()
        snap = SN.snapshot_features(sv, ids, normalized, p)
        snap = SN.attach_labels(snap, SN.snapshot_labels(sv, p))
        paths["snapshots"] = f"{out}/snapshots_{p.name}"
        replace_layer(snap, paths["snapshots"], partition_by=["split"])

    timer.run("snapshots", snapshot_layer)
    snap = rd(paths["snapshots"])

    fitted: dict = {}

    def train_layer():
        fitted.update(QY.train_models(snap, p, n_trees))

    timer.run("train", train_layer)

    def scoring_layer():
        fitted.update(QY.calibrate_models(fitted, p))
        paths["scores"] = f"{out}/scores_{p.name}"
        replace_layer(QY.final_scores(spark, sf_dir, p, scored=fitted["scored"]), paths["scores"])

    timer.run("scoring", scoring_layer)

    def explain_layer():
        paths["gold"] = f"{out}/gold_{p.name}"
        replace_layer(QY.explain_gold(rd(paths["scores"]), fitted, p), paths["gold"])

    timer.run("explain", explain_layer)
    gold = rd(paths["gold"])

    def serving_layer():
        SE.dashboard(gold, master).collect()
        d = SE.directory(master, gold)
        SE.search_directory(d, "furn").collect()
        SE.filter_counts(d, "Sales_Rep", "high").collect()
        rows, meta = SE.paginate(sv["email"], "email_event_id", 3, 1000)
        rows.collect()
        meta.collect()

    timer.run("serving", serving_layer)
    return paths
