"""Session helpers.

Library functions never rely on session-level settings for correctness: all
timestamps stay ``timestamp_ntz`` (wall-clock, timezone-free) and every
division that may hit zero is guarded, so results do not depend on the
caller's timezone or ANSI mode. ``get_session`` only exists for tests, the
bench and scripts.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "pulsegrid") -> SparkSession:
    master = master or os.environ.get("PULSEGRID_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PULSEGRID_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``, a folder
    that driver and executors share).

    Only a local master (tests, the bench) gets a fresh temporary folder when
    it is unset; on a cluster an unset folder is an error, because a temporary
    folder of the driver is out of the executors' reach.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if current:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="pulsegrid-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and reread it: the
    plan starts anew, survives lost executors, and later scans still prune
    columns and push filters down."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does so when the
    driver collects its garbage, which with a large heap may be after the last step."""
    spark.sparkContext._jvm.System.gc()


def at_once(fn: Callable, keys: Sequence[str]) -> dict:
    """``fn`` of every key, their independent jobs submitted together: their stages
    share the executors."""
    with ThreadPoolExecutor(max_workers=len(keys)) as ex:
        return dict(zip(keys, ex.map(inheritable_thread_target(fn), keys)))
