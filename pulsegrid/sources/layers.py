"""Layer tables that are replaced as a whole or not at all.

Every write goes to a folder of its own; then one manifest row names it as the
next version. Readers look the newest version up in the manifest, or pin one,
so a write that fails midway leaves readers with the rows they had: its folder
is named nowhere. The manifest is a table of one-row files; a row becomes
visible when its file is committed, in one step.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_manifest"
_ROW = "version long, folder string, format string, schema string"


def versions(spark: SparkSession, path: str) -> list:
    """Manifest rows (version, folder, format, schema), the newest first."""
    try:
        rows = spark.read.schema(_ROW).json(f"{path.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return rows.orderBy(F.desc("version"), F.desc("folder")).collect()


def replace_layer(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, keep: int | None = 2) -> int:
    """Write ``df`` as the next version of the table at ``path``; its number.

    The newest ``keep`` versions stay readable (None: all), older ones are
    deleted after the switch. ``df`` may read the table it replaces.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    past = versions(spark, path)
    number = past[0].version + 1 if past else 1
    folder = f"v{number}-{uuid.uuid4().hex}"
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/{folder}")
    row = spark.createDataFrame([(number, folder, fmt, df.schema.json())], _ROW)
    row.coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")
    if keep is not None:
        for old in past[max(0, keep - 1) :]:
            _delete(spark, f"{path}/{old.folder}")
    return number


def read_layer(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a layer table, or the pinned one."""
    found = [v for v in versions(spark, path) if version in (None, v.version)]
    if not found:
        raise ValueError(f"no version {'' if version is None else version} of {path}")
    schema = T.StructType.fromJson(json.loads(found[0].schema))
    return spark.read.format(found[0].format).schema(schema).load(f"{path.rstrip('/')}/{found[0].folder}")


def _delete(spark: SparkSession, folder: str) -> None:
    """Remove a folder through Spark's own file system layer (local, HDFS or a store)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
