"""Sinks: layer tables, gold table, JDBC export, CSV and text reports.

All writes are distributed (each task writes its own files); nothing is
collected. Paths should point at shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators.serving import export_lowercase


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace a layer table (CREATE OR REPLACE semantics)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_gold(df: DataFrame, path_or_table: str, fmt: str = "parquet", as_table: bool = False) -> None:
    """Overwrite the gold table, replacing its schema (``overwriteSchema`` where supported)."""
    w = df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
    if as_table:
        w.saveAsTable(path_or_table)
    else:
        w.save(path_or_table)


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append", run_id: int | None = None) -> None:
    """Lower-cased column names (and the run id, see ``export_lowercase``),
    appended to a JDBC table. Connection details come from the caller only
    (nothing is stored in code)."""
    out = export_lowercase(df, run_id)
    out.write.mode(mode).jdbc(url, table, properties=properties)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(metrics: DataFrame, path: str, title: str = "Model evaluation report") -> None:
    """A metrics table as fixed-width text lines (one small partition)."""
    cols = [c for c in metrics.columns if c != "channel"]
    line = F.format_string("%-10s " + " ".join(["%10.4f"] * len(cols)), F.col("channel"), *[F.col(c) for c in cols])
    header = metrics.sparkSession.createDataFrame(
        [(title,), ("%-10s " % "channel" + " ".join("%10s" % c for c in cols),)], "value string"
    )
    header.unionByName(metrics.select(line.alias("value"))).coalesce(1).write.mode("overwrite").text(path)
