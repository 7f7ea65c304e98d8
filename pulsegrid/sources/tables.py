"""Readers for the input tables and typed CSV inputs.

Parquet is read lazily: Catalyst prunes columns and pushes filters into the
scan, so callers never select up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema; malformed rows land in ``_corrupt_record``."""
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as string; a UTF-8 byte-order mark on the header is dropped."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def scan_sample(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """First ``n`` rows by ``key`` (a top-k: TakeOrderedAndProject, no full sort)."""
    return df.orderBy(F.col(key).asc_nulls_first()).limit(n)
