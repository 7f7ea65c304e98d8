"""Versioned layers and leak-free normalisation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import asof
from pulsegrid.sources import layers


def test_a_write_that_fails_midway_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert layers.replace_layer(spark.range(10), path) == 1
    breaks = spark.range(1000).repartition(4).withColumn("v", F.when(F.col("id") == 990, F.raise_error("broken row").cast("int")).otherwise(1))
    with pytest.raises(Exception, match="broken row"):
        layers.replace_layer(breaks, path)
    assert sorted(r.id for r in layers.read_layer(spark, path).collect()) == list(range(10))
    assert [v.version for v in layers.versions(spark, path)] == [1]


def test_versions_schema_and_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    layers.replace_layer(spark.range(3), path)
    pinned = layers.read_layer(spark, path, version=1)
    layers.replace_layer(spark.createDataFrame([("x", 1)], "name string, split int"), path, partition_by=["split"])
    assert pinned.count() == 3  # a reader keeps its version
    assert layers.read_layer(spark, path).columns == ["name", "split"]
    own = layers.read_layer(spark, path).withColumn("more", F.lit(2.5))  # reads what it replaces
    assert layers.replace_layer(own, path, keep=2) == 3
    assert layers.read_layer(spark, path).collect()[0].more == 2.5
    assert layers.read_layer(spark, path, version=2).count() == 1
    with pytest.raises(Exception):
        layers.read_layer(spark, path, version=1).count()  # dropped by keep
    with pytest.raises(ValueError):
        layers.read_layer(spark, path, version=9)
    with pytest.raises(ValueError):
        layers.read_layer(spark, str(tmp_path / "none"))


def test_each_date_sees_only_earlier_days(spark):
    ts = lambda day: dt.datetime(2024, 1, day, 12)
    email = [("a", "delivered", ts(2)), ("a", "open", ts(3)), ("b", "delivered", ts(2)), ("b", "delivered", ts(8)), ("b", "open", dt.datetime(2024, 1, 5))]
    schema = "hcp_id string, event_type string, event_timestamp timestamp_ntz"
    silvers = {"email": spark.createDataFrame(email, schema)}
    silvers["web"] = spark.createDataFrame([], schema + ", session_duration_seconds double")
    silvers["rep"] = spark.createDataFrame([], "hcp_id string, interaction_status string, interaction_duration_minutes double, interaction_timestamp timestamp_ntz")
    silvers["event"] = spark.createDataFrame(
        [], "hcp_id string, event_activity_type string, attendance_duration_minutes double, questions_asked double, poll_responses double, activity_timestamp timestamp_ntz"
    )
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "hcp_id string")
    dates = [dt.date(2024, 1, 5), dt.date(2024, 1, 9)]
    early = asof.features_asof(silvers, ids, dates, dt.date(2024, 1, 1))
    got = {(r.hcp_id, r.snapshot_date.day): r for r in asof.features_normalized_asof(early).collect()}
    # on the 5th: b's open at midnight of that day and its delivery on the 8th do not exist yet
    assert [got[i, 5].norm_email_delivered for i in "abc"] == [1.0, 1.0, 0.0]
    assert [got[i, 5].norm_email_open_rate for i in "abc"] == [1.0, 0.0, 0.0]
    assert [got[i, 5].norm_email_recency for i in "abc"] == [1.0, 0.0, 0.0]
    assert [got[i, 9].norm_email_delivered for i in "abc"] == [0.5, 1.0, 0.0]
    assert [got[i, 9].norm_email_open_rate for i in "abc"] == [1.0, 0.5, 0.0]
    assert [got[i, 9].norm_web_recency for i in "abc"] == [0.0] * 3  # constant
    # rows of later days change nothing
    later = silvers | {"email": silvers["email"].unionByName(spark.createDataFrame([("c", "delivered", ts(20))] * 9, schema))}
    again = asof.features_normalized_asof(asof.features_asof(later, ids, dates, dt.date(2024, 1, 1)))
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in got.values()}
