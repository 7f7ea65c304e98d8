from pyspark.sql import types as T

from pulsegrid.sources import sinks
from pulsegrid.sources.tables import read_csv_raw, read_csv_typed


def test_raw_csv_strips_bom_and_keeps_strings(spark, tmp_path):
    p = tmp_path / "email.csv"
    p.write_text("﻿email_event_id,hcp_id,session_duration_seconds\n1,HCP0001,12.5\n2,HCP0002,abc\n", encoding="utf-8")
    df = read_csv_raw(spark, str(p))
    assert df.columns == ["email_event_id", "hcp_id", "session_duration_seconds"]
    assert {f.dataType for f in df.schema.fields} == {T.StringType()}
    assert df.count() == 2


def test_typed_csv_keeps_malformed_rows(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("id,v\n1,2.5\n2,notanumber\n", encoding="utf-8")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    rows = {r.id: r for r in read_csv_typed(spark, str(p), schema).collect()}
    assert rows[1].v == 2.5 and rows[1]._corrupt_record is None
    assert rows[2].v is None and rows[2]._corrupt_record is not None


def test_layer_and_report_writers(spark, tmp_path):
    m = spark.createDataFrame([("Email", 0.7954, 0.9805), ("Overall", 0.6991, 0.7548)], "channel string, roc_auc double, pr_auc double")
    sinks.write_layer(m, str(tmp_path / "layer"))
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 2
    sinks.write_report(m, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert any("Overall" in x and "0.6991" in x for x in lines)
    sinks.write_csv(m, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
