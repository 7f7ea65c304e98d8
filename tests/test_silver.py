import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.functions import cleaning as C
from pulsegrid.operators import silver as SV
from pulsegrid.plans.channels import EMAIL

T0 = dt.datetime(2024, 1, 5, 10, 0, 0)
T1 = dt.datetime(2024, 1, 6, 10, 0, 0)
COLS = ["email_event_id", "hcp_id", "campaign_id", "drug_id", "email_id", "event_type", "event_timestamp",
        "email_subject", "url", "device_type", "delivery_status", "source_system"]


def _bronze(spark, rows):
    full = [r + (None,) * (len(COLS) - len(r)) for r in rows]
    return spark.createDataFrame(full, "email_event_id string, hcp_id string, campaign_id string, drug_id string, "
                                 "email_id string, event_type string, event_timestamp timestamp_ntz, email_subject string, "
                                 "url string, device_type string, delivery_status string, source_system string")


def test_dedup_keeps_latest_then_gate(spark):
    rows = [
        ("e1", " h1 ", "c", "d", "m", "open", T0),
        ("e1", "h1", "c", "d", "m", " CLICK ", T1),       # latest copy wins
        ("e2", "h2", "c", "d", "m", "open", T0),
        ("e2", "h2", "c", "d", "m", "unknown", T1),       # latest copy invalid -> whole event removed
        (None, "h3", "c", "d", "m", "open", T0),          # NULL keys share one group
        (None, "h4", "c", "d", "m", "open", T1),
    ]
    out = {(r.email_event_id, r.hcp_id, r.event_type) for r in SV.to_silver(_bronze(spark, rows), EMAIL).collect()}
    assert out == {("e1", "h1", "click"), (None, "h4", "open")}


def test_blank_id_is_kept_and_text_cleaning(spark):
    rows = [("e9", "   ", " ", "d", "m", " OPEN ", T0, "  ", "", "Mobile", " Bounced ", "")]
    r = SV.to_silver(_bronze(spark, rows), EMAIL).collect()[0]
    assert r.hcp_id == "" and r.event_type == "open" and r.email_subject is None and r.url is None
    assert r.device_type == "mobile" and r.delivery_status == "bounced" and r.source_system is None


def test_scalar_cleaners(spark):
    df = spark.createDataFrame([("abc", "Yes"), ("-5", "0"), (None, "maybe"), ("3.5", " TRUE ")], "n string, b string")
    got = df.select(C.non_negative("n").alias("n"), C.parse_bool("b").alias("b")).collect()
    assert [(r.n, r.b) for r in got] == [(None, True), (None, False), (None, None), (3.5, True)]


def test_normalize_id(spark):
    df = spark.createDataFrame([("1",), ("hcp523",), (" HCP12345 ",), ("x7",), ("0",)], "v string")
    got = [r.o for r in df.select(C.normalize_id("v").alias("o")).collect()]
    assert got == ["HCP0001", "HCP0523", "HCP12345", "X7", "HCP0000"]


def test_pct_rescale_and_channel_key(spark):
    df = spark.createDataFrame([(0.5, "Sales_Rep"), (85.0, "sales rep"), (0.0, "Email")], "v double, c string")
    got = df.select(C.pct_rescale("v").alias("v"), C.channel_key("c").alias("c")).collect()
    assert [(r.v, r.c) for r in got] == [(50.0, "salesrep"), (85.0, "salesrep"), (0.0, "email")]


def test_latest_is_picked_on_the_raw_timestamp(spark):
    """An unparsable raw timestamp that sorts last wins, and the gate then removes the event."""
    rows = [("e1", "h1", "c", "d", "m", "open", "2024-01-05 10:00:00"), ("e1", "h1", "c", "d", "m", "open", "not a time"),
            ("e2", "h1", "c", "d", "m", "open", "2024-01-05 10:00:00"), ("e2", "h1", "c", "d", "m", "click", "2024-01-06 10:00:00")]
    df = spark.createDataFrame([r + (None,) * (len(COLS) - len(r)) for r in rows], ", ".join(f"{c} string" for c in COLS))
    assert [(r.email_event_id, r.event_type) for r in SV.to_silver(df, EMAIL).collect()] == [("e2", "click")]


def test_ties_have_one_winner_whatever_the_order(spark):
    """Copies of one key and time that differ in the last raw column only."""
    rows = [("e1", "h1", "c", "d", "m", "open", T0, "s", "u", "mobile", "delivered", x) for x in ("b", "a", "c")]
    got = {tuple(SV.to_silver(_bronze(spark, order).repartition(3), EMAIL).collect()[0]) for order in (rows, rows[::-1], rows[1:] + rows[:1])}
    assert len(got) == 1 and next(iter(got))[-1] == "a"


def test_only_raw_columns_are_shuffled(spark):
    """Cleaning happens above the window that picks the latest copy."""
    plan = SV.to_silver(_bronze(spark, [("e1", "h1", "c", "d", "m", "open", T0)]), EMAIL)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window [", 1)
    assert "lower(" in above and "lower(" not in below
