import datetime as dt

from pulsegrid.operators import features as FT
from pulsegrid.operators import quality as Q

AS_OF = dt.date(2024, 2, 1)


def _email(spark, rows):
    return spark.createDataFrame(rows, "email_event_id string, hcp_id string, email_id string, event_type string, event_timestamp timestamp_ntz")


def test_email_rates_zero_denominator_and_recency(spark):
    t = dt.datetime(2024, 1, 30, 23, 0)
    df = _email(spark, [("1", "a", "m1", "click", t), ("2", "a", "m1", "click", t), ("3", "b", "m2", "delivered", t)])
    got = {r.hcp_id: r for r in FT.feat_email(df, AS_OF).collect()}
    a, b = got["a"], got["b"]
    assert a.email_open_rate is None and a.email_click_rate is None and a.email_ctor is None  # NULLIF(...,0)
    assert a.days_since_last_email_engagement == 2 and b.days_since_last_email_engagement is None
    assert b.email_open_rate == 0.0 and b.days_since_last_email_activity == 2


def test_clicks_without_open_not_in_semantics(spark):
    t = dt.datetime(2024, 1, 3)
    with_open = _email(spark, [("1", "a", "m1", "open", t), ("2", "a", "m2", "click", t), ("3", "a", None, "click", t),
                               ("4", "a", "m1", "click", t)])
    assert Q.clicks_without_open(with_open).collect()[0][0] == 1      # NULL id drops out of NOT IN
    no_open = _email(spark, [("2", "a", "m2", "click", t), ("3", "a", None, "click", t)])
    assert Q.clicks_without_open(no_open).collect()[0][0] == 2        # empty list: every click counts


def test_attendance_without_registration_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "e1", "registration"), ("a", "e1", "attendance"), ("a", "e2", "attendance"), ("a", None, "attendance"),
         ("a", None, "registration")],
        "hcp_id string, event_id string, event_activity_type string")
    assert Q.attendance_without_registration(df).collect()[0][0] == 2


def test_duplicate_and_null_reports(spark):
    df = spark.createDataFrame([("k1", None), ("k1", "x"), ("k2", "y"), (None, "z")], "k string, v string")
    assert Q.duplicate_key_count(df, "k").collect()[0][0] == 1
    r = Q.null_counts(df, ["k", "v"]).collect()[0]
    assert (r.null_k, r.null_v) == (1, 1)
