"""Bronze activity logs derived from the driver tables.

The driver ships TPC-H-style tables plus an ``events`` log, not engagement
logs, so each channel is a deterministic projection of one of them:

* master  <- customer x nation       (entity = customer)
* email   <- events                  (view/click/error/signup -> open/click/bounced/delivered)
* event   <- events                  (signup -> registration, purchase -> attendance)
* web     <- lineitem x orders       (entity = order's customer, key = orderkey-linenumber,
                                       which repeats: a real de-duplication case)
* rep     <- orders                  (priority -> interaction type, status -> outcome)

Orders and lineitems are moved onto the events' month (2024-01-01 + day-offset
mod 30) so every channel overlaps in time. The adapters deliberately emit
dirty text (upper case, padding, blanks) on a fixed id rule so the silver
cleaning has something to clean. The DuckDB oracle mirrors these projections
in SQL (``pulsegrid.plans.oracle``); the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources.tables import read_table

# Fixed values of the adapter (shared with the SQL mirror).
EPOCH_SRC = "1995-01-01"
EPOCH_DST = "2024-01-01"
DEVICE_WORDS = ["Desktop", " mobile ", "TABLET", "watch"]
WEB_DEVICE_WORDS = ["desktop", "Mobile ", "tablet", "tv"]
TRAFFIC_WORDS = ["Email", "organic search", " DIRECT", "professional referral", "social"]
CONTENT_TYPES = ["pdf", "video", "article", ""]
EVENT_TYPE_WORDS = ["webinar", " Medical Education", "PRODUCT LAUNCH", "expert panel", "Clinical discussion", "roundtable"]
FOLLOW_UP_WORDS = ["Yes", "no", "1", "0", "TRUE", "maybe"]


def _pick(idx: Column, words: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (idx + 1).cast("int"))


def _dirty(text: Column, rid: Column) -> Column:
    """Blank on id % 7 = 0, padded upper case on id % 7 = 1, clean otherwise."""
    return (
        F.when(rid % 7 == 0, F.lit(""))
        .when(rid % 7 == 1, F.concat(F.lit(" "), F.upper(text), F.lit(" ")))
        .otherwise(text)
    )


def _shift_ts(ts: Column, seconds: Column) -> Column:
    """Move a 1995-2001 date onto 2024-01-01 + (days mod 30), plus a time of day."""
    days = F.datediff(F.to_date(ts), F.lit(EPOCH_SRC).cast("date")) % 30
    day = F.date_add(F.lit(EPOCH_DST).cast("date"), days.cast("int"))
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=(seconds % 86400).cast("decimal(18,6)"))


def _padded_id(uid: Column, rid: Column) -> Column:
    return F.when(rid % 5 == 0, F.concat(F.lit(" "), uid.cast("string"), F.lit(" "))).otherwise(uid.cast("string"))


def bronze_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").cast("string").alias("hcp_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("c_mktsegment").alias("specialty"),
        F.lit(None).cast("string").alias("sub_specialty"),
        F.lit("clinic").alias("organization_type"),
        F.lit(None).cast("string").alias("city"),
        F.col("n_name").alias("state"),
        F.lit("N/A").alias("country"),
        F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active").alias("hcp_status"),
        F.lit("en").alias("preferred_language"),
        F.date_add(F.lit(EPOCH_DST).cast("date"), (F.col("c_custkey") % 30).cast("int"))
        .cast("timestamp_ntz")
        .alias("updated_at"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.withColumn("k", F.get_json_object("props", "$.k")).withColumn("kn", F.col("k").cast("bigint"))


def bronze_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    eid = F.col("event_id")
    base_type = (
        F.when(F.col("event_type") == "view", "open")
        .when(F.col("event_type") == "click", "click")
        .when(F.col("event_type") == "error", "bounced")
        .when(F.col("event_type") == "signup", "delivered")
        .otherwise(F.col("event_type"))
    )
    return e.select(
        eid.alias("email_event_id"),
        _padded_id(F.col("user_id"), eid).alias("hcp_id"),
        F.concat(F.lit("C"), (F.col("kn") % 10).cast("string")).alias("campaign_id"),
        F.concat(F.lit("D"), (F.col("kn") % 4).cast("string")).alias("drug_id"),
        F.when(eid % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("k")).alias("email_id"),
        _dirty(base_type, eid).alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.when(eid % 6 == 0, F.lit("  ")).otherwise(F.concat(F.lit("Subject "), F.col("k"))).alias("email_subject"),
        F.when(eid % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("https://example.org/e/"), F.col("k"))).alias("url"),
        _pick(eid % 4, DEVICE_WORDS).alias("device_type"),
        F.when(F.col("event_type") == "error", " Bounced")
        .when(F.col("event_type") == "purchase", "failed")
        .when(F.col("event_type") == "signup", "DELIVERED")
        .otherwise("pending")
        .alias("delivery_status"),
        F.when(eid % 9 == 0, F.lit(" ")).otherwise(F.lit("events")).alias("source_system"),
    )


def bronze_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    eid = F.col("event_id")
    et = F.col("event_type")
    base_activity = F.when(et == "signup", "registration").when(et == "purchase", "attendance").otherwise("view")
    return e.select(
        eid.alias("event_activity_id"),
        _padded_id(F.col("user_id"), eid).alias("hcp_id"),
        F.col("k").alias("event_id"),
        F.concat(F.lit("C"), (F.col("kn") % 10).cast("string")).alias("campaign_id"),
        F.concat(F.lit("D"), (F.col("kn") % 4).cast("string")).alias("drug_id"),
        F.when(eid % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("Event "), F.col("k"))).alias("event_name"),
        _pick(F.col("kn") % 6, EVENT_TYPE_WORDS).alias("event_type"),
        _dirty(base_activity, eid).alias("event_activity_type"),
        F.col("ts").alias("activity_timestamp"),
        F.when(et == "signup", F.lit(" registered ")).otherwise(F.lit("")).alias("registration_status"),
        F.when((et == "purchase") & (eid % 10 != 3), _pick(eid % 2, ["attended", " ATTENDED"]))
        .when(et == "purchase", F.lit("left early"))
        .otherwise(F.lit("Not applicable"))
        .alias("attendance_status"),
        F.when(et == "purchase", F.col("value") - 5.0).alias("attendance_duration_minutes"),
        ((F.col("kn") % 4).cast("double") - 1.0).alias("questions_asked"),
        (eid % 3).cast("double").alias("poll_responses"),
        _pick(eid % 4, DEVICE_WORDS).alias("device_type"),
        F.lit("events").alias("source_system"),
    )


def bronze_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    flag = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    base_type = (
        F.when(flag == "AF", "page_view")
        .when(flag == "AO", "content_view")
        .when(flag == "NF", "download")
        .when(flag == "NO", "video_start")
        .when(flag == "RF", "video_complete")
        .otherwise("scroll")
    )
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("web_event_id"),
        F.col("o_custkey").cast("string").alias("hcp_id"),
        F.col("l_orderkey").cast("string").alias("session_id"),
        F.concat(F.lit("C"), (F.col("l_partkey") % 10).cast("string")).alias("campaign_id"),
        F.concat(F.lit("D"), (F.col("l_suppkey") % 4).cast("string")).alias("drug_id"),
        _dirty(base_type, F.col("l_partkey")).alias("event_type"),
        _shift_ts(F.col("l_shipdate"), F.col("l_partkey") * 7 + F.col("l_suppkey") * 13).alias("event_timestamp"),
        F.concat(
            F.lit("/product/"),
            F.col("l_partkey").cast("string"),
            F.lit("?c="),
            F.floor(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
        ).alias("page_url"),
        F.when(F.col("l_suppkey") % 6 == 0, F.lit(" "))
        .otherwise(F.concat(F.lit("CT"), F.col("l_suppkey").cast("string")))
        .alias("content_id"),
        _pick(F.col("l_linenumber") % 4, CONTENT_TYPES).alias("content_type"),
        (F.col("l_quantity") * 10.0 - 50.0).alias("session_duration_seconds"),
        _pick(F.col("l_partkey") % 4, WEB_DEVICE_WORDS).alias("device_type"),
        _pick(F.col("l_suppkey") % 5, TRAFFIC_WORDS).alias("traffic_source"),
        F.lit("orders").alias("source_system"),
    )


def bronze_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    st = F.col("o_orderstatus")
    days = F.datediff(F.to_date("o_orderdate"), F.lit(EPOCH_SRC).cast("date")) % 30
    return o.select(
        ok.alias("veeva_event_id"),
        F.col("o_custkey").cast("string").alias("hcp_id"),
        F.concat(F.lit("I"), ok.cast("string")).alias("interaction_id"),
        F.concat(F.lit("C"), (ok % 10).cast("string")).alias("campaign_id"),
        F.concat(F.lit("D"), (F.col("o_custkey") % 4).cast("string")).alias("drug_id"),
        F.when(pr == "1-URGENT", "in-person visit")
        .when(pr == "2-HIGH", " PHONE CALL ")
        .when(pr == "3-MEDIUM", "Virtual Meeting")
        .when(pr == "4-NOT SPECIFIED", "email")
        .otherwise("")
        .alias("interaction_type"),
        _shift_ts(F.col("o_orderdate"), F.col("o_custkey") * 17 + ok).alias("interaction_timestamp"),
        (F.col("o_totalprice") / 1000.0 - 20.0).alias("interaction_duration_minutes"),
        F.when(st == "F", "completed").when(st == "O", "Cancelled ").otherwise("NO SHOW").alias("interaction_status"),
        F.when(ok % 5 == 0, F.lit("")).otherwise(F.lit("detailing")).alias("interaction_purpose"),
        F.concat(F.lit("topic "), (ok % 7).cast("string")).alias("discussion_topic"),
        _pick(ok % 6, FOLLOW_UP_WORDS).alias("follow_up_required"),
        F.when(ok % 4 == 0, F.lit("n/a"))
        .otherwise(F.date_add(F.lit(EPOCH_DST).cast("date"), (days + 7).cast("int")).cast("string"))
        .alias("follow_up_date"),
        F.concat(F.lit("R"), (F.col("o_custkey") % 50).cast("string")).alias("rep_id"),
        F.concat(F.lit("T"), (F.col("o_custkey") % 8).cast("string")).alias("territory"),
        F.lit("field").alias("channel"),
        F.lit("orders").alias("source_system"),
    )


BRONZE = {
    "email": bronze_email,
    "web": bronze_web,
    "rep": bronze_rep,
    "event": bronze_event,
}
