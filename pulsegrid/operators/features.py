"""Silver -> per-entity channel features (one row per ``hcp_id``).

One ``groupBy(hcp_id).agg`` per channel: counts are written once as
``count_if`` and ratios are derived in a second projection, so the shuffle
carries only partial sums (map-side combine); a hot entity therefore costs
one partial row per map task. ``count_distinct`` (sessions) is planned as an
Expand + two-level aggregate that spreads a hot entity over its distinct
values before the final merge.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.cleaning import exact_avg, ratio


def _n(cond: Column) -> Column:
    """A3: SUM(CASE WHEN cond THEN 1 ELSE 0 END) as bigint (NULL cond -> 0)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _days_since(as_of: dt.date, ts: Column) -> Column:
    """Whole days from the last timestamp's date to ``as_of``; NULL if never."""
    return F.datediff(F.lit(as_of.isoformat()).cast("date"), F.to_date(ts))


def feat_email(silver: DataFrame, as_of: dt.date) -> DataFrame:
    et = F.col("event_type")
    eng_ts = F.max(F.when(et.isin("open", "click"), F.col("event_timestamp")))
    g = silver.groupBy("hcp_id").agg(
        _n(et == "delivered").alias("emails_delivered"),
        _n(et == "bounced").alias("emails_bounced"),
        _n(et == "open").alias("email_opens"),
        _n(et == "click").alias("email_clicks"),
        F.max("event_timestamp").alias("last_email_activity"),
        eng_ts.alias("last_email_engagement"),
    )
    return g.select(
        "hcp_id",
        "emails_delivered",
        "emails_bounced",
        "email_opens",
        "email_clicks",
        ratio(F.col("email_opens"), F.col("emails_delivered")).alias("email_open_rate"),
        ratio(F.col("email_clicks"), F.col("emails_delivered")).alias("email_click_rate"),
        ratio(F.col("email_clicks"), F.col("email_opens")).alias("email_ctor"),
        "last_email_activity",
        "last_email_engagement",
        _days_since(as_of, F.col("last_email_engagement")).alias("days_since_last_email_engagement"),
        _days_since(as_of, F.col("last_email_activity")).alias("days_since_last_email_activity"),
    )


def feat_web(silver: DataFrame, as_of: dt.date) -> DataFrame:
    et = F.col("event_type")
    g = silver.groupBy("hcp_id").agg(
        F.count(F.lit(1)).alias("total_web_events"),
        _n(et == "page_view").alias("page_views"),
        _n(et == "content_view").alias("content_views"),
        _n(et == "download").alias("downloads"),
        _n(et == "video_start").alias("video_starts"),
        _n(et == "video_complete").alias("video_completions"),
        F.count_distinct("session_id").alias("sessions"),
        exact_avg("session_duration_seconds", 2).alias("avg_session_duration"),
        F.max("event_timestamp").alias("last_web_activity"),
        F.max(
            F.when(et.isin("content_view", "download", "video_start", "video_complete"), F.col("event_timestamp"))
        ).alias("last_web_engagement"),
    )
    return g.select(
        "hcp_id",
        "total_web_events",
        "page_views",
        "content_views",
        "downloads",
        ratio(F.col("downloads"), F.col("content_views")).alias("download_rate"),
        "video_starts",
        "video_completions",
        F.coalesce(ratio(F.col("video_completions"), F.col("video_starts")), F.lit(0.0)).alias("video_completion_rate"),
        "sessions",
        "avg_session_duration",
        "last_web_activity",
        "last_web_engagement",
        _days_since(as_of, F.col("last_web_engagement")).alias("days_since_last_web_engagement"),
        _days_since(as_of, F.col("last_web_activity")).alias("days_since_last_web_activity"),
    )


def feat_rep(silver: DataFrame, as_of: dt.date) -> DataFrame:
    it = F.col("interaction_type")
    st = F.col("interaction_status")
    g = silver.groupBy("hcp_id").agg(
        F.count(F.lit(1)).alias("total_veeva_interactions"),
        _n(it == "In-Person Visit").alias("in_person_visits"),
        _n(it == "Phone Call").alias("phone_calls"),
        _n(it == "Virtual Meeting").alias("virtual_meetings"),
        _n(st == "Completed").alias("completed_interactions"),
        _n(st == "Cancelled").alias("cancelled_interactions"),
        _n(st == "No Show").alias("no_show_interactions"),
        exact_avg("interaction_duration_minutes", 2).alias("avg_interaction_duration_minutes"),
        F.max("interaction_duration_minutes").alias("max_interaction_duration_minutes"),
        _n(F.col("follow_up_required") == F.lit(True)).alias("followups_required"),
        F.max("interaction_timestamp").alias("last_veeva_activity"),
        F.max(F.when(st == "Completed", F.col("interaction_timestamp"))).alias("last_veeva_engagement"),
    )
    return g.select(
        "*",
        _days_since(as_of, F.col("last_veeva_engagement")).alias("days_since_last_veeva_engagement"),
        _days_since(as_of, F.col("last_veeva_activity")).alias("days_since_last_veeva_activity"),
    )


def feat_event(silver: DataFrame, as_of: dt.date) -> DataFrame:
    att = F.col("event_activity_type") == "attendance"
    g = silver.groupBy("hcp_id").agg(
        F.count(F.lit(1)).alias("total_event_activities"),
        _n(F.col("event_activity_type") == "registration").alias("event_registrations"),
        _n(att).alias("event_attendance"),
        F.coalesce(exact_avg(F.when(att, F.col("attendance_duration_minutes")), 2), F.lit(0.0)).alias(
            "avg_event_attendance_duration"
        ),
        F.coalesce(F.max(F.when(att, F.col("attendance_duration_minutes"))), F.lit(0.0)).alias(
            "max_event_attendance_duration"
        ),
        F.coalesce(F.sum(F.when(att, F.col("questions_asked")).otherwise(F.lit(0.0))), F.lit(0.0)).alias(
            "event_questions"
        ),
        F.coalesce(F.sum(F.when(att, F.col("poll_responses")).otherwise(F.lit(0.0))), F.lit(0.0)).alias("event_polls"),
        F.max("activity_timestamp").alias("last_event_activity"),
        F.max(F.when(att, F.col("activity_timestamp"))).alias("last_event_engagement"),
    )
    return g.select(
        "hcp_id",
        "total_event_activities",
        "event_registrations",
        "event_attendance",
        F.coalesce(ratio(F.col("event_attendance"), F.col("event_registrations")), F.lit(0.0)).alias(
            "event_attendance_rate"
        ),
        "avg_event_attendance_duration",
        "max_event_attendance_duration",
        "event_questions",
        "event_polls",
        "last_event_activity",
        "last_event_engagement",
        _days_since(as_of, F.col("last_event_engagement")).alias("days_since_last_event_engagement"),
        _days_since(as_of, F.col("last_event_activity")).alias("days_since_last_event_activity"),
    )


FEATURES = {"email": feat_email, "web": feat_web, "rep": feat_rep, "event": feat_event}
