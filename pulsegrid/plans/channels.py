"""Per-channel specification: silver cleaning, de-duplication key and gate.

A ``ChannelSpec`` is data, not code paths: the silver operator, the profiling
and the data-quality suite are written once and driven by these specs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions import cleaning as C

# Closed vocabularies of the silver layer, in the reference's order.
EMAIL_EVENT_TYPES = ["delivered", "open", "click", "bounced"]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
DELIVERY_STATUSES = ["delivered", "bounced", "failed"]
WEB_EVENT_TYPES = ["page_view", "content_view", "download", "video_start", "video_complete"]
TRAFFIC_SOURCES = ["email", "organic search", "direct", "professional referral"]
REP_TYPES = {"in-person visit": "In-Person Visit", "phone call": "Phone Call", "virtual meeting": "Virtual Meeting"}
REP_STATUSES = {"completed": "Completed", "cancelled": "Cancelled", "no show": "No Show"}
EVENT_TYPES = {
    "webinar": "Webinar",
    "medical education": "Medical Education",
    "product launch": "Product Launch",
    "expert panel": "Expert Panel",
    "clinical discussion": "Clinical Discussion",
}
EVENT_ACTIVITY_TYPES = ["registration", "attendance"]
ATTENDANCE_STATUSES = {"attended": "Attended", "not applicable": "Not Applicable"}


@dataclass(frozen=True)
class ChannelSpec:
    name: str
    key: str
    ts: str
    gate_type: str
    # ordered (name, Column) pairs producing the silver columns from bronze
    columns: Callable[[], list[tuple[str, Column]]]
    # raw bronze columns that complete the "latest first" order for ties, so the
    # surviving copy is the same row on every (re)computation of a partition
    tiebreak: tuple[str, ...] = ()
    # columns profiled by the category distribution / distinct counts
    categories: tuple[str, ...] = ()
    distinct_extra: tuple[str, ...] = ()
    # numeric columns that must not be negative after cleaning
    non_negative: tuple[str, ...] = ()

    def silver_columns(self) -> list[str]:
        return [n for n, _ in self.columns()]


def _email_cols():
    return [
        ("email_event_id", C.as_string("email_event_id")),
        ("hcp_id", C.trim_id("hcp_id")),
        ("campaign_id", C.trim_id("campaign_id")),
        ("drug_id", C.trim_id("drug_id")),
        ("email_id", C.trim_id("email_id")),
        ("event_type", C.vocab("event_type", EMAIL_EVENT_TYPES)),
        ("event_timestamp", C.to_ts("event_timestamp")),
        ("email_subject", C.blank_to_null("email_subject")),
        ("url", C.blank_to_null("url")),
        ("device_type", C.vocab("device_type", DEVICE_TYPES)),
        ("delivery_status", C.vocab("delivery_status", DELIVERY_STATUSES)),
        ("source_system", C.blank_to_null("source_system")),
    ]


def _web_cols():
    return [
        ("web_event_id", C.as_string("web_event_id")),
        ("hcp_id", C.trim_id("hcp_id")),
        ("session_id", C.trim_id("session_id")),
        ("campaign_id", C.trim_id("campaign_id")),
        ("drug_id", C.trim_id("drug_id")),
        ("event_type", C.vocab("event_type", WEB_EVENT_TYPES)),
        ("event_timestamp", C.to_ts("event_timestamp")),
        ("page_url", C.blank_to_null("page_url")),
        ("content_id", C.blank_to_null("content_id")),
        ("content_type", C.blank_to_null("content_type")),
        ("session_duration_seconds", C.non_negative("session_duration_seconds")),
        ("device_type", C.vocab("device_type", DEVICE_TYPES)),
        ("traffic_source", C.vocab("traffic_source", TRAFFIC_SOURCES)),
        ("source_system", C.blank_to_null("source_system")),
    ]


def _rep_cols():
    return [
        ("veeva_event_id", C.as_string("veeva_event_id")),
        ("hcp_id", C.trim_id("hcp_id")),
        ("interaction_id", C.trim_id("interaction_id")),
        ("campaign_id", C.trim_id("campaign_id")),
        ("drug_id", C.trim_id("drug_id")),
        ("interaction_type", C.canonical("interaction_type", REP_TYPES)),
        ("interaction_timestamp", C.to_ts("interaction_timestamp")),
        ("interaction_duration_minutes", C.non_negative("interaction_duration_minutes")),
        ("interaction_status", C.canonical("interaction_status", REP_STATUSES)),
        ("interaction_purpose", C.blank_to_null("interaction_purpose")),
        ("discussion_topic", C.blank_to_null("discussion_topic")),
        ("follow_up_required", C.parse_bool("follow_up_required")),
        ("follow_up_date", C.to_date("follow_up_date")),
        ("rep_id", C.blank_to_null("rep_id")),
        ("territory", C.blank_to_null("territory")),
        ("channel", C.blank_to_null("channel")),
        ("source_system", C.blank_to_null("source_system")),
    ]


def _event_cols():
    return [
        ("event_activity_id", C.as_string("event_activity_id")),
        ("hcp_id", C.trim_id("hcp_id")),
        ("event_id", C.trim_id("event_id")),
        ("campaign_id", C.trim_id("campaign_id")),
        ("drug_id", C.trim_id("drug_id")),
        ("event_name", C.blank_to_null("event_name")),
        ("event_type", C.canonical("event_type", EVENT_TYPES)),
        ("event_activity_type", C.vocab("event_activity_type", EVENT_ACTIVITY_TYPES)),
        ("activity_timestamp", C.to_ts("activity_timestamp")),
        ("registration_status", C.blank_to_null("registration_status")),
        ("attendance_status", C.canonical("attendance_status", ATTENDANCE_STATUSES)),
        ("attendance_duration_minutes", C.non_negative("attendance_duration_minutes")),
        ("questions_asked", C.non_negative("questions_asked")),
        ("poll_responses", C.non_negative("poll_responses")),
        ("device_type", C.vocab("device_type", DEVICE_TYPES)),
        ("source_system", C.blank_to_null("source_system")),
    ]


EMAIL = ChannelSpec(
    name="email",
    key="email_event_id",
    ts="event_timestamp",
    gate_type="event_type",
    columns=_email_cols,
    tiebreak=("hcp_id", "event_type", "email_id", "campaign_id", "drug_id", "url", "device_type", "delivery_status"),
    categories=("event_type",),
    distinct_extra=("email_event_id",),
)
WEB = ChannelSpec(
    name="web",
    key="web_event_id",
    ts="event_timestamp",
    gate_type="event_type",
    columns=_web_cols,
    tiebreak=("page_url", "content_id", "session_duration_seconds"),
    categories=("event_type", "traffic_source"),
    distinct_extra=("web_event_id", "session_id"),
    non_negative=("session_duration_seconds",),
)
REP = ChannelSpec(
    name="rep",
    key="veeva_event_id",
    ts="interaction_timestamp",
    gate_type="interaction_type",
    columns=_rep_cols,
    tiebreak=("hcp_id", "interaction_id", "interaction_type", "interaction_status", "interaction_duration_minutes", "follow_up_required"),
    categories=("interaction_type", "interaction_status", "follow_up_required"),
    distinct_extra=("veeva_event_id", "interaction_id"),
    non_negative=("interaction_duration_minutes",),
)
EVENT = ChannelSpec(
    name="event",
    key="event_activity_id",
    ts="activity_timestamp",
    gate_type="event_activity_type",
    columns=_event_cols,
    tiebreak=("hcp_id", "event_id", "event_activity_type", "attendance_status", "attendance_duration_minutes"),
    categories=("event_activity_type", "event_type", "attendance_status"),
    distinct_extra=("event_activity_id", "event_id"),
    non_negative=("attendance_duration_minutes", "questions_asked", "poll_responses"),
)

SPECS = {"email": EMAIL, "web": WEB, "rep": REP, "event": EVENT}

#: Silver columns whose values are closed lists (other values are NULL).
VOCABULARIES = {"device_type": DEVICE_TYPES}
