"""Driver phrases and recommendation text (M27, M28), as Spark column expressions.

Phrase maps are applied with ``element_at(map literal, key)``; the texts are
``format_string`` templates. Note: Java's ``%.1f`` rounds half-up on the
decimal expansion where Python's rounds the binary value, so texts can
differ from a Python rendering exactly at .x5 ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readable phrase per feature (profile A), in the reference's order.
PHRASES_A = {
    "email_delivered": "historical email volume",
    "email_opens": "email open frequency",
    "email_clicks": "email click engagement",
    "email_open_rate": "email open rate",
    "email_click_rate": "email click rate",
    "email_ctor": "click-to-open rate",
    "email_recency_days": "email recency",
    "email_eng_recency_days": "email engagement recency",
    "web_total_events": "website activity volume",
    "web_unique_sessions": "unique website sessions",
    "web_page_views": "web page views",
    "web_content_views": "web content viewing frequency",
    "web_downloads": "web resource download activity",
    "web_download_rate": "web download rate",
    "web_video_starts": "video starts",
    "web_video_completes": "video completions",
    "web_video_completion_rate": "video completion rate",
    "web_avg_duration": "average website session duration",
    "web_recency_days": "website recency",
    "web_eng_recency_days": "website engagement recency",
    "event_registrations": "event registration history",
    "event_attendances": "event attendance history",
    "event_total_duration": "total event attendance duration",
    "event_avg_duration": "average event duration",
    "event_questions": "event questions asked",
    "event_polls": "event poll participation",
    "event_attendance_rate": "event attendance rate",
    "event_recency_days": "event registration recency",
    "event_att_recency_days": "event attendance recency",
    "veeva_total_interactions": "field representative interaction volume",
    "veeva_completed": "completed rep visits",
    "veeva_cancelled": "cancelled rep visits",
    "veeva_no_show": "rep visit no-shows",
    "veeva_in_person": "in-person meeting frequency",
    "veeva_phone": "phone meeting frequency",
    "veeva_virtual": "virtual meeting frequency",
    "veeva_total_duration": "total time spent with reps",
    "veeva_avg_duration": "average rep meeting duration",
    "veeva_active_days": "days meeting with reps",
    "veeva_unique_reps": "unique field reps met",
    "veeva_completion_rate": "rep visit completion rate",
    "veeva_recency_days": "sales rep interaction recency",
    "veeva_comp_recency_days": "completed rep visit recency",
    "total_touchpoints": "cross-channel engagement volume",
    "digital_touchpoints": "digital engagement volume",
    "field_touchpoints": "field engagement volume",
    "email_proportion": "preference for email",
    "web_proportion": "preference for website",
    "event_proportion": "preference for events",
    "veeva_proportion": "preference for sales reps",
    "digital_to_field_ratio": "digital vs field preference",
    "active_channel_count": "multichannel responsiveness",
}

# Readable phrase per feature (profile B), in the reference's order.
PHRASES_B = {
    "event_attendances": "recent event attendance",
    "event_attendance_rate": "high webinar participation consistency",
    "event_total_duration": "sustained webinar watch duration",
    "event_questions": "active Q&A engagement during medical events",
    "event_recency": "recent medical conference attendance",
    "norm_event_attendance": "strong historical webinar presence",
    "veeva_completed": "completed field representative visits",
    "veeva_completion_rate": "high visit completion rate",
    "veeva_in_person": "face-to-face interaction history",
    "veeva_recency": "recent representative interaction",
    "norm_completed_interactions": "frequent representative touchpoints",
    "web_content_views": "frequent clinical article views",
    "web_downloads": "active downloading of clinical PDF resources",
    "web_video_completes": "full views of educational video content",
    "web_recency": "recent portal navigation",
    "norm_web_content_views": "consistent website content browsing",
    "email_open": "consistent email open activity",
    "email_click": "active engagement with email links",
    "email_open_rate": "high email open responsiveness",
    "email_recency": "recent email engagement",
    "norm_email_open_rate": "strong historical email responsiveness",
    "total_touchpoints": "high overall cross-channel activity",
    "active_channels_count": "multi-channel responsiveness",
}


def _map_lit(d: dict[str, str]) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def phrase_a(code: Column) -> Column:
    """M27 (A): strip ``norm_``, look up the phrase, else underscores -> spaces."""
    clean = F.replace(code, F.lit("norm_"), F.lit(""))
    return F.coalesce(F.element_at(_map_lit(PHRASES_A), clean), F.replace(clean, F.lit("_"), F.lit(" ")))


def phrases_b(codes: Column, k: int = 2) -> Column:
    """M27 (B): only mapped features, distinct phrases, first ``k`` in order."""
    mapped = F.transform(codes, lambda c: F.element_at(_map_lit(PHRASES_B), c))
    return F.slice(F.array_distinct(F.filter(mapped, lambda p: p.isNotNull())), 1, k)


def reason_a(channel: Column, prob: Column, tier: Column, drivers: Column) -> Column:
    """M28 (A): three templates by engagement tier; drivers joined with ' and '."""
    # The sentences must equal the reference's.
    feat = F.array_join(drivers, " and ")
    pct = F.format_string("%.1f", prob * 100)
    high = F.format_string(
        "Since this HCP is highly engaged overall, %s is the ideal next step (%s%% likelihood), driven largely by their %s.",
        channel, pct, feat,
    )
    medium = F.format_string(
        "We recommend reaching out via %s (%s%% likelihood). The model selected this channel primarily due to the HCP's %s.",
        channel, pct, feat,
    )
    low = F.format_string(
        "To build momentum with this lower-engagement HCP, %s is the safest bet (%s%% likelihood), which strongly aligns with their %s.",
        channel, pct, feat,
    )
    return F.when(tier == "High", high).when(tier == "Medium", medium).otherwise(low)


def reason_b(channel: Column, prob: Column, phrases: Column) -> Column:
    """M28 (B): templates for 0, 1 or 2 driver phrases."""
    # The sentences must equal the reference's.
    pct = F.format_string("%.1f%%", prob * 100)
    none = F.format_string(
        "%s is recommended with %s predicted likelihood based on positive overall behavioral affinity across channels.",
        channel, pct,
    )
    one = F.format_string(
        "%s is recommended with %s predicted likelihood because the HCP has shown %s, which positively influences predicted %s engagement.",
        channel, pct, F.element_at(phrases, 1), F.lower(channel),
    )
    two = F.format_string(
        "%s is recommended with %s predicted likelihood because the HCP has shown %s and %s, which positively influence predicted %s engagement.",
        channel, pct, F.element_at(phrases, 1), F.element_at(phrases, 2), F.lower(channel),
    )
    n = F.size(phrases)
    return F.when(n == 0, none).when(n == 1, one).otherwise(two)
