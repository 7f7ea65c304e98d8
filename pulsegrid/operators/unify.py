"""Feature unification: one wide row per master entity.

``features_raw``   J2: master LEFT JOIN the four channel feature tables.
``features_complete`` P12: counts/rates NULL -> 0, recency NULL -> span sentinel.
``fit_minmax`` / ``features_normalized`` A19, X1-X3: min-max scaling of 20 columns.
``features_final`` J4: 39 business columns + 20 normalised ones.

Plan shape: each channel table comes out of a ``groupBy(hcp_id)`` and is
therefore already hash-partitioned on ``hcp_id``; the four left joins reuse
that partitioning (sort-merge joins with no extra exchange on the feature
side), only the master is shuffled once. The min-max statistics are 40
scalars: fitted in one aggregate, brought to the driver (like any scaler's
fitted parameters) and applied as literals, so the transform is a narrow
projection with no join at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Channel feature columns as they appear in the unified tables.
EMAIL_FEATURES = ["emails_delivered", "emails_bounced", "email_opens", "email_clicks", "email_open_rate", "email_click_rate", "email_ctor"]
WEB_FEATURES = [
    "total_web_events", "page_views", "content_views", "downloads", "download_rate", "video_starts", "video_completions",
    "video_completion_rate", "sessions", "avg_session_duration",
]
REP_FEATURES = [
    "total_veeva_interactions", "in_person_visits", "phone_calls", "virtual_meetings",
    "completed_interactions", "cancelled_interactions", "no_show_interactions",
    "avg_interaction_duration_minutes", "max_interaction_duration_minutes", "followups_required",
]
EVENT_FEATURES = [
    "total_event_activities", "event_registrations", "event_attendance",
    "event_attendance_rate", "avg_event_attendance_duration", "max_event_attendance_duration",
    "event_questions", "event_polls",
]

# (prefix, zero-filled columns, last-activity columns, recency columns) per channel, in table order
CHANNEL_LAYOUT = [
    ("email", EMAIL_FEATURES, ["last_email_activity", "last_email_engagement"],
     ["days_since_last_email_engagement", "days_since_last_email_activity"]),
    ("web", WEB_FEATURES, ["last_web_activity", "last_web_engagement"],
     ["days_since_last_web_engagement", "days_since_last_web_activity"]),
    ("rep", REP_FEATURES, ["last_veeva_activity", "last_veeva_engagement"],
     ["days_since_last_veeva_engagement", "days_since_last_veeva_activity"]),
    ("event", EVENT_FEATURES, ["last_event_activity", "last_event_engagement"],
     ["days_since_last_event_engagement", "days_since_last_event_activity"]),
]

# Normalised columns: (output, source column or None for the derived completion rate, inverted?)
NORM_SPEC = [
    ("norm_email_delivered", "emails_delivered", False),
    ("norm_email_open_rate", "email_open_rate", False),
    ("norm_email_click_rate", "email_click_rate", False),
    ("norm_email_ctor", "email_ctor", False),
    ("norm_email_recency", "days_since_last_email_engagement", True),
    ("norm_web_content_views", "content_views", False),
    ("norm_web_download_rate", "download_rate", False),
    ("norm_video_completion_rate", "video_completion_rate", False),
    ("norm_avg_session_duration", "avg_session_duration", False),
    ("norm_web_recency", "days_since_last_web_engagement", True),
    ("norm_completed_interactions", "completed_interactions", False),
    ("norm_veeva_completion_rate", None, False),
    ("norm_veeva_duration", "avg_interaction_duration_minutes", False),
    ("norm_veeva_recency", "days_since_last_veeva_engagement", True),
    ("norm_event_attendance", "event_attendance", False),
    ("norm_event_attendance_rate", "event_attendance_rate", False),
    ("norm_event_duration", "avg_event_attendance_duration", False),
    ("norm_event_questions", "event_questions", False),
    ("norm_event_polls", "event_polls", False),
    ("norm_event_recency", "days_since_last_event_engagement", True),
]
NORM_COLUMNS = [n for n, _, _ in NORM_SPEC]

# Business columns of the final table (39), in order.
FINAL_BUSINESS = (
    EMAIL_FEATURES + ["days_since_last_email_engagement"]
    + WEB_FEATURES + ["days_since_last_web_engagement"]
    + REP_FEATURES + ["days_since_last_veeva_engagement"]
    + EVENT_FEATURES + ["days_since_last_event_engagement"]
)


def features_raw(master: DataFrame, feats: dict[str, DataFrame]) -> DataFrame:
    """Every master entity, left-joined to each channel's feature row."""
    out = master.select("hcp_id").distinct()
    for ch in ("email", "web", "rep", "event"):
        out = out.join(feats[ch], "hcp_id", "left")
    return out


def features_complete(raw: DataFrame, recency_fill: int) -> DataFrame:
    """NULL counts/rates -> 0, NULL recency -> ``recency_fill`` days."""
    cols: list[Column] = [F.col("hcp_id")]
    for _, zero_cols, last_cols, rec_cols in CHANNEL_LAYOUT:
        for c in zero_cols:
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
        cols += [F.col(c) for c in last_cols]
        cols += [F.coalesce(F.col(c), F.lit(recency_fill)).alias(c) for c in rec_cols]
    return raw.select(*cols)


def _rep_completion_rate() -> Column:
    return F.col("completed_interactions").cast("double") / F.nullif(
        F.col("total_veeva_interactions").cast("double"), F.lit(0.0)
    )


def _norm_source(src: str | None) -> Column:
    return _rep_completion_rate() if src is None else F.col(src).cast("double")


def norm_stats(complete: DataFrame) -> DataFrame:
    """Min and max of the 20 source columns in one scan (one row)."""
    aggs = []
    for name, src, _ in NORM_SPEC:
        short = name[len("norm_"):]
        v = _norm_source(src)
        aggs += [F.min(v).alias(f"min_{short}"), F.max(v).alias(f"max_{short}")]
    return complete.agg(*aggs)


def fit_minmax(complete: DataFrame) -> dict[str, float | None]:
    """Fitted min-max parameters (40 scalars) on the driver."""
    row = norm_stats(complete).first()
    return row.asDict() if row is not None else {}


def _scaled(v: Column, lo, hi, inverted: bool) -> Column:
    """(v - min) / (max - min); constant column -> 0; inverted: 1 - that."""
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    if hi == lo:
        return F.lit(0.0)
    frac = (v - F.lit(float(lo))) / F.lit(float(hi) - float(lo))
    return (F.lit(1.0) - frac) if inverted else frac


def features_normalized(complete: DataFrame, stats: dict[str, float | None] | None = None) -> DataFrame:
    """hcp_id + 20 min-max scaled columns (recencies inverted)."""
    stats = fit_minmax(complete) if stats is None else stats
    cols = [F.col("hcp_id")]
    for name, src, inv in NORM_SPEC:
        short = name[len("norm_"):]
        cols.append(_scaled(_norm_source(src), stats[f"min_{short}"], stats[f"max_{short}"], inv).alias(name))
    return complete.select(*cols)


def features_final(normalized: DataFrame, complete: DataFrame) -> DataFrame:
    """Normalised INNER JOIN complete on hcp_id, 39 business + 20 norm columns."""
    n = normalized.alias("n")
    c = complete.alias("c")
    return n.join(c, F.col("n.hcp_id") == F.col("c.hcp_id"), "inner").select(
        F.col("n.hcp_id").alias("hcp_id"),
        *[F.col(f"c.{x}") for x in FINAL_BUSINESS],
        *[F.col(f"n.{x}") for x in NORM_COLUMNS],
    )


def features_final_direct(complete: DataFrame, stats: dict[str, float | None] | None = None) -> DataFrame:
    """Same rows as ``features_final`` without the self-join: the normalised
    columns are a projection of ``complete`` (hcp_id is unique there), so the
    join is replaced by one narrow select. Used by the pipeline."""
    stats = fit_minmax(complete) if stats is None else stats
    norm = []
    for name, src, inv in NORM_SPEC:
        short = name[len("norm_"):]
        norm.append(_scaled(_norm_source(src), stats[f"min_{short}"], stats[f"max_{short}"], inv).alias(name))
    return complete.select("hcp_id", *FINAL_BUSINESS, *norm)


def channel_counts(feats: dict[str, DataFrame]) -> DataFrame:
    """Per-channel feature rows and distinct entities, stacked."""
    labels = {"email": "EMAIL", "web": "WEB", "rep": "VEEVA", "event": "EVENT"}
    out = None
    for ch, lab in labels.items():
        part = feats[ch].agg(
            F.lit(lab).alias("channel"),
            F.count(F.lit(1)).alias("hcp_records"),
            F.count_distinct("hcp_id").alias("unique_hcps"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def channel_coverage(raw: DataFrame) -> DataFrame:
    """Entities present in each channel (non-NULL test in the raw join)."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_hcps"),
        F.count("emails_delivered").alias("email_hcps"),
        F.count("total_web_events").alias("web_hcps"),
        F.count("total_veeva_interactions").alias("veeva_hcps"),
        F.count("total_event_activities").alias("event_hcps"),
    )


def unified_null_report(complete: DataFrame) -> DataFrame:
    """Q10: remaining NULL features / recencies after the fill."""
    checks = {
        "null_email_features": "emails_delivered",
        "null_web_features": "content_views",
        "null_veeva_features": "total_veeva_interactions",
        "null_event_features": "total_event_activities",
        "null_email_recency": "days_since_last_email_engagement",
        "null_web_recency": "days_since_last_web_engagement",
        "null_veeva_recency": "days_since_last_veeva_engagement",
        "null_event_recency": "days_since_last_event_engagement",
    }
    return complete.agg(
        F.count(F.lit(1)).alias("total_hcps"), *[F.count_if(F.col(c).isNull()).alias(k) for k, c in checks.items()]
    )


def norm_range(normalized: DataFrame) -> DataFrame:
    """min/max of every normalised column (all should lie in [0, 1])."""
    aggs = []
    for n in NORM_COLUMNS:
        short = n[len("norm_"):]
        aggs += [F.min(n).alias(f"min_{short}"), F.max(n).alias(f"max_{short}")]
    return normalized.agg(*aggs)
