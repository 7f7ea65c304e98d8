"""Point-in-time snapshots: history features and future labels per (entity, T).

The windows of all dates are handled in one pass per channel (J12, a range
join done without a join): a silver row is folded into the state of its
(entity, pane), and pane states are merged into windows (``operators.panes``).
A row is never copied per date, whatever the length of the windows; a hot
entity contributes one partial state per map task and pane, and its distinct
counts spread over its values.

The spine (every entity x every date) is built by exploding the date array
on the entity list (narrow, no cross join). Spine, channel aggregates, labels
and normalised features all lie by entity and meet there (``panes.meet``): no
row of a date is shuffled.

Profiles: see ``pulsegrid.config``. Column names and feature sets follow each
profile's reference flavour (88 features in A).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import Profile
from pulsegrid.operators import panes as PN

DAY_US = 86400.0


def history_windows(p: Profile) -> PN.Windows:
    return PN.Windows.history([d for d, _ in p.all_dates()], p.hist_days, p.hist_closed_right)


def label_windows(p: Profile) -> PN.Windows:
    return PN.Windows.label([d for d, _ in p.all_dates()], p.fut_days, p.label_open_left)


def _days_before(ts_col: str) -> Column:
    """(T - ts) in days with microsecond precision (pandas total_seconds / 86400)."""
    us = F.expr(f"timestampdiff(MICROSECOND, {ts_col}, CAST(snapshot_date AS TIMESTAMP_NTZ))")
    return us.cast("double") / 1e6 / DAY_US


def _recency(ts_col: str, p: Profile) -> Column:
    r = F.coalesce(_days_before(ts_col), F.lit(float(p.hist_days)))
    return F.least(r, F.lit(float(p.hist_days))) if p.clip_recency else r


def _rate(a: str, b: str, p: Profile, plus: float | None = None) -> Column:
    num = F.col(a).cast("double")
    den = F.col(b).cast("double")
    if plus is not None:
        return num / (den + F.lit(plus))
    if p.ratio_guard == "max1":
        return num / F.greatest(den, F.lit(1.0))
    return num / (den + F.lit(1e-5))


def _attended(p: Profile) -> Column:
    if p.attendance_rule == "status":
        return F.col("attendance_status") == "Attended"
    return F.col("event_activity_type") == "attendance"


# --- per-channel history measures ---------------------------------------------
def _last(ts: str, engaged: Column) -> list[PN.Measure]:
    return [PN.greatest("_last", F.col(ts)), PN.greatest("_last_eng", F.when(engaged, F.col(ts)))]


def email_measures(p: Profile, w: PN.Windows) -> list:
    et, ds = F.col("event_type"), F.col("delivery_status")
    sent = et if p.name == "A" else ds
    opens, clicks = ("email_opens", "email_clicks") if p.name == "A" else ("email_open", "email_click")
    return [
        PN.count("email_delivered", sent == "delivered"),
        PN.count("email_bounced", sent == "bounced"),
        PN.count(opens, et == "open"),
        PN.count(clicks, et == "click"),
        PN.distinct("email_unique_emails", "email_id"),
        PN.distinct("email_unique_campaigns", "campaign_id"),
        PN.distinct("email_unique_drugs", "drug_id"),
        PN.active_days("email_active_days", "event_timestamp", w),
        *_last("event_timestamp", et.isin("open", "click")),
    ]


def web_measures(p: Profile, w: PN.Windows) -> list:
    et = F.col("event_type")
    dur = "session_duration_seconds"
    names = ("web_total_duration", "web_avg_duration", "web_max_duration") if p.name == "A" else (
        "web_total_session_duration", "web_avg_session_duration", "web_max_session_duration")
    variety = {"web_unique_campaigns": "campaign_id", "web_unique_drugs": "drug_id"} if p.name == "A" else {
        "web_content_type_diversity": "content_type", "web_device_diversity": "device_type"}
    return [
        PN.count("web_total_events", F.col("web_event_id").isNotNull()),
        PN.distinct("web_unique_sessions", "session_id"),
        PN.count("web_page_views", et == "page_view"),
        PN.count("web_content_views", et == "content_view"),
        PN.count("web_downloads", et == "download"),
        PN.count("web_video_starts", et == "video_start"),
        PN.count("web_video_completes", et == "video_complete"),
        PN.total(names[0], dur),
        PN.mean(names[1], dur),
        PN.greatest(names[2], F.col(dur)),
        PN.active_days("web_active_days", "event_timestamp", w),
        *[PN.distinct(n, c) for n, c in variety.items()],
        *_last("event_timestamp", et.isin(*p.web_engagement_types)),
    ]


def event_measures(p: Profile, w: PN.Windows) -> list:
    att = _attended(p)
    dur = "attendance_duration_minutes"
    longest = [] if p.name == "A" else [PN.greatest("event_max_duration", F.col(dur))]
    variety = [PN.distinct("event_unique_campaigns", "campaign_id"), PN.distinct("event_unique_drugs", "drug_id")] if p.name == "A" else []
    return [
        PN.count("event_registrations", F.col("event_activity_type") == "registration"),
        PN.count("event_attendances", att),
        PN.total("event_total_duration", dur),
        PN.mean("event_avg_duration", dur),
        *longest,
        PN.total("event_questions", "questions_asked"),
        PN.total("event_polls", "poll_responses"),
        PN.active_days("event_active_days", "activity_timestamp", w),
        PN.distinct("event_unique_events", "event_id"),
        *variety,
        *_last("activity_timestamp", att),
    ]


def rep_measures(p: Profile, w: PN.Windows) -> list:
    st, it = F.col("interaction_status"), F.col("interaction_type")
    dur = "interaction_duration_minutes"
    every = F.lit(True) if p.name == "A" else F.col("veeva_event_id").isNotNull()
    longest = [] if p.name == "A" else [PN.greatest("veeva_max_duration", F.col(dur))]
    variety = [PN.distinct(f"veeva_unique_{n}", c) for n, c in (("reps", "rep_id"), ("campaigns", "campaign_id"), ("drugs", "drug_id"))] if p.name == "A" else []
    return [
        PN.count("veeva_total_interactions", every),
        PN.count("veeva_completed", st == "Completed"),
        PN.count("veeva_cancelled", st == "Cancelled"),
        PN.count("veeva_no_show", st == "No Show"),
        PN.count("veeva_in_person", it == "In-Person Visit"),
        PN.count("veeva_phone", it == "Phone Call"),
        PN.count("veeva_virtual", it == "Virtual Meeting"),
        PN.total("veeva_total_duration", dur),
        PN.mean("veeva_avg_duration", dur),
        *longest,
        PN.count("veeva_follow_up_count" if p.name == "A" else "veeva_followups", F.col("follow_up_required") == F.lit(True)),
        PN.active_days("veeva_active_days", "interaction_timestamp", w),
        *variety,
        *_last("interaction_timestamp", st == "Completed"),
    ]


MEASURES = {"email": email_measures, "web": web_measures, "event": event_measures, "rep": rep_measures}
#: Profile A: (rate, counted, out of) and the two recencies of a channel.
RATES_A = {
    "email": (("email_open_rate", "email_opens", "email_delivered"), ("email_click_rate", "email_clicks", "email_delivered"),
              ("email_ctor", "email_clicks", "email_opens")),
    "web": (("web_video_completion_rate", "web_video_completes", "web_video_starts"),),
    "event": (("event_attendance_rate", "event_attendances", "event_registrations"),),
    "rep": (("veeva_completion_rate", "veeva_completed", "veeva_total_interactions"),),
}
RECENCY_A = {"email": ("email_recency_days", "email_eng_recency_days"), "web": ("web_recency_days", "web_eng_recency_days"),
             "event": ("event_recency_days", "event_att_recency_days"), "rep": ("veeva_recency_days", "veeva_comp_recency_days")}
SILVER_TS = {"email": "event_timestamp", "web": "event_timestamp", "event": "activity_timestamp", "rep": "interaction_timestamp"}
RECENCY_B = {"email": ("email_recency", "email_eng_recency"), "web": ("web_recency", "web_eng_recency"),
             "event": ("event_recency", "event_eng_recency"), "rep": ("veeva_recency", "veeva_eng_recency")}


def channel_history(silver: DataFrame, channel: str, p: Profile) -> DataFrame:
    """History aggregates of one channel for every snapshot date (entities with
    activity only). ``silver`` is read once for the states and once for each
    distinct count of a column without a vocabulary: pass a written table."""
    w = history_windows(p)
    g = PN.window_aggregates(silver, "hcp_id", SILVER_TS[channel], w, MEASURES[channel](p, w))
    if p.name != "A":
        return g
    rates = [_rate(num, den, p).alias(name) for name, num, den in RATES_A[channel]]
    recencies = [_recency(c, p).alias(name) for c, name in zip(("_last", "_last_eng"), RECENCY_A[channel])]
    return g.select(*[c for c in g.columns if not c.startswith("_")], *rates, *recencies)


def histories(silvers: dict[str, DataFrame], p: Profile) -> dict[str, DataFrame]:
    return {ch: channel_history(silvers[ch], ch, p) for ch in ("email", "web", "event", "rep")}


def spine(entities: DataFrame, p: Profile) -> DataFrame:
    """Every entity x every snapshot date, with its split label (narrow explode)."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(d.isoformat()).cast("date").alias("snapshot_date"), F.lit(s).alias("split")) for d, s in p.all_dates()])
    )
    return entities.select("hcp_id", pairs.alias("p")).select("hcp_id", "p.snapshot_date", "p.split")


def entity_spine(spark, n: int, fmt: str = "HCP%04d") -> DataFrame:
    """Generated id spine ``HCP0001 .. HCPn`` (profile B's fixed population)."""
    return spark.range(1, n + 1).select(F.format_string(fmt, F.col("id")).alias("hcp_id"))


def _fill(df: DataFrame, keep: set[str], p: Profile) -> DataFrame:
    """NULL -> hist_days for recency columns, 0 otherwise."""
    cols = []
    for c in df.columns:
        if c in keep:
            cols.append(F.col(c))
        elif "recency" in c:
            cols.append(F.coalesce(F.col(c), F.lit(float(p.hist_days))).alias(c))
        else:
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
    return df.select(*cols)


def _cross_a(df: DataFrame) -> DataFrame:
    """X4-X7 (profile A)."""
    tot = F.col("email_delivered") + F.col("web_total_events") + F.col("event_registrations") + F.col("veeva_total_interactions")
    df = df.withColumn("total_touchpoints", tot)
    active = sum(
        (F.col(c) > 0).cast("int")
        for c in ("email_delivered", "web_total_events", "event_registrations", "veeva_total_interactions")
    )
    den = F.greatest(F.col("total_touchpoints").cast("double"), F.lit(1.0))
    digital = F.col("email_delivered") + F.col("web_total_events") + F.col("event_registrations")
    return df.select(
        "*",
        active.alias("active_channel_count"),
        (F.col("email_delivered").cast("double") / den).alias("email_proportion"),
        (F.col("web_total_events").cast("double") / den).alias("web_proportion"),
        (F.col("event_registrations").cast("double") / den).alias("event_proportion"),
        (F.col("veeva_total_interactions").cast("double") / den).alias("veeva_proportion"),
        digital.alias("digital_touchpoints"),
        F.col("veeva_total_interactions").alias("field_touchpoints"),
        (digital.cast("double") / F.greatest(F.col("veeva_total_interactions").cast("double"), F.lit(1.0))).alias(
            "digital_to_field_ratio"
        ),
    )


def _rates_b(df: DataFrame) -> DataFrame:
    """X9 + X4-X8 (profile B): +1e-5 guarded rates, proportions, min recency."""
    eps = 1e-5
    tot = F.col("email_delivered") + F.col("web_total_events") + F.col("event_registrations") + F.col("veeva_total_interactions")
    df = df.select(
        "*",
        (F.col("email_open") / (F.col("email_delivered") + eps)).alias("email_open_rate"),
        (F.col("email_click") / (F.col("email_delivered") + eps)).alias("email_click_rate"),
        (F.col("email_click") / (F.col("email_open") + eps)).alias("email_ctor"),
        (F.col("web_downloads") / (F.col("web_content_views") + eps)).alias("web_download_rate"),
        (F.col("web_video_completes") / (F.col("web_video_starts") + eps)).alias("web_video_completion_rate"),
        (F.col("event_attendances") / (F.col("event_registrations") + eps)).alias("event_attendance_rate"),
        (F.col("veeva_completed") / (F.col("veeva_total_interactions") + eps)).alias("veeva_completion_rate"),
        (F.col("veeva_followups") / (F.col("veeva_total_interactions") + eps)).alias("veeva_followup_rate"),
        tot.alias("total_touchpoints"),
    )
    active = sum(
        (F.col(c) > 0).cast("int")
        for c in ("email_delivered", "web_total_events", "event_registrations", "veeva_total_interactions")
    )
    digital = F.col("email_delivered") + F.col("web_total_events")
    field = F.col("event_registrations") + F.col("veeva_total_interactions")
    return df.select(
        "*",
        active.alias("active_channels_count"),
        (F.col("email_delivered") / (F.col("total_touchpoints") + eps)).alias("email_prop"),
        (F.col("web_total_events") / (F.col("total_touchpoints") + eps)).alias("web_prop"),
        (F.col("event_registrations") / (F.col("total_touchpoints") + eps)).alias("event_prop"),
        (F.col("veeva_total_interactions") / (F.col("total_touchpoints") + eps)).alias("veeva_prop"),
        digital.alias("digital_touchpoints"),
        field.alias("field_touchpoints"),
        (digital / (field + 1.0)).alias("digital_to_field_ratio"),
        F.least("email_recency", "web_recency", "event_recency", "veeva_recency").alias("min_recency_days"),
    )


def snapshot_features(
    silvers: dict[str, DataFrame], entities: DataFrame, normalized: DataFrame | None, p: Profile
) -> DataFrame:
    """History features for every (entity, snapshot date): 88 columns in profile A."""
    if p.name != "A":
        return snapshot_features_b(silvers, entities, normalized, p)
    out = spine(entities, p)
    hist = histories(silvers, p)
    for ch in ("email", "web", "event", "rep"):
        out = PN.meet(out, hist[ch])
    out = _cross_a(_fill(out, {"hcp_id", "snapshot_date", "split"}, p))
    if normalized is not None:
        out = out.join(normalized, "hcp_id", "left")
    return out


def snapshot_features_b(silvers: dict[str, DataFrame], entities: DataFrame, normalized: DataFrame | None, p: Profile) -> DataFrame:
    """Profile B: per-channel last timestamps become clipped recencies right after each join."""
    out = spine(entities, p)
    hist = histories(silvers, p)
    for ch in ("email", "web", "event", "rep"):
        h = hist[ch]
        r1, r2 = RECENCY_B[ch]
        h = h.withColumnRenamed("_last", f"_last_{ch}").withColumnRenamed("_last_eng", f"_last_eng_{ch}")
        out = PN.meet(out, h)
        out = out.withColumn(r1, _recency(f"_last_{ch}", p)).withColumn(r2, _recency(f"_last_eng_{ch}", p)).drop(
            f"_last_{ch}", f"_last_eng_{ch}"
        )
    out = _rates_b(_fill(out, {"hcp_id", "snapshot_date", "split"}, p))
    if normalized is not None:
        out = out.join(normalized, "hcp_id", "left")
    return out


# --- labels ----------------------------------------------------------------------
def label_predicates(p: Profile, label_set: str = "train") -> dict[str, tuple[str, Column]]:
    """F4 per target: (channel, predicate on silver rows)."""
    if p.name == "A" or label_set == "eval":
        web_types = ("content_view", "download", "video_complete") if p.name == "A" else (
            "content_view", "download", "video_start", "video_complete")
        email = F.col("event_type").isin("open", "click")
    else:
        web_types = ("download", "video_complete")
        email = F.col("event_type") == "click"
    return {
        "email_target": ("email", email),
        "web_target": ("web", F.col("event_type").isin(*web_types)),
        "webinar_target": ("event", _attended(p)),
        "veeva_target": ("rep", F.col("interaction_status") == "Completed"),
    }


def snapshot_labels(silvers: dict[str, DataFrame], p: Profile, label_set: str = "train") -> DataFrame:
    """Per (entity, T) 0/1 flags for engagement in the label window.

    The engaged rows of the four channels are stacked with a target tag and
    folded into one bit set of panes per entity and target."""
    parts = None
    targets = label_predicates(p, label_set)
    for target, (ch, pred) in targets.items():
        x = silvers[ch].where(pred).select("hcp_id", F.col(SILVER_TS[ch]).alias("ts"), F.lit(target).alias("target"))
        parts = x if parts is None else parts.unionByName(x)
    return PN.window_flags(parts, "hcp_id", "ts", label_windows(p), "target", list(targets))


def attach_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    targets = [c for c in labels.columns if c.endswith("_target")]
    out = PN.meet(features, labels)
    return out.select(
        *[c for c in out.columns if c not in targets], *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in targets]
    )
