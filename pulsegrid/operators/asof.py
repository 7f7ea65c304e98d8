"""Leak-free normalisation: features and min-max bounds as they stood on each date.

The reference scales with the minima and maxima of all data, those after the
snapshot date included. Here every snapshot date sees only rows of earlier
days: the panes between the dates are folded once (``operators.panes``), the
states before a date are merged into the entity's features on that date, and
their minima and maxima over all entities scale that date's rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.cleaning import ratio
from pulsegrid.operators import panes as PN
from pulsegrid.operators.snapshots import SILVER_TS
from pulsegrid.operators.unify import NORM_SPEC


def windows_before(dates: list[dt.date]) -> PN.Windows:
    """Everything before each date's midnight."""
    return PN.Windows(tuple((d, (dt.date.min, False), (d, False)) for d in dates))


def _rounded_mean(name: str, value: Column) -> PN.Measure:
    """Exact decimal mean, 2 digits, as double; NULL without values."""
    states = (F.sum(value.cast("decimal(24,6)")), F.count(value))
    return PN.Measure(name, states, "sum", lambda s, n: F.round(s.cast("decimal(28,6)") / F.nullif(n.cast("decimal(12,0)"), F.lit(0)), 2).cast("double"))


def _attended_sum(name: str, attended: Column, column: str) -> PN.Measure:
    return PN.Measure(name, (F.sum(F.when(attended, F.col(column)).otherwise(F.lit(0.0)).cast("decimal(24,6)")),), "sum", lambda s: s.cast("double"))


def _measures(channel: str) -> list[PN.Measure]:
    ts, et = F.col(SILVER_TS[channel]), F.col("event_type")
    if channel == "email":
        return [
            PN.count("emails_delivered", et == "delivered"), PN.count("email_opens", et == "open"), PN.count("email_clicks", et == "click"),
            PN.greatest("last_email", F.when(et.isin("open", "click"), ts)),
        ]
    if channel == "web":
        return [
            PN.count("content_views", et == "content_view"), PN.count("downloads", et == "download"),
            PN.count("video_starts", et == "video_start"), PN.count("video_completions", et == "video_complete"),
            _rounded_mean("avg_session_duration", F.col("session_duration_seconds")),
            PN.greatest("last_web", F.when(et.isin("content_view", "download", "video_start", "video_complete"), ts)),
        ]
    if channel == "rep":
        done = F.col("interaction_status") == "Completed"
        return [
            PN.count("total_veeva_interactions", F.lit(True)), PN.count("completed_interactions", done),
            _rounded_mean("avg_interaction_duration_minutes", F.col("interaction_duration_minutes")),
            PN.greatest("last_veeva", F.when(done, ts)),
        ]
    attended = F.col("event_activity_type") == "attendance"
    return [
        PN.count("event_registrations", F.col("event_activity_type") == "registration"), PN.count("event_attendance", attended),
        _rounded_mean("avg_event_attendance_duration", F.when(attended, F.col("attendance_duration_minutes"))),
        _attended_sum("event_questions", attended, "questions_asked"), _attended_sum("event_polls", attended, "poll_responses"),
        PN.greatest("last_event", F.when(attended, ts)),
    ]


_RATES = {
    "email_open_rate": ("email_opens", "emails_delivered"), "email_click_rate": ("email_clicks", "emails_delivered"), "email_ctor": ("email_clicks", "email_opens"),
    "download_rate": ("downloads", "content_views"), "video_completion_rate": ("video_completions", "video_starts"),
    "event_attendance_rate": ("event_attendance", "event_registrations"),
}


def features_asof(silvers: dict[str, DataFrame], entities: DataFrame, dates: list[dt.date], data_start: dt.date) -> DataFrame:
    """(hcp_id, snapshot_date, the 20 columns that are scaled) for every entity and
    date, from rows of earlier days. An entity without activity has zeros and a
    recency of all days since ``data_start``."""
    out = entities.select("hcp_id", F.explode(F.array(*[F.lit(d.isoformat()).cast("date") for d in dates])).alias("snapshot_date"))
    windows = windows_before(dates)
    for ch, silver in silvers.items():
        out = PN.meet(out, PN.window_aggregates(silver, "hcp_id", SILVER_TS[ch], windows, _measures(ch)))
    days = F.datediff(F.col("snapshot_date"), F.lit(data_start.isoformat()).cast("date"))
    cols = []
    for name, src, _ in NORM_SPEC:
        if src is None:
            value = F.col("completed_interactions").cast("double") / F.nullif(F.col("total_veeva_interactions").cast("double"), F.lit(0.0))
        elif src.startswith("days_since_last_"):
            last = "last_" + src.removeprefix("days_since_last_").removesuffix("_engagement")
            value = F.coalesce(F.datediff(F.col("snapshot_date"), F.to_date(F.col(last))), days).cast("double")
        elif src in _RATES:
            value = F.coalesce(ratio(*map(F.col, _RATES[src])), F.lit(0.0))
        else:
            value = F.coalesce(F.col(src).cast("double"), F.lit(0.0))
        cols.append(value.alias(name.removeprefix("norm_")))
    return out.select("hcp_id", "snapshot_date", *cols)


def asof_bounds(features: DataFrame) -> DataFrame:
    """Minimum and maximum of every scaled column, one row a date."""
    names = [n.removeprefix("norm_") for n, _, _ in NORM_SPEC]
    return features.groupBy("snapshot_date").agg(*[f(n).alias(f"{p}_{n}") for n in names for p, f in (("min", F.min), ("max", F.max))])


def features_normalized_asof(features: DataFrame) -> DataFrame:
    """(hcp_id, snapshot_date, 20 ``norm_`` columns) scaled by the date's own bounds;
    a constant column is 0, recencies are inverted. The bounds are one row a
    date of the parameter list, hence the broadcast."""
    x = features.join(F.broadcast(asof_bounds(features)), "snapshot_date")
    cols = []
    for name, _, inverted in NORM_SPEC:
        n = name.removeprefix("norm_")
        lo, hi = F.col(f"min_{n}"), F.col(f"max_{n}")
        part = (F.col(n) - lo) / F.nullif(hi - lo, F.lit(0.0))
        cols.append(F.when(hi == lo, F.lit(0.0)).otherwise(F.lit(1.0) - part if inverted else part).alias(name))
    return x.select("hcp_id", "snapshot_date", *cols)
