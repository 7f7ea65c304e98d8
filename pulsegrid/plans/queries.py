
from __future__ import annotations

import dataclasses

from pulsegrid.config import RunConfig
from pulsegrid.operators import features as FT
from pulsegrid.operators import silver as SV
from pulsegrid.plans import oracle as O
from pulsegrid.plans.catalog import register

CFG = RunConfig()
CHANNELS = ("email", "web", "rep", "event")


# --- silver layer (P1-P10, W1, F1) -------------------------------------------
def _silver_query(ch: str):
    def q(spark, sf_dir):
        return SV.silver(spark, sf_dir, ch)

    return q


for _ch in CHANNELS:
    register(f"silver_{_ch}", O.ctes(f"silver_{_ch}") + f"SELECT * FROM silver_{_ch}")(_silver_query(_ch))


# --- channel features (A3-A11) -----------------------------------------------
def feature_table(spark, sf_dir, ch: str, cfg: RunConfig = CFG, silver=None):
    return FT.FEATURES[ch](SV.silver(spark, sf_dir, ch) if silver is None else silver, cfg.as_of)


def _feat_query(ch: str):
    def q(spark, sf_dir):
        return feature_table(spark, sf_dir, ch)

    return q


for _ch in CHANNELS:
    register(f"feat_{_ch}", O.ctes(f"feat_{_ch}") + f"SELECT * FROM feat_{_ch}")(_feat_query(_ch))


# --- profiling and data quality (A1, A2, A12-A18, F5, J1, Q1-Q9) ------------
from pyspark.sql import functions as F  # noqa: E402

from pulsegrid.operators import quality as Q  # noqa: E402
from pulsegrid.plans.channels import SPECS  # noqa: E402
from pulsegrid.sources.adapters import bronze_master  # noqa: E402

LABEL = {"email": "email", "web": "web", "rep": "veeva", "event": "event"}

RANGES = {
    "email": {
        "email_ctor": ("ctor", 4),
        "email_open_rate": ("open_rate", 4),
        "email_click_rate": ("click_rate", 4),
    },
    "web": {
        "download_rate": ("download_rate", 4),
        "video_completion_rate": ("video_completion_rate", 4),
        "avg_session_duration": ("avg_session_duration", 2),
    },
    "rep": {"avg_interaction_duration_minutes": ("avg_duration", 2)},
    "event": {"event_attendance_rate": ("attendance_rate", 4), "avg_event_attendance_duration": ("avg_duration", 2)},
}
NEGATIVE_FEATURES = {
    "email": ["email_open_rate", "email_click_rate", "email_ctor"],
    "web": [
        "page_views", "content_views", "downloads", "download_rate", "video_starts",
        "video_completions", "video_completion_rate", "avg_session_duration",
    ],
    "rep": [
        "total_veeva_interactions", "in_person_visits", "phone_calls", "virtual_meetings",
        "completed_interactions", "cancelled_interactions", "no_show_interactions",
        "avg_interaction_duration_minutes", "followups_required",
    ],
    "event": [
        "total_event_activities", "event_registrations", "event_attendance", "event_attendance_rate",
        "avg_event_attendance_duration", "max_event_attendance_duration", "event_questions", "event_polls",
    ],
}


def _sql_range(ch: str) -> str:
    parts = []
    for c, (short, digits) in RANGES[ch].items():
        parts += [f"MIN({c}) AS min_{short}", f"MAX({c}) AS max_{short}", f"{O.rnd(O.xavg(c), digits)} AS avg_{short}"]
    return O.ctes(f"feat_{ch}") + f"SELECT {', '.join(parts)} FROM feat_{ch}"


def _bronze(ch: str):
    from pulsegrid.sources.adapters import BRONZE as _B

    return _B[ch]


def _reg_channel_quality(ch: str) -> None:
    spec = SPECS[ch]
    lab = LABEL[ch]
    sv = f"silver_{ch}"
    ft = f"feat_{ch}"
    dcols = ["hcp_id", *spec.distinct_extra]

    def silver_df(spark, sf_dir):
        return SV.silver(spark, sf_dir, ch)

    def feat_df(spark, sf_dir):
        return feature_table(spark, sf_dir, ch)

    register(
        f"profile_counts_{ch}",
        O.ctes(sv) + "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
        + ", ".join(f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS unique_{c}" for c in dcols) + f" FROM {sv}",
    )(lambda spark, sf_dir: Q.profile_counts(silver_df(spark, sf_dir), dcols))

    bronze_name = f"bronze_{ch}"
    register(
        f"bronze_counts_{ch}",
        O.ctes(bronze_name) + "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
        + ", ".join(f"CAST(COUNT(DISTINCT {c}) AS BIGINT) AS unique_{c}" for c in dcols) + f" FROM {bronze_name}",
    )(lambda spark, sf_dir: Q.profile_counts(_bronze(ch)(spark, sf_dir), dcols))

    union = " UNION ALL ".join(
        f"SELECT '{c}' AS category, CAST({c} AS VARCHAR) AS value, CAST(COUNT(*) AS BIGINT) AS records, "
        f"CAST(COUNT(DISTINCT hcp_id) AS BIGINT) AS unique_hcps FROM {sv} GROUP BY {c}"
        for c in spec.categories
    )
    register(f"category_distribution_{ch}", O.ctes(sv) + union)(
        lambda spark, sf_dir: Q.category_distribution(silver_df(spark, sf_dir), spec.categories)
    )

    register(f"category_distribution_bronze_{ch}", O.ctes(bronze_name) + union.replace(f"FROM {sv} ", f"FROM {bronze_name} "))(
        lambda spark, sf_dir: Q.category_distribution(_bronze(ch)(spark, sf_dir), spec.categories)
    )

    register(
        f"dq_duplicate_ids_{ch}",
        O.ctes(sv) + f"SELECT CAST(COUNT(*) AS BIGINT) AS duplicate_{lab}_event_ids FROM "
        f"(SELECT {spec.key} FROM {sv} GROUP BY {spec.key} HAVING COUNT(*) > 1)",
    )(lambda spark, sf_dir: Q.duplicate_key_count(silver_df(spark, sf_dir), spec.key, f"duplicate_{lab}_event_ids"))

    ncols = [spec.key, "hcp_id", spec.gate_type, spec.ts]
    register(
        f"dq_null_counts_{ch}",
        O.ctes(sv) + "SELECT " + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_{c}" for c in ncols)
        + f" FROM {sv}",
    )(lambda spark, sf_dir: Q.null_counts(silver_df(spark, sf_dir), ncols))

    register(
        f"activity_range_{ch}",
        O.ctes(sv) + f"SELECT MIN({spec.ts}) AS first_{lab}_activity, MAX({spec.ts}) AS last_{lab}_activity FROM {sv}",
    )(lambda spark, sf_dir: Q.activity_range(silver_df(spark, sf_dir), spec.ts, lab))

    register(
        f"entity_coverage_{ch}",
        O.ctes(sv) + f"SELECT CAST(COUNT(DISTINCT hcp_id) AS BIGINT) AS {lab}_active_hcps FROM {sv}",
    )(lambda spark, sf_dir: Q.entity_coverage(silver_df(spark, sf_dir), lab))

    register(
        f"feature_counts_{ch}",
        O.ctes(ft) + f"SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(COUNT(DISTINCT hcp_id) AS BIGINT) AS unique_hcp_id FROM {ft}",
    )(lambda spark, sf_dir: Q.profile_counts(feat_df(spark, sf_dir), ["hcp_id"]))

    register(
        f"dq_duplicate_entities_{ch}",
        O.ctes(ft) + f"SELECT hcp_id, CAST(COUNT(*) AS BIGINT) AS records FROM {ft} GROUP BY hcp_id HAVING COUNT(*) > 1",
    )(lambda spark, sf_dir: Q.duplicate_listing(feat_df(spark, sf_dir)))

    register(
        f"coverage_vs_master_{ch}",
        O.ctes("bronze_master", ft) + f"SELECT CAST(COUNT(DISTINCT h.hcp_id) AS BIGINT) AS total_hcps, "
        f"CAST(COUNT(DISTINCT f.hcp_id) AS BIGINT) AS {lab}_active_hcps FROM bronze_master h LEFT JOIN {ft} f ON h.hcp_id = f.hcp_id",
    )(lambda spark, sf_dir: Q.coverage_vs_master(bronze_master(spark, sf_dir), feat_df(spark, sf_dir), lab))

    register(f"feature_ranges_{ch}", _sql_range(ch))(
        lambda spark, sf_dir: Q.range_stats(feat_df(spark, sf_dir), RANGES[ch])
    )

    negs = NEGATIVE_FEATURES[ch]
    register(
        f"dq_negative_{ch}",
        O.ctes(ft) + f"SELECT CAST(COUNT(*) AS BIGINT) AS invalid_{lab}_records FROM {ft} WHERE "
        + " OR ".join(f"{c} < 0" for c in negs),
    )(lambda spark, sf_dir: Q.negative_rows(feat_df(spark, sf_dir), negs, f"invalid_{lab}_records"))

    def observed_checks(spark, sf_dir):
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/observed-{uuid.uuid4().hex}"
        return Q.observed(silver_df(spark, sf_dir), Q.scalar_checks(spec), lambda df: df.write.parquet(path))

    nulls = list(dict.fromkeys(ncols))
    register(
        f"observed_quality_{ch}",
        O.ctes(sv) + "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
        + ", ".join(f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_{c}" for c in nulls)
        + "".join(f", CAST(COUNT(*) FILTER (WHERE {' OR '.join(f'{c} < 0' for c in spec.non_negative)}) AS BIGINT) AS negative_values" for _ in spec.non_negative[:1])
        + f", MIN({spec.ts}) AS first_activity, MAX({spec.ts}) AS last_activity"
        + "".join(f", CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS unnamed_{c}" for c in spec.categories) + f" FROM {sv}",
    )(observed_checks)

    if spec.non_negative:
        nn = list(spec.non_negative)
        register(
            f"dq_negative_silver_{ch}",
            O.ctes(sv) + f"SELECT CAST(COUNT(*) AS BIGINT) AS negative_values FROM {sv} WHERE "
            + " OR ".join(f"{c} < 0" for c in nn),
        )(lambda spark, sf_dir: Q.negative_rows(silver_df(spark, sf_dir), nn, "negative_values"))

    register(
        f"sample_ordered_{ch}",
        O.ctes(ft) + f"SELECT * FROM {ft} ORDER BY hcp_id LIMIT 10",
    )(lambda spark, sf_dir: feat_df(spark, sf_dir).orderBy("hcp_id").limit(10))

    register(
        f"scan_sample_{ch}",
        O.ctes(sv) + f"SELECT * FROM {sv} ORDER BY {spec.key} LIMIT 10",
    )(lambda spark, sf_dir: silver_df(spark, sf_dir).orderBy(spec.key).limit(10))


    # the raw log, before any cleaning: keys repeat there, so all columns order the rows
    register(f"scan_sample_bronze_{ch}", O.ctes(bronze_name) + f"SELECT * FROM {bronze_name} ORDER BY ALL ASC NULLS FIRST LIMIT 10")(
        lambda spark, sf_dir: (lambda raw: raw.orderBy(*[F.col(c).asc_nulls_first() for c in raw.columns]).limit(10))(_bronze(ch)(spark, sf_dir))
    )


for _ch in CHANNELS:
    _reg_channel_quality(_ch)


def _recompute_sql(ch: str, num: str, den: str, stored: str, out: str) -> str:
    return O.ctes(f"feat_{ch}") + (
        f"SELECT hcp_id, {den}, {num}, {stored}, "
        f"{O.rnd(f'CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)', 4)} AS {out} FROM feat_{ch}"
    )


register("dq_ctor_recompute", _recompute_sql("email", "email_clicks", "email_opens", "email_ctor", "calculated_ctor"))(
    lambda spark, sf_dir: Q.recompute_ratio(feature_table(spark, sf_dir, "email"), "email_clicks", "email_opens", "email_ctor", "calculated_ctor")
)
register(
    "dq_download_recompute", _recompute_sql("web", "downloads", "content_views", "download_rate", "calculated_download_rate")
)(
    lambda spark, sf_dir: Q.recompute_ratio(
        feature_table(spark, sf_dir, "web"), "downloads", "content_views", "download_rate", "calculated_download_rate"
    )
)
register(
    "dq_attendance_recompute",
    _recompute_sql("event", "event_attendance", "event_registrations", "event_attendance_rate", "calculated_attendance_rate"),
)(
    lambda spark, sf_dir: Q.recompute_ratio(
        feature_table(spark, sf_dir, "event"),
        "event_attendance",
        "event_registrations",
        "event_attendance_rate",
        "calculated_attendance_rate",
    )
)
register(
    "dq_rep_completion",
    O.ctes("feat_rep")
    + "SELECT hcp_id, total_veeva_interactions, completed_interactions, "
    + O.rnd("CAST(completed_interactions AS DOUBLE) / NULLIF(CAST(total_veeva_interactions AS DOUBLE), 0)", 4)
    + " AS veeva_completion_rate FROM feat_rep",
)(
    lambda spark, sf_dir: feature_table(spark, sf_dir, "rep").select(
        "hcp_id",
        "total_veeva_interactions",
        "completed_interactions",
        Q.ratio(F.col("completed_interactions"), F.col("total_veeva_interactions")).alias("veeva_completion_rate"),
    )
)
register(
    "dq_count_consistency",
    O.ctes("feat_rep")
    + "SELECT hcp_id, total_veeva_interactions, in_person_visits + phone_calls + virtual_meetings AS calculated_total_interactions "
    "FROM feat_rep WHERE total_veeva_interactions != in_person_visits + phone_calls + virtual_meetings",
)(lambda spark, sf_dir: Q.count_consistency(feature_table(spark, sf_dir, "rep")))
register(
    "dq_attendance_gt_reg",
    O.ctes("feat_event")
    + "SELECT CAST(COUNT(*) AS BIGINT) AS invalid_attendance_records FROM feat_event WHERE event_attendance > event_registrations",
)(
    lambda spark, sf_dir: feature_table(spark, sf_dir, "event")
    .where(F.col("event_attendance") > F.col("event_registrations"))
    .agg(F.count(F.lit(1)).alias("invalid_attendance_records"))
)
register(
    "clicks_without_open",
    O.ctes("silver_email")
    + "SELECT CAST(COUNT(*) AS BIGINT) AS clicks_without_open FROM silver_email WHERE event_type = 'click' AND email_id NOT IN "
    "(SELECT DISTINCT email_id FROM silver_email WHERE event_type = 'open' AND email_id IS NOT NULL)",
)(lambda spark, sf_dir: Q.clicks_without_open(SV.silver(spark, sf_dir, "email")))
register(
    "attendance_without_reg",
    O.ctes("silver_event")
    + "SELECT CAST(COUNT(*) AS BIGINT) AS attendance_without_registration FROM silver_event a WHERE a.event_activity_type = 'attendance' "
    "AND NOT EXISTS (SELECT 1 FROM silver_event r WHERE r.hcp_id = a.hcp_id AND r.event_id = a.event_id AND r.event_activity_type = 'registration')",
)(lambda spark, sf_dir: Q.attendance_without_registration(SV.silver(spark, sf_dir, "event")))
register(
    "completion_rate",
    O.ctes("silver_rep")
    + "SELECT CAST(COUNT(*) AS BIGINT) AS total_interactions, "
    "CAST(SUM(CASE WHEN interaction_status = 'Completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed_interactions, "
    + O.rnd("CAST(SUM(CASE WHEN interaction_status = 'Completed' THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0)", 4)
    + " AS overall_completion_rate FROM silver_rep",
)(lambda spark, sf_dir: Q.completion_rate(SV.silver(spark, sf_dir, "rep")))
register(
    "session_validation",
    O.ctes("silver_web")
    + "SELECT CAST(COUNT(DISTINCT session_id) AS BIGINT) AS unique_sessions, "
    "CAST(COUNT(DISTINCT CASE WHEN event_type = 'page_view' THEN session_id END) AS BIGINT) AS sessions_with_page_view FROM silver_web",
)(lambda spark, sf_dir: Q.session_validation(SV.silver(spark, sf_dir, "web")))


# --- unification (J2, P12, A19-A22, X1-X3, J4, Q10) ---------------------------
from pulsegrid.operators import unify as U  # noqa: E402


def channel_features(spark, sf_dir, cfg: RunConfig = CFG, silvers: dict | None = None) -> dict:
    return {ch: feature_table(spark, sf_dir, ch, cfg, (silvers or {}).get(ch)) for ch in CHANNELS}


def unified_raw(spark, sf_dir, cfg: RunConfig = CFG, silvers: dict | None = None):
    return U.features_raw(bronze_master(spark, sf_dir), channel_features(spark, sf_dir, cfg, silvers))


def unified_complete(spark, sf_dir, cfg: RunConfig = CFG, silvers: dict | None = None):
    return U.features_complete(unified_raw(spark, sf_dir, cfg, silvers), cfg.recency_fill)


register("features_raw", O.ctes("features_raw") + "SELECT * FROM features_raw")(unified_raw)
register("features_complete", O.ctes("features_complete") + "SELECT * FROM features_complete")(unified_complete)
register("norm_stats", O.ctes("norm_stats") + "SELECT * FROM norm_stats")(
    lambda spark, sf_dir: U.norm_stats(unified_complete(spark, sf_dir))
)
register("features_normalized", O.ctes("features_normalized") + "SELECT * FROM features_normalized")(
    lambda spark, sf_dir: U.features_normalized(unified_complete(spark, sf_dir))
)


def _final(spark, sf_dir):
    return U.features_final_direct(cut_lineage(unified_complete(spark, sf_dir)))


register("features_final", O.ctes("features_final") + "SELECT * FROM features_final")(_final)
register(
    "dq_norm_range",
    O.ctes("features_normalized")
    + "SELECT " + ", ".join(f"MIN({n}) AS min_{n[5:]}, MAX({n}) AS max_{n[5:]}" for n in U.NORM_COLUMNS)
    + " FROM features_normalized",
)(lambda spark, sf_dir: U.norm_range(U.features_normalized(unified_complete(spark, sf_dir))))
register(
    "channel_counts",
    O.ctes("feat_email", "feat_web", "feat_rep", "feat_event")
    + " UNION ALL ".join(
        f"SELECT '{lab}' AS channel, CAST(COUNT(*) AS BIGINT) AS hcp_records, CAST(COUNT(DISTINCT hcp_id) AS BIGINT) AS unique_hcps FROM feat_{ch}"
        for ch, lab in (("email", "EMAIL"), ("web", "WEB"), ("rep", "VEEVA"), ("event", "EVENT"))
    ),
)(lambda spark, sf_dir: U.channel_counts(channel_features(spark, sf_dir)))
register(
    "channel_coverage",
    O.ctes("features_raw")
    + "SELECT CAST(COUNT(*) AS BIGINT) AS total_hcps, CAST(COUNT(emails_delivered) AS BIGINT) AS email_hcps, "
    "CAST(COUNT(total_web_events) AS BIGINT) AS web_hcps, CAST(COUNT(total_veeva_interactions) AS BIGINT) AS veeva_hcps, "
    "CAST(COUNT(total_event_activities) AS BIGINT) AS event_hcps FROM features_raw",
)(lambda spark, sf_dir: U.channel_coverage(unified_raw(spark, sf_dir)))
register(
    "dq_null_counts_unified",
    O.ctes("features_complete")
    + "SELECT CAST(COUNT(*) AS BIGINT) AS total_hcps, "
    + ", ".join(
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {k}"
        for k, c in (
            ("null_email_features", "emails_delivered"), ("null_web_features", "content_views"),
            ("null_veeva_features", "total_veeva_interactions"), ("null_event_features", "total_event_activities"),
            ("null_email_recency", "days_since_last_email_engagement"), ("null_web_recency", "days_since_last_web_engagement"),
            ("null_veeva_recency", "days_since_last_veeva_engagement"), ("null_event_recency", "days_since_last_event_engagement"),
        )
    )
    + " FROM features_complete",
)(lambda spark, sf_dir: U.unified_null_report(unified_complete(spark, sf_dir)))
register(
    "dq_duplicate_entities_unified",
    O.ctes("features_raw") + "SELECT hcp_id, CAST(COUNT(*) AS BIGINT) AS records FROM features_raw GROUP BY hcp_id HAVING COUNT(*) > 1",
)(lambda spark, sf_dir: Q.duplicate_listing(unified_raw(spark, sf_dir)))
register(
    "sample_ordered_final",
    O.ctes("features_final") + "SELECT * FROM features_final ORDER BY hcp_id LIMIT 10",
)(lambda spark, sf_dir: _final(spark, sf_dir).orderBy("hcp_id").limit(10))


# --- snapshots (J8-J12, F2, F3, A23-A26, X4-X9, P13) ----------------------------
from pulsegrid.config import PROFILE_A, PROFILE_B  # noqa: E402
from pulsegrid.operators import panes as PN  # noqa: E402
from pulsegrid.operators import snapshots as SN  # noqa: E402


def silvers(spark, sf_dir) -> dict:
    """The four silver logs, each cleaned and de-duplicated once into the shared
    folder: every later branch reads these files instead of the raw logs."""
    ensure_checkpoint_dir(spark)
    out = at_once(lambda ch: cut_lineage(SV.silver(spark, sf_dir, ch)), CHANNELS)
    release_shuffles(spark)
    return out


def master_ids(spark, sf_dir):
    return bronze_master(spark, sf_dir).select("hcp_id").where(F.col("hcp_id").isNotNull()).distinct()


def snapshot_table(spark, sf_dir, p, with_norm: bool = True, with_labels: bool = True, cfg: RunConfig = CFG):
    sv = silvers(spark, sf_dir)
    norm = U.features_normalized(cut_lineage(unified_complete(spark, sf_dir, cfg, sv))) if with_norm else None
    release_shuffles(spark)
    feats = SN.snapshot_features(sv, master_ids(spark, sf_dir), norm, p)
    if with_labels:
        feats = SN.attach_labels(feats, SN.snapshot_labels(sv, p))
    return feats


def _snap_channel_sql(p, ch: str) -> str:
    q = O.snapshot_ctes(p)
    keep = ["snap_dates", f"snap_{ch}_rows", f"snap_{ch}_g", f"snap_{ch}"]
    head = O.ctes(f"silver_{ch}").rstrip("\n")
    body = ",\n".join(f"{k} AS ({q[k]})" for k in keep)
    return f"{head},\n{body}\nSELECT * FROM snap_{ch}"


for _ch in ("email", "web", "event", "rep"):
    register(f"snapshot_{_ch}", _snap_channel_sql(PROFILE_A, _ch))(
        (lambda c: lambda spark, sf_dir: SN.channel_history(cut_lineage(SV.silver(spark, sf_dir, c)), c, PROFILE_A))(_ch)
    )

register("snapshot_features", O.snapshot_sql(PROFILE_A, with_norm=True, with_labels=True))(
    lambda spark, sf_dir: snapshot_table(spark, sf_dir, PROFILE_A)
)
register("snapshot_features_b", O.snapshot_sql(PROFILE_B, with_norm=True, with_labels=True))(
    lambda spark, sf_dir: snapshot_table(spark, sf_dir, PROFILE_B)
)
register("cross_channel", O.snapshot_sql(PROFILE_A, with_norm=False, with_labels=False))(
    lambda spark, sf_dir: snapshot_table(spark, sf_dir, PROFILE_A, with_norm=False, with_labels=False)
)


def _labels_sql(p, label_set: str = "train") -> str:
    full = O.snapshot_sql(p, with_norm=False, with_labels=True, label_set=label_set)
    return full.replace("SELECT * FROM snap_final", "SELECT hcp_id, snapshot_date, split, email_target, web_target, webinar_target, veeva_target FROM snap_final")


def _labels_df(spark, sf_dir, p, label_set: str = "train"):
    sv = silvers(spark, sf_dir)
    sp = SN.spine(master_ids(spark, sf_dir), p)
    return SN.attach_labels(sp, SN.snapshot_labels(sv, p, label_set))


register("snapshot_labels", _labels_sql(PROFILE_A))(lambda spark, sf_dir: _labels_df(spark, sf_dir, PROFILE_A))
register("snapshot_labels_b", _labels_sql(PROFILE_B))(lambda spark, sf_dir: _labels_df(spark, sf_dir, PROFILE_B))
register("snapshot_labels_b_eval", _labels_sql(PROFILE_B, "eval"))(lambda spark, sf_dir: _labels_df(spark, sf_dir, PROFILE_B, "eval"))

# profile A with attendance read from the attendance status
STATUS_A = dataclasses.replace(PROFILE_A, attendance_rule="status")
register("snapshot_features_status", O.snapshot_sql(STATUS_A, with_norm=False, with_labels=True))(
    lambda spark, sf_dir: snapshot_table(spark, sf_dir, STATUS_A, with_norm=False, with_labels=True)
)

# the profile's own 60 / 30 day windows on the driver dates
LONG_A = dataclasses.replace(PROFILE_A, hist_days=60, fut_days=30)
register("snapshot_features_60d", O.snapshot_sql(LONG_A, with_norm=False, with_labels=True))(
    lambda spark, sf_dir: snapshot_table(spark, sf_dir, LONG_A, with_norm=False, with_labels=True)
)


def _window_counts_sql(p, history: bool, ch: str = "email") -> str:
    days = p.hist_days if history else p.fut_days
    return (
        O.ctes(f"silver_{ch}").rstrip("\n") + ",\n"
        + f"snap_dates AS ({O._dates_cte(p)})\n"
        + "SELECT d.snapshot_date, CAST(COUNT(*) AS BIGINT) AS rows_in_window, CAST(COUNT(DISTINCT s.hcp_id) AS BIGINT) AS entities "
        + f"FROM silver_{ch} s JOIN snap_dates d ON {O._win(SN.SILVER_TS[ch], days, history, p)} GROUP BY d.snapshot_date"
    )


def _window_counts(spark, sf_dir, p, history: bool, ch: str = "email"):
    windows = SN.history_windows(p) if history else SN.label_windows(p)
    rows = PN.window_aggregates(SV.silver(spark, sf_dir, ch), "hcp_id", SN.SILVER_TS[ch], windows, [PN.count("rows", F.lit(True))])
    return rows.groupBy("snapshot_date").agg(F.sum("rows").alias("rows_in_window"), F.count("hcp_id").alias("entities"))


# email keeps the plain names; profile B takes the suffix _b
for _p, _suffix in ((PROFILE_A, ""), (PROFILE_B, "_b")):
    for _ch in CHANNELS:
        for _name, _history in (("history_window", True), ("label_window", False)):
            register(_name + ("" if _ch == "email" else f"_{_ch}") + _suffix, _window_counts_sql(_p, _history, _ch))(
                (lambda p, h, c: lambda spark, sf_dir: _window_counts(spark, sf_dir, p, h, c))(_p, _history, _ch)
            )


# --- sinks and sources: written, read back (S2-S6, S8) ---------------------------
import uuid  # noqa: E402

from pulsegrid.session import ensure_checkpoint_dir  # noqa: E402
from pulsegrid.sources import layers as LY  # noqa: E402
from pulsegrid.sources import sinks as SK  # noqa: E402
from pulsegrid.sources import tables as TB  # noqa: E402


def _fresh_path(spark, tag: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@register("layer_round_trip", O.ctes("silver_email") + "SELECT * FROM silver_email")
def layer_round_trip(spark, sf_dir):
    """The email log as version 1, its silver layer as version 2 of one table."""
    path = _fresh_path(spark, "layer")
    LY.replace_layer(_bronze("email")(spark, sf_dir), path)
    LY.replace_layer(SV.silver(spark, sf_dir, "email"), path)
    return LY.read_layer(spark, path)


@register("layer_pinned", O.ctes("bronze_email") + "SELECT * FROM bronze_email")
def layer_pinned(spark, sf_dir):
    """A reader pinned to version 1 keeps it after the table was replaced."""
    path = _fresh_path(spark, "layer")
    LY.replace_layer(_bronze("email")(spark, sf_dir), path)
    LY.replace_layer(SV.silver(spark, sf_dir, "email"), path)
    return LY.read_layer(spark, path, version=1)


@register("csv_typed_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_typed_round_trip(spark, sf_dir):
    path = _fresh_path(spark, "csv")
    rows = TB.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    SK.write_csv(rows, path)
    return TB.read_csv_typed(spark, path, rows.schema).drop("_corrupt_record")


@register("csv_raw_round_trip", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def csv_raw_round_trip(spark, sf_dir):
    path = _fresh_path(spark, "csv")
    SK.write_csv(TB.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), path)
    return TB.read_csv_raw(spark, path)


# --- leak-free normalisation (J10 and the option of SURVEY 7.1) -------------------
from pulsegrid.operators import asof as AO  # noqa: E402
from pulsegrid.operators import comoments as CM  # noqa: E402

ASOF_DATES = [d for d, _ in PROFILE_A.all_dates()]


@register("features_normalized_asof", O.asof_sql(ASOF_DATES, CFG.data_start))
def features_normalized_asof(spark, sf_dir):
    found = cut_lineage(AO.features_asof(silvers(spark, sf_dir), master_ids(spark, sf_dir), ASOF_DATES, CFG.data_start))
    return AO.features_normalized_asof(found)


# --- scoring and metrics on deterministic propensities (M9-M24, M32, T6, W2, U2) -----
from pulsegrid.operators import metrics as MT  # noqa: E402
from pulsegrid.operators import scoring as SC  # noqa: E402
from pulsegrid.session import at_once, cut_lineage, release_shuffles  # noqa: E402

PA = PROFILE_A
TARGET_OF = dict(zip(SC.PROBS, SC.TARGETS))
CHANNEL_NAME = dict(zip(SC.TARGETS, ["Email", "Website", "Webinar", "Sales Rep"]))


def score_snapshot_frame(snap, p=PA, checkpoint: bool = True, keep=()):
    """Rate propensities, train-fitted history score and predicted score on snapshot rows."""
    df = SC.rate_propensities(snap).select(
        "hcp_id", "snapshot_date", "split", "total_touchpoints", *SC.PROBS, *SC.TARGETS, *keep
    )
    if checkpoint:
        df = cut_lineage(df)
    lo, hi = SC.fit_range(df.where(F.col("split") == "train"), "total_touchpoints")
    return df.select(
        "*",
        SC.minmax_0_100("total_touchpoints", lo, hi).alias("hist_score"),
        SC.predicted_score(p.channel_weights).alias("pred_score"),
    )


def scored_snapshots(spark, sf_dir, p=PA):
    """Snapshot rows with rate propensities, history score (train-fitted) and predicted score."""
    return score_snapshot_frame(snapshot_table(spark, sf_dir, p, with_norm=False, with_labels=True), p)


def _tier_cuts_b(spark, sf_dir):
    _, (wh, wp), (q33, q66), _ = fitted_scoring(spark, sf_dir, PROFILE_B)
    return spark.createDataFrame([(float(wh), float(wp), round(q33, 6), round(q66, 6))], "w_hist double, w_pred double, q33 double, q66 double")


def long_probs(df):
    """(target, prob, label) rows: the four channels stacked for grouped metrics."""
    arr = F.array(*[F.struct(F.lit(t).alias("target"), F.col(pcol).alias("prob"), F.col(t).alias("label"))
                    for pcol, t in TARGET_OF.items()])
    return df.select("split", F.explode(arr).alias("x")).select("split", "x.target", "x.prob", "x.label")


def _q_rate_propensities(spark, sf_dir):
    return scored_snapshots(spark, sf_dir)


def _q_roc(spark, sf_dir):
    lp = long_probs(scored_snapshots(spark, sf_dir)).where(F.col("split") == "test")
    return MT.roc_auc(lp, "prob", "label", ["target"]).select("target", F.round("roc_auc", 4).alias("roc_auc"))


def _q_pr(spark, sf_dir):
    lp = long_probs(scored_snapshots(spark, sf_dir)).where(F.col("split") == "test")
    return MT.pr_metrics(lp, "prob", "label", ["target"]).select(
        "target", F.round("pr_auc", 4).alias("pr_auc"), F.round("average_precision", 4).alias("average_precision")
    )


def _q_confusion(spark, sf_dir):
    lp = long_probs(scored_snapshots(spark, sf_dir)).where(F.col("split") == "test")
    m = MT.confusion_metrics(lp, "prob", "label", 0.5, ["target"])
    return m.select("target", *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def metrics_table(lp_test, threshold=0.5):
    roc = MT.roc_auc(lp_test, "prob", "label", ["target"])
    pr = MT.pr_metrics(lp_test, "prob", "label", ["target"])
    cm = MT.confusion_metrics(lp_test, "prob", "label", threshold, ["target"])
    names = F.create_map(*[x for t, n in CHANNEL_NAME.items() for x in (F.lit(t), F.lit(n))])
    per = roc.join(pr, "target").join(cm, "target").select(
        F.element_at(names, F.col("target")).alias("channel"),
        F.round("roc_auc", 4).alias("roc_auc"),
        F.round("pr_auc", 4).alias("pr_auc"),
        *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
    )
    cols = ["roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1"]
    overall = per.agg(F.lit("Overall").alias("channel"), *[F.round(F.avg(c), 4).alias(c) for c in cols])
    return per.unionByName(overall)


def _q_metrics_overall(spark, sf_dir):
    lp = long_probs(scored_snapshots(spark, sf_dir)).where(F.col("split") == "test")
    return metrics_table(lp)


def _q_threshold(spark, sf_dir):
    lp = long_probs(scored_snapshots(spark, sf_dir)).where(F.col("split") == "val")
    return MT.threshold_search(lp, "prob", "label", 0.75, ["target"]).select(
        "target", F.round("threshold", 6).alias("threshold"), F.round("accuracy", 6).alias("accuracy")
    )


def _val(spark, sf_dir):
    return scored_snapshots(spark, sf_dir).where(F.col("split") == "val")


def _q_spearman(spark, sf_dir):
    v = _val(spark, sf_dir).select(F.col("pred_score"), SC.future_intensity().alias("fut"))
    return MT.spearman(v, "pred_score", "fut").select(F.round("spearman", 6).alias("spearman"))


def _q_hybrid_grid(spark, sf_dir):
    g = SC.hybrid_grid(_val(spark, sf_dir))
    return g.select("cand", F.round("spearman", 6).alias("spearman"))


def _q_weight_grid(spark, sf_dir):
    g = SC.weight_grid(_val(spark, sf_dir))
    return g.select("cand", F.round("spearman", 6).alias("spearman"))


def _q_weight_gram(spark, sf_dir):
    return SC.weight_gram(_val(spark, sf_dir))


def _q_lift_rows(spark, sf_dir):
    """Every current entity's channel probabilities over the validation base rates."""
    df = scored_snapshots(spark, sf_dir)
    base = SC.base_rates(df.where(F.col("split") == "val")).first().asDict()
    lifts = [F.round(c, 6).alias(f"lift_{p[2:]}") for p, c in zip(SC.PROBS, SC.lift_columns(base))]
    return df.where(F.col("split") == "current").select("hcp_id", *lifts)


def metrics_table_b(lp):
    """Profile B's evaluation: the cut whose validation accuracy is nearest 0.75 per
    target, average precision, and an overall row of macro means with the pooled
    accuracy."""
    th = MT.threshold_search(lp.where(F.col("split") == "val"), "prob", "label", 0.75, ["target"])
    test = lp.where(F.col("split") == "test").join(th.select("target", F.col("threshold").alias("_thr")), "target")
    roc = MT.roc_auc(test, "prob", "label", ["target"])
    ap = MT.pr_metrics(test, "prob", "label", ["target"]).select("target", F.col("average_precision").alias("pr_auc"))
    cm = MT.confusion_metrics(test, "prob", "label", F.col("_thr"), ["target", "_thr"])
    hit = F.avg(((F.col("prob") >= F.col("_thr")) == (F.col("label") == 1)).cast("int"))
    names = F.create_map(*[x for t, n in zip(SC.TARGETS, SC.channel_labels(PROFILE_B.rep_label)) for x in (F.lit(t), F.lit(n))])
    cols = ["roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1"]
    per = roc.join(ap, "target").join(cm, "target").select(
        F.element_at(names, F.col("target")).alias("channel"), F.round("_thr", 6).alias("threshold"), *[F.round(c, 4).alias(c) for c in cols]
    )
    means = per.agg(*[F.round(F.avg(c), 4).alias(c) for c in cols if c != "accuracy"])
    overall = test.agg(F.round(hit, 4).alias("accuracy")).crossJoin(means)  # one row each
    overall = overall.select(F.lit("Overall").alias("channel"), F.lit(None).cast("double").alias("threshold"), *cols)
    return per.unionByName(overall)


def _q_weight_fit(spark, sf_dir):
    w = SC.fit_channel_weights(_val(spark, sf_dir))
    names = ["Email", "Web", "Webinar", "Veeva"]
    rows = spark.createDataFrame([(n, float(x)) for n, x in zip(names, w)], "channel string, weight double")
    return rows.select("channel", F.round("weight", 6).alias("weight"), F.round(F.col("weight") * 100, 4).alias("weight_percent"))


def fitted_scoring(spark, sf_dir, p=PA, scored=None):
    """Fit hybrid weights (Spearman grid), tier cuts and base rates on validation rows."""
    df = scored_snapshots(spark, sf_dir, p) if scored is None else scored
    val = df.where(F.col("split") == "val")
    if p.select_channel_weights:
        weights = SC.CHANNEL_WEIGHT_CANDIDATES[SC.pick_best(SC.weight_grid(val))]
        df = df.withColumn("pred_score", SC.predicted_score(weights, clip=p.clip_scores))
        val = df.where(F.col("split") == "val")
    best = SC.pick_best(SC.hybrid_grid(val), p.default_hybrid)
    wh, wp = SC.HYBRID_CANDIDATES[best]
    val_h = val.select(SC.hybrid_score("hist_score", "pred_score", wh, wp, clip=p.clip_scores).alias("h"))
    q33, q66 = MT.exact_quantiles(val_h, "h", list(p.quantiles))
    base = SC.base_rates(val).first().asDict()
    return df, (wh, wp), (q33, q66), base


def final_scores(spark, sf_dir, p=PA, scored=None, keep=()):
    """Deterministic gold table for the current snapshot (one row per entity), and
    the snapshot columns ``keep``."""
    df, (wh, wp), (q33, q66), base = fitted_scoring(spark, sf_dir, p, scored)
    cur = df.where(F.col("split") == "current").withColumn(
        "hybrid_score", SC.hybrid_score("hist_score", "pred_score", wh, wp, clip=p.clip_scores))
    vals = SC.lift_columns(base) if p.next_best_by_lift else [F.col(c) for c in SC.PROBS]
    return cur.select(
        "hcp_id",
        F.round("hist_score", 2).alias("historical_engagement_score"),
        F.round("pred_score", 2).alias("predicted_engagement_score"),
        F.round("hybrid_score", 2).alias("hybrid_engagement_score"),
        SC.tiers("hybrid_score", q33, q66, p.tier_cut_inclusive).alias("engagement_level"),
        F.round("p_email", 4).alias("email_probability"),
        F.round("p_web", 4).alias("website_probability"),
        F.round("p_webinar", 4).alias("webinar_probability"),
        F.round("p_rep", 4).alias("sales_rep_probability"),
        SC.next_best_channel(vals, SC.channel_labels(p.rep_label)).alias("next_best_channel"),
        *keep,
    )


def _q_tier_cuts(spark, sf_dir):
    _, (wh, wp), (q33, q66), _ = fitted_scoring(spark, sf_dir)
    return spark.createDataFrame([(float(wh), float(wp), round(q33, 6), round(q66, 6))], "w_hist double, w_pred double, q33 double, q66 double")


def _q_base_rates(spark, sf_dir):
    return SC.base_rates(_val(spark, sf_dir)).select(*[F.round(c, 8).alias(c) for c in [f"base_{p}" for p in SC.PROBS]])


def _q_score_summary(spark, sf_dir):
    g = final_scores(spark, sf_dir)
    cols = ["historical_engagement_score", "predicted_engagement_score", "hybrid_engagement_score",
            "email_probability", "website_probability", "webinar_probability", "sales_rep_probability"]
    arr = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in cols])
    long = g.select(F.explode(arr).alias("x")).select("x.metric", "x.v")
    return long.groupBy("metric").agg(
        F.min("v").alias("min"), F.max("v").alias("max"), F.round(F.avg("v"), 4).alias("mean")
    )


def _q_validation_summary(spark, sf_dir):
    """Per target, what the channel probabilities look like on the validation rows."""
    lp = long_probs(scored_snapshots(spark, sf_dir)).where(F.col("split") == "val")
    return lp.groupBy("target").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("bigint").alias("positives"), F.round(F.min("prob"), 6).alias("min_prob"),
        F.round(F.max("prob"), 6).alias("max_prob"), F.round(F.sum(F.col("prob").cast("decimal(38,12)")).cast("double") / F.count("prob"), 6).alias("mean_prob"),
    )


def _q_matrix_sanity(spark, sf_dir):
    """Rows, features, and missing or non-finite cells of the coerced feature matrix."""
    snap = snapshot_table(spark, sf_dir, PA, with_norm=True, with_labels=False)
    cols = ML.feature_columns(snap)
    x = ML.coerce_features(snap, cols)
    missing = sum(F.col(c).isNull().cast("int") for c in cols)
    odd = sum((F.isnan(c) | (F.abs(c) == float("inf"))).cast("int") for c in cols)
    return x.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(cols)).alias("features"), F.sum(missing).alias("missing"), F.sum(F.coalesce(odd, F.lit(0))).alias("non_finite"))


def _q_value_counts(spark, sf_dir):
    g = final_scores(spark, sf_dir)
    arr = F.array(F.struct(F.lit("engagement_level").alias("field"), F.col("engagement_level").alias("value")),
                  F.struct(F.lit("next_best_channel").alias("field"), F.col("next_best_channel").alias("value")))
    return g.select(F.explode(arr).alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("count"))


register("rate_propensities", O.scoring_sql("scored"))(_q_rate_propensities)
register("roc_auc", O.scoring_sql("roc_auc"))(_q_roc)
register("pr_auc", O.scoring_sql("pr_auc"))(_q_pr)
register("confusion_metrics", O.scoring_sql("confusion"))(_q_confusion)
register("metrics_overall", O.scoring_sql("metrics_overall"))(_q_metrics_overall)
register("threshold_search", O.scoring_sql("threshold"))(_q_threshold)
register("spearman", O.scoring_sql("spearman"))(_q_spearman)
register("hybrid_grid", O.scoring_sql("hybrid_grid"))(_q_hybrid_grid)
register("weight_grid", O.scoring_sql("weight_grid"))(_q_weight_grid)
register("weight_gram", O.scoring_sql("weight_gram"))(_q_weight_gram)
register("channel_weight_fit")(_q_weight_fit)
register("channel_lift_rows", O.scoring_sql("lift_rows"))(_q_lift_rows)
register("metrics_overall_b", O.scoring_sql("metrics_overall_b", PROFILE_B))(lambda spark, sf_dir: metrics_table_b(long_probs(scored_snapshots(spark, sf_dir, PROFILE_B))))
register("tier_cuts", O.scoring_sql("tier_cuts"))(_q_tier_cuts)
register("channel_lift", O.scoring_sql("base_rates"))(_q_base_rates)
register("final_scores", O.scoring_sql("final_scores"))(lambda spark, sf_dir: final_scores(spark, sf_dir))
register("score_summary", O.scoring_sql("score_summary"))(_q_score_summary)
register(
    "validation_summary",
    O.scoring_sql("scored").replace(
        "SELECT * FROM scored",
        "SELECT target, CAST(COUNT(*) AS BIGINT) AS rows, CAST(SUM(label) AS BIGINT) AS positives, "
        f"{O.rnd('MIN(prob)', 6)} AS min_prob, {O.rnd('MAX(prob)', 6)} AS max_prob, "
        f"{O.rnd('CAST(SUM(CAST(prob AS DECIMAL(38, 12))) AS DOUBLE) / COUNT(prob)', 6)} AS mean_prob FROM lp WHERE split = 'val' GROUP BY target",
    ),
)(_q_validation_summary)
register("value_counts", O.scoring_sql("value_counts"))(_q_value_counts)
register("final_scores_b", O.scoring_sql("final_scores", PROFILE_B))(lambda spark, sf_dir: final_scores(spark, sf_dir, PROFILE_B))
register("tier_cuts_b", O.scoring_sql("tier_cuts", PROFILE_B))(_tier_cuts_b)


# --- serving (A27-A33, F7-F9, F11, J13, S7, S10-S13, T3, P19-P22) ---------------------
from pulsegrid.functions import cleaning as CL  # noqa: E402
from pulsegrid.operators import search_index as SI  # noqa: E402
from pulsegrid.operators import serving as SE  # noqa: E402
from pulsegrid.sources import blocks as BL  # noqa: E402
from pulsegrid.sources.adapters import BRONZE  # noqa: E402

_WRITTEN: dict = {}


def input_state(spark, sf_dir) -> int:
    """One number for names, sizes and times of the input files (file listing
    only): rewritten data give another one."""
    files = None
    for t in ("customer", "nation", "orders", "lineitem", "events"):
        found = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/{t}.parquet").select("path", "length", "modificationTime")
        files = found if files is None else files.unionByName(found)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return int(files.agg(F.sum(mark)).first()[0] or 0)


def written(spark, sf_dir, name: str, build):
    """A result kept for the state of the input it was built from; an older state
    of the same name is dropped."""
    state = (spark.sparkContext.applicationId, input_state(spark, sf_dir))
    if _WRITTEN.get((sf_dir, name), (None, None))[0] != state:
        _WRITTEN[(sf_dir, name)] = (state, build())
    return _WRITTEN[(sf_dir, name)][1]


def gold_table(spark, sf_dir):
    """The deterministic gold score table with its reasons, written once to the
    shared folder for the serving queries (see ``written``)."""

    def build():
        parts = SC.RATE_PARTS
        scored = score_snapshot_frame(snapshot_table(spark, sf_dir, PA, with_norm=False, with_labels=True), PA, keep=parts)
        return cut_lineage(SC.rate_reason(final_scores(spark, sf_dir, scored=scored, keep=parts)).drop(*parts))

    return written(spark, sf_dir, "gold", build)


def _dir(spark, sf_dir):
    return SE.directory(bronze_master(spark, sf_dir), gold_table(spark, sf_dir))


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def directory_blocks(spark, sf_dir):
    """The directory in blocks by entity, counts kept per tier and channel."""
    return written(spark, sf_dir, "directory_blocks", lambda: BL.write_blocks(
        _dir(spark, sf_dir), _folder(spark, "directory"), "hcp_id", facets=["engagement_level", "next_best_channel"]))


def directory_index(spark, sf_dir):
    """The posting lists of the directory."""
    return written(spark, sf_dir, "directory_index", lambda: SI.write_index(directory_blocks(spark, sf_dir), _folder(spark, "grams")))


DIR_SQL = (
    "SELECT p.hcp_id, p.first_name, p.last_name, p.specialty, p.sub_specialty, p.organization_type, p.city, p.state, "
    "p.country, p.hcp_status, p.preferred_language, g.historical_engagement_score, g.predicted_engagement_score, "
    "g.hybrid_engagement_score, g.engagement_level, g.email_probability, g.website_probability, g.webinar_probability, "
    "g.sales_rep_probability, g.next_best_channel, r.recommended_reason "
    "FROM bronze_master p LEFT JOIN gold g ON p.hcp_id = g.hcp_id LEFT JOIN reasons r ON p.hcp_id = r.hcp_id"
)
DIR = {"reasons": O.REASONS_SQL, "dir": DIR_SQL}
_BUCKET_SQL = ("CASE WHEN hybrid_engagement_score <= 20 THEN '0-20' WHEN hybrid_engagement_score <= 40 THEN '21-40' "
               "WHEN hybrid_engagement_score <= 60 THEN '41-60' WHEN hybrid_engagement_score <= 80 THEN '61-80' ELSE '81-100' END")
_ALLOC_CTE = {
    "av": "SELECT COALESCE(AVG(email_probability), 0.0) AS e, COALESCE(AVG(website_probability), 0.0) AS w, "
    "COALESCE(AVG(webinar_probability), 0.0) AS b, COALESCE(AVG(sales_rep_probability), 0.0) AS r FROM gold",
    "alloc": " UNION ALL ".join(
        f"SELECT '{n}' AS channel, {c} AS avg_probability, CASE WHEN e + w + b + r > 0 THEN {c} / (e + w + b + r) ELSE 0.0 END AS allocation FROM av"
        for n, c in (("Email", "e"), ("Website", "w"), ("Webinar", "b"), ("Sales_Rep", "r"))
    ),
}

register(
    "dash_tiers",
    O.serving_sql("SELECT CAST(COUNT(hcp_id) AS BIGINT) AS total_hcps, "
                  + ", ".join(f"CAST(COUNT(hcp_id) FILTER (WHERE engagement_level = '{t}') AS BIGINT) AS {t.lower()}_engagement"
                              for t in ("High", "Medium", "Low")) + " FROM gold"),
)(lambda spark, sf_dir: SE.dash_tiers(gold_table(spark, sf_dir)))
register("dash_avg", O.serving_sql(f"SELECT {O.rnd('COALESCE(AVG(hybrid_engagement_score), 0.0)', 8)} AS average_engagement_score FROM gold"))(
    lambda spark, sf_dir: SE.dash_avg(gold_table(spark, sf_dir)).select(F.round("average_engagement_score", 8).alias("average_engagement_score"))
)
register(
    "dash_histogram",
    O.serving_sql(" UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS pos, '{b}' AS bucket, CAST(COUNT(hcp_id) FILTER (WHERE {_BUCKET_SQL} = '{b}') AS BIGINT) AS count FROM gold"
        for i, (b, _) in enumerate(SE.BUCKETS))),
)(lambda spark, sf_dir: SE.dash_histogram(gold_table(spark, sf_dir)))
register(
    "dash_allocation",
    O.serving_sql(f"SELECT channel, {O.rnd('avg_probability', 10)} AS avg_probability, {O.rnd('allocation', 10)} AS allocation, "
                  f"{O.rnd('allocation * 100', 1)} AS effectiveness FROM alloc", _ALLOC_CTE),
)(lambda spark, sf_dir: SE.dash_allocation(gold_table(spark, sf_dir)).select(
    "channel", F.round("avg_probability", 10).alias("avg_probability"), F.round("allocation", 10).alias("allocation"), "effectiveness"))
register(
    "dash_allocation_vs_baseline",
    O.serving_sql(f"SELECT channel, 25.0::DOUBLE AS baseline_pct, {O.rnd('allocation * 100', 8)} AS model_pct FROM alloc", _ALLOC_CTE),
)(lambda spark, sf_dir: SE.dash_allocation_vs_baseline(gold_table(spark, sf_dir)).select(
    "channel", "baseline_pct", F.round("model_pct", 8).alias("model_pct")))
register("dash_last_updated", O.ctes("bronze_master") + "SELECT MAX(updated_at) AS last_updated FROM bronze_master")(
    lambda spark, sf_dir: SE.dash_last_updated(bronze_master(spark, sf_dir))
)
register(
    "dash_high_pct",
    O.serving_sql("SELECT CAST(CASE WHEN COUNT(hcp_id) > 0 THEN ROUND(CAST(COUNT(hcp_id) FILTER (WHERE engagement_level = 'High') AS DOUBLE)"
                  " / COUNT(hcp_id) * 100) ELSE 0 END AS BIGINT) AS high_pct FROM gold"),
)(lambda spark, sf_dir: SE.dash_high_pct(gold_table(spark, sf_dir)))
register("dashboard")(lambda spark, sf_dir: SE.dashboard(gold_table(spark, sf_dir), bronze_master(spark, sf_dir)))

register(
    "search_directory",
    O.serving_sql("SELECT * FROM dir WHERE first_name ILIKE '%furn%' OR last_name ILIKE '%furn%' OR hcp_id ILIKE '%furn%' "
                  "OR specialty ILIKE '%furn%' ORDER BY hcp_id LIMIT 50 OFFSET 0", DIR),
)(lambda spark, sf_dir: SI.search(directory_index(spark, sf_dir), "furn", 0, 50))
register(
    "search_directory_page2",
    O.serving_sql("SELECT * FROM dir ORDER BY hcp_id LIMIT 50 OFFSET 50", DIR),
)(lambda spark, sf_dir: BL.page_of(directory_blocks(spark, sf_dir), 50, 50))
register(
    "suggest",
    O.serving_sql("SELECT hcp_id, first_name, last_name, specialty FROM dir WHERE first_name ILIKE '%bu%' OR last_name ILIKE '%bu%' "
                  "OR hcp_id ILIKE '%bu%' OR specialty ILIKE '%bu%' ORDER BY hcp_id LIMIT 8", DIR),
)(lambda spark, sf_dir: SI.suggest(directory_index(spark, sf_dir), "bu"))
register("lookup_entity", O.serving_sql("SELECT * FROM dir WHERE hcp_id = '42'", DIR))(
    lambda spark, sf_dir: BL.lookup(directory_blocks(spark, sf_dir), "42")
)
_SHOWN = ("replace(replace(lower(COALESCE(next_best_channel, '')), '_', ''), ' ', '') = 'salesrep' AND lower(COALESCE(engagement_level, '')) = 'high'")
register("filter_directory_page", O.serving_sql(f"SELECT * FROM dir WHERE {_SHOWN} ORDER BY hcp_id LIMIT 20 OFFSET 20", DIR))(
    lambda spark, sf_dir: BL.page_of(directory_blocks(spark, sf_dir), 20, 20, SE._filter_cond("Sales_Rep", "high"))
)
register(
    "filter_directory_meta",
    O.serving_sql(f"SELECT 2 AS page, 20 AS \"limit\", CAST(COUNT(*) AS BIGINT) AS total_records, CAST((COUNT(*) + 19) // 20 AS BIGINT) AS total_pages, "
                  f"2 < (COUNT(*) + 19) // 20 AS has_next, TRUE AS has_previous FROM dir WHERE {_SHOWN}", DIR),
)(lambda spark, sf_dir: BL.page_meta(directory_blocks(spark, sf_dir), 2, 20, SE._filter_cond("Sales_Rep", "high")))
register(
    "filter_directory",
    O.serving_sql("SELECT * FROM dir WHERE replace(replace(lower(COALESCE(next_best_channel, '')), '_', ''), ' ', '') = 'salesrep' "
                  "AND lower(COALESCE(engagement_level, '')) = 'high'", DIR),
)(lambda spark, sf_dir: SE.filter_directory(_dir(spark, sf_dir), "Sales_Rep", "high"))
register(
    "filter_counts",
    O.serving_sql("SELECT CAST(COUNT(*) FILTER (WHERE replace(replace(lower(COALESCE(next_best_channel, '')), '_', ''), ' ', '') = 'salesrep' "
                  "AND lower(COALESCE(engagement_level, '')) = 'high') AS BIGINT) AS shown, CAST(COUNT(*) AS BIGINT) AS total FROM dir",
                  DIR),
)(lambda spark, sf_dir: SE.filter_counts(_dir(spark, sf_dir), "Sales_Rep", "high"))
register(
    "directory_extract",
    O.serving_sql("SELECT hcp_id, trim(COALESCE(first_name, '') || ' ' || COALESCE(last_name, '')) AS name, "
                  "CASE WHEN hybrid_engagement_score IS NOT NULL AND hybrid_engagement_score <> 0 "
                  "THEN CAST(CAST(ROUND(hybrid_engagement_score) AS BIGINT) AS VARCHAR) || '%' ELSE 'N/A' END AS engagement_score, "
                  "COALESCE(next_best_channel, 'N/A') AS next_best_channel, "
                  "concat_ws(', ', NULLIF(trim(city), ''), NULLIF(trim(state), ''), NULLIF(trim(country), '')) AS location FROM dir", DIR),
)(lambda spark, sf_dir: SE.directory_extract(_dir(spark, sf_dir)))
def gold_blocks(spark, sf_dir):
    """The gold table in blocks by entity: its head reads the first block."""
    return written(spark, sf_dir, "gold_blocks", lambda: BL.write_blocks(gold_table(spark, sf_dir), _folder(spark, "gold"), "hcp_id"))


register(
    "predictions_head",
    O.serving_sql("SELECT g.*, r.recommended_reason FROM gold g JOIN reasons r ON g.hcp_id = r.hcp_id ORDER BY g.hcp_id LIMIT 100", {"reasons": O.REASONS_SQL}),
)(lambda spark, sf_dir: BL.page_of(gold_blocks(spark, sf_dir), 0, 100))

DISPLAY = [
    ("hcp_id", "HCP_ID"), ("historical_engagement_score", "Historical_Engagement_Score"),
    ("predicted_engagement_score", "Predicted_Engagement_Score"), ("hybrid_engagement_score", "Hybrid_Engagement_Score"),
    ("engagement_level", "Engagement_Level"), ("email_probability", "Email_Probability"),
    ("website_probability", "Website_Probability"), ("webinar_probability", "Webinar_Probability"),
    ("sales_rep_probability", "Sales_Rep_Probability"), ("next_best_channel", "Next_Best_Channel"),
]
GOLD_DISPLAY = [*DISPLAY, ("recommended_reason", "Recommended_Reason")]


def final_output(spark, sf_dir):
    """M29 layout (display column names) of the gold scores."""
    return gold_table(spark, sf_dir).select(*[F.col(a).alias(b) for a, b in GOLD_DISPLAY])


_GOLD_REASONS = "gold JOIN (SELECT hcp_id AS _id, recommended_reason FROM reasons) ON hcp_id = _id"
register("final_output", O.serving_sql("SELECT " + ", ".join(f"{a} AS {b}" for a, b in GOLD_DISPLAY) + f" FROM {_GOLD_REASONS}", {"reasons": O.REASONS_SQL}))(final_output)
register("export_lowercase", O.serving_sql("SELECT " + ", ".join(f"{a} AS {b.lower()}" for a, b in GOLD_DISPLAY) + f" FROM {_GOLD_REASONS}", {"reasons": O.REASONS_SQL}))(
    lambda spark, sf_dir: SE.export_lowercase(final_output(spark, sf_dir))
)


def email_blocks(spark, sf_dir):
    """The silver email log in blocks by event id."""
    return written(spark, sf_dir, "email_blocks", lambda: BL.write_blocks(SV.silver(spark, sf_dir, "email"), _folder(spark, "email"), "email_event_id"))


register("paginate", O.ctes("silver_email") + "SELECT * FROM silver_email ORDER BY email_event_id LIMIT 1000 OFFSET 2000")(
    lambda spark, sf_dir: BL.page_of(email_blocks(spark, sf_dir), 2000, 1000)
)
register(
    "paginate_meta",
    O.ctes("silver_email") + "SELECT 3 AS page, 1000 AS \"limit\", CAST(COUNT(*) AS BIGINT) AS total_records, "
    "CAST((COUNT(*) + 999) // 1000 AS BIGINT) AS total_pages, 3 < (COUNT(*) + 999) // 1000 AS has_next, TRUE AS has_previous FROM silver_email",
)(lambda spark, sf_dir: BL.page_meta(email_blocks(spark, sf_dir), 3, 1000))
register(
    "dataset_counts",
    O.ctes(*[f"bronze_{c}" for c in CHANNELS]) + " UNION ALL ".join(
        f"SELECT '{c}_activity' AS dataset, CAST(COUNT(*) AS BIGINT) AS rows FROM bronze_{c}" for c in CHANNELS),
)(lambda spark, sf_dir: SE.dataset_counts({f"{c}_activity": BRONZE[c](spark, sf_dir) for c in CHANNELS}))
register(
    "normalize_id",
    O.ctes("bronze_master") + "SELECT hcp_id, CASE WHEN d <> '' THEN 'HCP' || CASE WHEN length(d) >= 4 THEN d ELSE lpad(d, 4, '0') END "
    "ELSE v END AS normalized_id FROM (SELECT hcp_id, upper(trim(hcp_id)) AS v, regexp_extract(upper(trim(hcp_id)), '^(?:HCP)?0*(\\d+)$', 1) AS d FROM bronze_master)",
)(lambda spark, sf_dir: bronze_master(spark, sf_dir).select("hcp_id", CL.normalize_id("hcp_id").alias("normalized_id")))
register(
    "pct_rescale",
    O.serving_sql("SELECT hcp_id, CASE WHEN email_probability > 0 AND email_probability <= 1 THEN email_probability * 100 "
                  "ELSE email_probability END AS email_pct FROM gold"),
)(lambda spark, sf_dir: gold_table(spark, sf_dir).select("hcp_id", CL.pct_rescale("email_probability").alias("email_pct")))


# --- model path (M2-M8, M10-M14, M25-M29; rows-only checks) --------------------------
from pulsegrid.functions import reasons as RS  # noqa: E402
from pulsegrid.operators import models as ML  # noqa: E402

N_TREES = 100


def train_models(frames, p, n_trees: int = N_TREES) -> dict:
    """History score and the four boosted models, fitted on the train rows of a
    written snapshot table, and applied to all rows (uncalibrated).

    The numeric features and the history score are expressions over the written
    rows: only the scored rows are written."""
    cols = ML.feature_columns(frames)
    frames = ML.coerce_features(frames, cols)
    frames = ML.history_score(frames.where(F.col("split") == "train"), frames, cols)
    models = ML.fit_channel_models(frames, cols, p, SC.TARGETS, n_trees)
    return {"cols": cols, "models": models, "scored": cut_lineage(ML.raw_probabilities(models, frames, cols))}


def calibrate_models(r: dict, p) -> dict:
    """Platt calibration on the validation rows and the predicted score, as
    expressions over the written scores."""
    platt = ML.fit_channel_platt(r["scored"], SC.TARGETS)
    scored = r["scored"].select("*", *[ML.calibrated(f"_raw_{t}", *platt[t]).alias(pcol) for pcol, t in zip(SC.PROBS, SC.TARGETS)])
    scored = scored.withColumn("pred_score", SC.predicted_score(p.channel_weights, clip=p.clip_scores))
    return {**r, "platt": platt, "scored": scored}


def target_of_channel(p) -> dict[str, str]:
    return dict(zip(SC.channel_labels(p.rep_label), SC.TARGETS))


def explain_gold(gold, r: dict, p):
    """Gold rows with ``recommended_reason``: only the model of each row's next
    best channel is explained, and only feature names leave the tasks."""
    labels = SC.channel_labels(p.rep_label)
    probs = ("email_probability", "website_probability", "webinar_probability", "sales_rep_probability")
    tmap = F.create_map(*[x for k, v in target_of_channel(p).items() for x in (F.lit(k), F.lit(v))])
    prob = F.coalesce(*[F.when(F.col("next_best_channel") == k, F.col(v)) for k, v in zip(labels, probs)])
    chosen = gold.select("hcp_id", F.element_at(tmap, F.col("next_best_channel")).alias("target"))
    current = r["scored"].where(F.col("split") == "current").select("hcp_id", *r["cols"]).join(chosen, "hcp_id")
    names = ML.chosen_drivers(current, r["cols"], r["models"])
    channel, level, pct = F.col("next_best_channel"), F.col("engagement_level"), F.col("_prob")
    if p.name == "A":
        top = F.when(F.size("positive") > 0, F.slice("positive", 1, 2)).otherwise(F.array("largest"))
        reason = RS.reason_a(channel, pct, level, F.transform(top, lambda c: RS.phrase_a(c)))
    else:
        reason = RS.reason_b(channel, pct, RS.phrases_b(F.col("positive")))
    joined = gold.withColumn("_prob", prob).join(names, "hcp_id", "left")
    return joined.select(*gold.columns, reason.alias("recommended_reason"))


def model_run(spark, sf_dir, p=PA, n_trees: int = N_TREES) -> dict:
    """The model path over the snapshots of ``sf_dir``, kept for the state of its
    input (see ``written``)."""

    def build():
        snap = cut_lineage(snapshot_table(spark, sf_dir, p, with_norm=True, with_labels=True))
        r = calibrate_models(train_models(snap, p, n_trees), p)
        gold = cut_lineage(explain_gold(cut_lineage(final_scores(spark, sf_dir, p, scored=r["scored"])), r, p))
        return {**r, "gold": gold}

    return written(spark, sf_dir, f"models_{p.name}_{n_trees}", build)


def model_attributions(spark, sf_dir):
    """Full attribution vectors of all four models for the current snapshot."""
    r = model_run(spark, sf_dir)
    return written(spark, sf_dir, "attributions", lambda: cut_lineage(ML.attributions(r["scored"].where(F.col("split") == "current"), r["cols"], r["models"])))


def _q_pca(spark, sf_dir):
    r = model_run(spark, sf_dir)
    return r["scored"].select("hcp_id", "snapshot_date", "split", F.round("hist_score", 6).alias("hist_score"))


def _q_gbt(spark, sf_dir):
    r = model_run(spark, sf_dir)
    return r["scored"].where(F.col("split") == "current").select("hcp_id", *[F.col(f"_raw_{t}").alias(f"raw_{t}") for t in SC.TARGETS])


def _q_platt(spark, sf_dir):
    r = model_run(spark, sf_dir)
    return spark.createDataFrame([(t, a, b) for t, (a, b) in r["platt"].items()], "target string, slope double, intercept double")


def _q_model_metrics(spark, sf_dir):
    r = model_run(spark, sf_dir)
    return metrics_table(long_probs(r["scored"]).where(F.col("split") == "test"), 0.5)


def _q_attr(spark, sf_dir):
    return model_attributions(spark, sf_dir)


def _q_importance(spark, sf_dir):
    r = model_run(spark, sf_dir)
    return ML.feature_importance(model_attributions(spark, sf_dir).where(F.col("target") == "veeva_target"), r["cols"])


MODEL_DISPLAY = [*DISPLAY, ("recommended_reason", "Recommended_Reason")]


def model_final_output(spark, sf_dir, p=PA):
    """The gold table of the model path in the display layout, 11 columns."""
    rep = {"A": "Sales_Rep_Probability", "B": "Veeva_Probability"}[p.name]
    names = [(a, rep if a == "sales_rep_probability" else b) for a, b in MODEL_DISPLAY]
    return model_run(spark, sf_dir, p)["gold"].select(*[F.col(a).alias(b) for a, b in names])


def _q_top_drivers(spark, sf_dir):
    r = model_run(spark, sf_dir)
    return model_attributions(spark, sf_dir).select("hcp_id", "target", SC.top_drivers("attr", r["cols"]).alias("drivers"))


register("pca_score")(_q_pca)
register("gbt_probability")(_q_gbt)
register("platt")(_q_platt)
register("model_metrics")(_q_model_metrics)
register("attributions")(_q_attr)
register("feature_importance")(_q_importance)
register("top_drivers")(_q_top_drivers)
register("final_output_model")(lambda spark, sf_dir: model_final_output(spark, sf_dir))


# --- profile B on the model path ------------------------------------------------------
def _q_model_metrics_b(spark, sf_dir):
    return metrics_table_b(long_probs(model_run(spark, sf_dir, PROFILE_B)["scored"]))


register("model_metrics_b")(_q_model_metrics_b)
register("final_output_model_b")(lambda spark, sf_dir: model_final_output(spark, sf_dir, PROFILE_B))


# --- remaining section-2 keys ----------------------------------------------------------
def _q_dedup_latest(spark, sf_dir):
    """W1 alone: latest row per web event key (before the quality gate)."""
    spec = SPECS["web"]
    d = SV.latest(BRONZE["web"](spark, sf_dir), spec)
    return d.select("web_event_id", "hcp_id", "event_type", "event_timestamp", "page_url")


register(
    "dedup_latest",
    O.ctes("bronze_web")
    + "SELECT web_event_id, hcp_id, event_type, event_timestamp, page_url FROM ("
    "SELECT CAST(web_event_id AS VARCHAR) AS web_event_id, TRIM(CAST(hcp_id AS VARCHAR)) AS hcp_id, "
    "CASE WHEN LOWER(TRIM(event_type)) IN ('page_view', 'content_view', 'download', 'video_start', 'video_complete') "
    "THEN LOWER(TRIM(event_type)) END AS event_type, event_timestamp, NULLIF(TRIM(page_url), '') AS page_url, "
    "ROW_NUMBER() OVER (PARTITION BY CAST(web_event_id AS VARCHAR) ORDER BY event_timestamp DESC NULLS LAST, page_url NULLS FIRST, "
    "content_id NULLS FIRST, session_duration_seconds NULLS FIRST) AS rn FROM bronze_web) WHERE rn = 1",
)(_q_dedup_latest)

register("next_best_channel", O.serving_sql("SELECT hcp_id, next_best_channel FROM gold"))(
    lambda spark, sf_dir: gold_table(spark, sf_dir).select("hcp_id", "next_best_channel")
)
register("cross_channel_b", O.snapshot_sql(PROFILE_B, with_norm=False, with_labels=False))(
    lambda spark, sf_dir: snapshot_table(spark, sf_dir, PROFILE_B, with_norm=False, with_labels=False)
)
register(
    "chrono_split",
    O.ctes("bronze_master").rstrip("\n") + f",\nsnap_dates AS ({O._dates_cte(PA)})\n"
    "SELECT d.split, d.snapshot_date, CAST(COUNT(*) AS BIGINT) AS rows FROM (SELECT DISTINCT hcp_id FROM bronze_master) m "
    "CROSS JOIN snap_dates d GROUP BY d.split, d.snapshot_date",
)(lambda spark, sf_dir: SN.spine(master_ids(spark, sf_dir), PA).groupBy("split", "snapshot_date").agg(F.count(F.lit(1)).alias("rows")))


def _q_class_weight(spark, sf_dir):
    lab = _labels_df(spark, sf_dir, PA).where(F.col("split") == "train")
    arr = F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("y")) for t in SC.TARGETS])
    x = lab.select(F.explode(arr).alias("x")).select("x.target", "x.y")
    g = x.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    return g.select("target", "n", F.col("pos").cast("bigint").alias("pos"),
                    ((F.col("n") - F.col("pos")) / F.greatest(F.col("pos"), F.lit(1))).cast("double").alias("class_weight"))


register(
    "class_weight",
    _labels_sql(PA).replace(
        "SELECT hcp_id, snapshot_date, split, email_target, web_target, webinar_target, veeva_target FROM snap_final",
        " UNION ALL ".join(
            f"SELECT '{t}' AS target, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM({t}) AS BIGINT) AS pos, "
            f"CAST(COUNT(*) - SUM({t}) AS DOUBLE) / GREATEST(SUM({t}), 1) AS class_weight FROM snap_final WHERE split = 'train'"
            for t in SC.TARGETS),
    ),
)(_q_class_weight)


def _q_future_intensity(spark, sf_dir):
    lab = _labels_df(spark, sf_dir, PA)
    return lab.select("hcp_id", "snapshot_date", SC.future_intensity().alias("future_intensity"),
                      SC.future_intensity(mean=True).alias("future_mean"))


register(
    "future_intensity",
    _labels_sql(PA).replace(
        "SELECT hcp_id, snapshot_date, split, email_target, web_target, webinar_target, veeva_target FROM snap_final",
        "SELECT hcp_id, snapshot_date, email_target + web_target + webinar_target + veeva_target AS future_intensity, "
        "(email_target + web_target + webinar_target + veeva_target) / 4.0 AS future_mean FROM snap_final",
    ),
)(_q_future_intensity)


def _q_standardize(spark, sf_dir):
    """M2: mean and population deviation (1 if 0) of every feature over the train rows."""
    snap = snapshot_table(spark, sf_dir, PA, with_norm=True, with_labels=False)
    cols = ML.feature_columns(snap)
    means, stds = ML.fit_standardizer(ML.coerce_features(snap, cols).where(F.col("split") == "train"), cols)
    rows = spark.createDataFrame(list(zip(cols, means, stds)), "feature string, mean double, std double")
    return rows.select("feature", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"))


def _standardize_sql() -> str:
    full = O.snapshot_sql(PA, with_norm=True, with_labels=False)
    head, _, last = full.rpartition("\nSELECT * FROM ")
    return (
        f"{head},\ntrain_values AS (SELECT COALESCE(CAST(COLUMNS(lambda c: c NOT IN ('hcp_id', 'snapshot_date', 'split')) AS DOUBLE), 0.0) FROM {last} WHERE split = 'train'),\n"
        "long_values AS (UNPIVOT train_values ON COLUMNS(*) INTO NAME feature VALUE v)\n"
        f"SELECT feature, {O.rnd('AVG(v)', 5)} AS mean, CASE WHEN STDDEV_POP(v) > 0 THEN {O.rnd('STDDEV_POP(v)', 5)} ELSE 1.0 END AS std FROM long_values GROUP BY feature"
    )


def _train_features(spark, sf_dir):
    """Train rows of the feature matrix and its columns: read once, by ``comoments``,
    and so not written in between."""
    snap = snapshot_table(spark, sf_dir, PA, with_norm=True, with_labels=False)
    cols = ML.feature_columns(snap)
    return ML.coerce_features(snap, cols).where(F.col("split") == "train").select(*cols), cols


def _q_feature_correlation(spark, sf_dir):
    """M3: correlations of all feature pairs over the train rows, from one pass."""
    train, cols = _train_features(spark, sf_dir)
    r = CM.comoments(train, cols).correlations()
    rows = [(a, b, float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols) if a <= b]
    return spark.createDataFrame(rows, "a string, b string, r double").select("a", "b", (F.round(F.col("r") + 0.0, 6) + F.lit(0.0)).alias("r"))


def _q_explained_variance(spark, sf_dir):
    """M3: the share of variance that the first component explains."""
    train, cols = _train_features(spark, sf_dir)
    f = ML.fit_history(train, cols, cols, "total_touchpoints")
    return spark.createDataFrame([(f["rows"], f["varying"], f["explained"])], "n long, varying long, ratio double").select("n", "varying", F.round("ratio", 5).alias("ratio"))


def _correlation_ctes() -> str:
    full = O.snapshot_sql(PA, with_norm=True, with_labels=False)
    head, _, last = full.rpartition("\nSELECT * FROM ")
    return (
        f"WITH RECURSIVE {head.removeprefix('WITH ')},\n"
        f"train_values AS MATERIALIZED (SELECT row_number() OVER () AS rid, COALESCE(CAST(COLUMNS(lambda c: c NOT IN ('hcp_id', 'snapshot_date', 'split')) AS DOUBLE), 0.0) FROM {last} WHERE split = 'train'),\n"
        "long_values AS MATERIALIZED (UNPIVOT train_values ON COLUMNS(* EXCLUDE (rid)) INTO NAME feature VALUE v),\n"
        "spread AS (SELECT feature, AVG(v) AS m, CASE WHEN MIN(v) = MAX(v) THEN NULL ELSE STDDEV_POP(v) END AS s FROM long_values GROUP BY feature),\n"
        "unit AS MATERIALIZED (SELECT rid, feature, COALESCE((v - m) / s, 0.0) AS z, s FROM long_values JOIN spread USING (feature)),\n"
        "pairs AS MATERIALIZED (SELECT x.feature AS a, y.feature AS b, AVG(x.z * y.z) AS r FROM unit x JOIN unit y ON x.rid = y.rid GROUP BY x.feature, y.feature)"
    )


def _correlation_sql() -> str:
    return _correlation_ctes() + f"\nSELECT a, b, {O.rnd('r', 6)} + 0.0 AS r FROM pairs WHERE a <= b"


def _explained_sql() -> str:
    """Power iteration on the correlations."""
    return _correlation_ctes() + (
        ",\nsteps AS (SELECT 0 AS k, feature AS a, CAST(1.0 AS DOUBLE) AS x, CAST(0.0 AS DOUBLE) AS size FROM spread UNION ALL\n"
        "SELECT k, a, x / size, size FROM (SELECT k, a, x, SQRT(SUM(x * x) OVER ()) AS size FROM ("
        "SELECT s.k + 1 AS k, p.a, SUM(p.r * s.x) AS x FROM pairs p JOIN steps s ON s.a = p.b WHERE s.k < 200 GROUP BY s.k, p.a)))\n"
        "SELECT (SELECT COUNT(*) FROM train_values) AS n, (SELECT COUNT(s) FROM spread) AS varying, "
        f"{O.rnd('(SELECT MAX(size) FROM steps WHERE k = 200) / (SELECT COUNT(s) FROM spread)', 5)} AS ratio"
    )


def _q_dashboard_flat(spark, sf_dir):
    """The dashboard object with its nested fields spread into columns."""
    d = SE.dashboard(gold_table(spark, sf_dir), bronze_master(spark, sf_dir))
    buckets = [F.col("score_distribution")[i]["count"].alias(f"bucket_{i}") for i in range(len(SE.BUCKETS))]
    shares = [F.round(F.col(f"channel_allocation.{n}"), 8).alias(f"allocation_{n.lower()}") for n in ("Email", "Website", "Webinar", "Sales_Rep")]
    return d.select("total_hcps", "high_engagement", "medium_engagement", "low_engagement", F.round("average_engagement_score", 8).alias("average_engagement_score"), *buckets, *shares, "last_updated")


register(
    "dashboard_flat",
    O.serving_sql(
        "SELECT CAST(COUNT(hcp_id) AS BIGINT) AS total_hcps, "
        + ", ".join(f"CAST(COUNT(hcp_id) FILTER (WHERE engagement_level = '{t}') AS BIGINT) AS {t.lower()}_engagement" for t in ("High", "Medium", "Low"))
        + f", {O.rnd('COALESCE(AVG(hybrid_engagement_score), 0.0)', 8)} AS average_engagement_score, "
        + ", ".join(f"CAST(COUNT(hcp_id) FILTER (WHERE {_BUCKET_SQL} = '{b}') AS BIGINT) AS bucket_{i}" for i, (b, _) in enumerate(SE.BUCKETS))
        + ", " + ", ".join(f"(SELECT {O.rnd('allocation', 8)} FROM alloc WHERE channel = '{n}') AS allocation_{n.lower()}" for n in ("Email", "Website", "Webinar", "Sales_Rep"))
        + ", (SELECT MAX(updated_at) FROM bronze_master) AS last_updated FROM gold",
        _ALLOC_CTE,
    ),
)(_q_dashboard_flat)


def _q_model_invariants(spark, sf_dir):
    """What must hold for any fitted models: one explained row per entity,
    probabilities in [0, 1], scores in [0, 100], attributions and base that add up
    to the probability which the fitted ensemble itself gives."""
    r = model_run(spark, sf_dir)
    probs = ["email_probability", "website_probability", "webinar_probability", "sales_rep_probability"]
    g, s, a = r["gold"], r["scored"], model_attributions(spark, sf_dir)
    raw = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"_raw_{t}").alias("p")) for t in SC.TARGETS])
    told = s.where(F.col("split") == "current").select("hcp_id", F.inline(raw))
    a = a.join(told, ["hcp_id", "target"], "full")  # a missing side counts as bad
    total = F.aggregate("attr", F.lit(0.0), lambda x, y: x + y) + F.col("base")
    off = F.abs(F.lit(1.0) / (F.lit(1.0) + F.exp(-total)) - F.col("p")) > 1e-9
    parts = g.select(
        F.lit(1).alias("rows"), (~F.expr(" AND ".join(f"{p} BETWEEN 0 AND 1" for p in probs))).cast("int").alias("bad_probability"),
        F.coalesce(F.length("recommended_reason") == 0, F.lit(True)).cast("int").alias("no_reason"),
    ).unionByName(
        s.select((~F.col("hist_score").between(0, 100)).cast("int").alias("bad_history")), allowMissingColumns=True
    ).unionByName(a.select(F.coalesce(off, F.lit(True)).cast("int").alias("bad_sum")), allowMissingColumns=True)
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("rows", "bad_probability", "no_reason", "bad_history", "bad_sum")])


register(
    "model_invariants",
    O.ctes("bronze_master") + "SELECT CAST(COUNT(DISTINCT hcp_id) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS bad_probability, "
    "CAST(0 AS BIGINT) AS no_reason, CAST(0 AS BIGINT) AS bad_history, CAST(0 AS BIGINT) AS bad_sum FROM bronze_master",
)(_q_model_invariants)


def _q_driver_phrases(spark, sf_dir):
    r = model_run(spark, sf_dir)
    drivers = SC.top_drivers("attr", r["cols"])
    return model_attributions(spark, sf_dir).select("hcp_id", "target", F.transform(drivers, lambda c: RS.phrase_a(c)).alias("phrases"))


register(
    "matrix_sanity",
    O.snapshot_sql(PA, with_norm=True, with_labels=False).rpartition("\nSELECT * FROM ")[0]
    + "\nSELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(88 AS INTEGER) AS features, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS non_finite FROM "
    + O.snapshot_sql(PA, with_norm=True, with_labels=False).rpartition("\nSELECT * FROM ")[2],
)(_q_matrix_sanity)
register("standardize", _standardize_sql())(_q_standardize)
register("feature_correlation", _correlation_sql())(_q_feature_correlation)
register("explained_variance", _explained_sql())(_q_explained_variance)
register("driver_phrases")(_q_driver_phrases)
