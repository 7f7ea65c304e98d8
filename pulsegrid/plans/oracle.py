"""DuckDB twins of the Spark queries (the correctness oracle).

Written directly in SQL, independently of the DataFrame code, over the same
parquet views the driver registers. The bronze CTEs mirror
``pulsegrid.sources.adapters`` row for row; silver and feature SQL follows the
reference notebooks' statement shapes. Types are pinned with casts so that
column types agree with Spark (counts BIGINT, day differences INTEGER, ratios
DOUBLE, timestamps naive TIMESTAMP).
"""

from __future__ import annotations

import datetime as dt


def _pick(idx: str, words: list[str]) -> str:
    lst = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"([{lst}])[CAST({idx} AS BIGINT) + 1]"


def _dirty(text: str, rid: str) -> str:
    return (
        f"CASE WHEN {rid} % 7 = 0 THEN '' WHEN {rid} % 7 = 1 THEN ' ' || upper({text}) || ' ' ELSE {text} END"
    )


def _shift(ts: str, secs: str) -> str:
    return (
        f"(CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST({ts} AS DATE)) % 30 AS INTEGER)"
        f" AS TIMESTAMP) + to_seconds(CAST(({secs}) % 86400 AS BIGINT)))"
    )


def _padded(uid: str, rid: str) -> str:
    return f"CASE WHEN {rid} % 5 = 0 THEN ' ' || CAST({uid} AS VARCHAR) || ' ' ELSE CAST({uid} AS VARCHAR) END"


_DEV = ["Desktop", " mobile ", "TABLET", "watch"]

BRONZE_SQL = {
    "master": f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS hcp_id,
       split_part(c.c_name, '#', 1) AS first_name,
       split_part(c.c_name, '#', 2) AS last_name,
       c.c_mktsegment AS specialty,
       CAST(NULL AS VARCHAR) AS sub_specialty,
       'clinic' AS organization_type,
       CAST(NULL AS VARCHAR) AS city,
       n.n_name AS state,
       'N/A' AS country,
       CASE WHEN c.c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS hcp_status,
       'en' AS preferred_language,
       CAST(DATE '2024-01-01' + CAST(c.c_custkey % 30 AS INTEGER) AS TIMESTAMP) AS updated_at
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "email": f"""
SELECT event_id AS email_event_id,
       {_padded('user_id', 'event_id')} AS hcp_id,
       'C' || CAST(kn % 10 AS VARCHAR) AS campaign_id,
       'D' || CAST(kn % 4 AS VARCHAR) AS drug_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE k END AS email_id,
       {_dirty("CASE event_type WHEN 'view' THEN 'open' WHEN 'click' THEN 'click' WHEN 'error' THEN 'bounced' WHEN 'signup' THEN 'delivered' ELSE event_type END", 'event_id')} AS event_type,
       ts AS event_timestamp,
       CASE WHEN event_id % 6 = 0 THEN '  ' ELSE 'Subject ' || k END AS email_subject,
       CASE WHEN event_id % 4 = 0 THEN '' ELSE 'https://example.org/e/' || k END AS url,
       {_pick('event_id % 4', _DEV)} AS device_type,
       CASE event_type WHEN 'error' THEN ' Bounced' WHEN 'purchase' THEN 'failed' WHEN 'signup' THEN 'DELIVERED' ELSE 'pending' END AS delivery_status,
       CASE WHEN event_id % 9 = 0 THEN ' ' ELSE 'events' END AS source_system
FROM (SELECT *, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) AS kn FROM events)""",
    "event": f"""
SELECT event_id AS event_activity_id,
       {_padded('user_id', 'event_id')} AS hcp_id,
       k AS event_id,
       'C' || CAST(kn % 10 AS VARCHAR) AS campaign_id,
       'D' || CAST(kn % 4 AS VARCHAR) AS drug_id,
       CASE WHEN event_id % 6 = 0 THEN '' ELSE 'Event ' || k END AS event_name,
       {_pick('kn % 6', ['webinar', ' Medical Education', 'PRODUCT LAUNCH', 'expert panel', 'Clinical discussion', 'roundtable'])} AS event_type,
       {_dirty("CASE event_type WHEN 'signup' THEN 'registration' WHEN 'purchase' THEN 'attendance' ELSE 'view' END", 'event_id')} AS event_activity_type,
       ts AS activity_timestamp,
       CASE WHEN event_type = 'signup' THEN ' registered ' ELSE '' END AS registration_status,
       CASE WHEN event_type = 'purchase' AND event_id % 10 <> 3 THEN {_pick('event_id % 2', ['attended', ' ATTENDED'])}
            WHEN event_type = 'purchase' THEN 'left early' ELSE 'Not applicable' END AS attendance_status,
       CASE WHEN event_type = 'purchase' THEN value - 5.0 END AS attendance_duration_minutes,
       CAST(kn % 4 AS DOUBLE) - 1.0 AS questions_asked,
       CAST(event_id % 3 AS DOUBLE) AS poll_responses,
       {_pick('event_id % 4', _DEV)} AS device_type,
       'events' AS source_system
FROM (SELECT *, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) AS kn FROM events)""",
    "web": f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS web_event_id,
       CAST(o_custkey AS VARCHAR) AS hcp_id,
       CAST(l_orderkey AS VARCHAR) AS session_id,
       'C' || CAST(l_partkey % 10 AS VARCHAR) AS campaign_id,
       'D' || CAST(l_suppkey % 4 AS VARCHAR) AS drug_id,
       {_dirty("CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'page_view' WHEN 'AO' THEN 'content_view' WHEN 'NF' THEN 'download' WHEN 'NO' THEN 'video_start' WHEN 'RF' THEN 'video_complete' ELSE 'scroll' END", 'l_partkey')} AS event_type,
       {_shift('l_shipdate', 'l_partkey * 7 + l_suppkey * 13')} AS event_timestamp,
       '/product/' || CAST(l_partkey AS VARCHAR) || '?c=' || CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS page_url,
       CASE WHEN l_suppkey % 6 = 0 THEN ' ' ELSE 'CT' || CAST(l_suppkey AS VARCHAR) END AS content_id,
       {_pick('l_linenumber % 4', ['pdf', 'video', 'article', ''])} AS content_type,
       l_quantity * 10.0 - 50.0 AS session_duration_seconds,
       {_pick('l_partkey % 4', ['desktop', 'Mobile ', 'tablet', 'tv'])} AS device_type,
       {_pick('l_suppkey % 5', ['Email', 'organic search', ' DIRECT', 'professional referral', 'social'])} AS traffic_source,
       'orders' AS source_system
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "rep": f"""
SELECT o_orderkey AS veeva_event_id,
       CAST(o_custkey AS VARCHAR) AS hcp_id,
       'I' || CAST(o_orderkey AS VARCHAR) AS interaction_id,
       'C' || CAST(o_orderkey % 10 AS VARCHAR) AS campaign_id,
       'D' || CAST(o_custkey % 4 AS VARCHAR) AS drug_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'in-person visit' WHEN '2-HIGH' THEN ' PHONE CALL '
            WHEN '3-MEDIUM' THEN 'Virtual Meeting' WHEN '4-NOT SPECIFIED' THEN 'email' ELSE '' END AS interaction_type,
       {_shift('o_orderdate', 'o_custkey * 17 + o_orderkey')} AS interaction_timestamp,
       o_totalprice / 1000.0 - 20.0 AS interaction_duration_minutes,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'Cancelled ' ELSE 'NO SHOW' END AS interaction_status,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'detailing' END AS interaction_purpose,
       'topic ' || CAST(o_orderkey % 7 AS VARCHAR) AS discussion_topic,
       {_pick('o_orderkey % 6', ['Yes', 'no', '1', '0', 'TRUE', 'maybe'])} AS follow_up_required,
       CASE WHEN o_orderkey % 4 = 0 THEN 'n/a'
            ELSE CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 + 7 AS INTEGER) AS VARCHAR) END AS follow_up_date,
       'R' || CAST(o_custkey % 50 AS VARCHAR) AS rep_id,
       'T' || CAST(o_custkey % 8 AS VARCHAR) AS territory,
       'field' AS channel,
       'orders' AS source_system
FROM orders""",
}


def _lt(col: str) -> str:
    return f"LOWER(TRIM(CAST({col} AS VARCHAR)))"


def _vocab(col: str, words: list[str]) -> str:
    arms = " ".join(f"WHEN {_lt(col)} = '{w}' THEN '{w}'" for w in words)
    return f"CASE {arms} ELSE NULL END"


def _allow(col: str, words: list[str]) -> str:
    lst = ", ".join(f"'{w}'" for w in words)
    return f"CASE WHEN {_lt(col)} IN ({lst}) THEN {_lt(col)} ELSE NULL END"


def _label(col: str, pairs: list[tuple[str, str]]) -> str:
    arms = " ".join(f"WHEN {_lt(col)} = '{k}' THEN '{v}'" for k, v in pairs)
    return f"CASE {arms} ELSE NULL END"


def _nn(col: str) -> str:
    return f"CASE WHEN TRY_CAST({col} AS DOUBLE) >= 0 THEN TRY_CAST({col} AS DOUBLE) ELSE NULL END"


def _nb(col: str) -> str:
    return f"NULLIF(TRIM({col}), '')"


def _tid(col: str) -> str:
    return f"TRIM(CAST({col} AS VARCHAR))"


SILVER_SQL = {
    "email": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(email_event_id AS VARCHAR) AS email_event_id, {_tid('hcp_id')} AS hcp_id,
         {_tid('campaign_id')} AS campaign_id, {_tid('drug_id')} AS drug_id, {_tid('email_id')} AS email_id,
         {_vocab('event_type', ['delivered', 'open', 'click', 'bounced'])} AS event_type,
         TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
         {_nb('email_subject')} AS email_subject, {_nb('url')} AS url,
         {_allow('device_type', ['desktop', 'mobile', 'tablet'])} AS device_type,
         {_allow('delivery_status', ['delivered', 'bounced', 'failed'])} AS delivery_status,
         {_nb('source_system')} AS source_system,
         ROW_NUMBER() OVER (PARTITION BY CAST(email_event_id AS VARCHAR) ORDER BY event_timestamp DESC NULLS LAST) AS rn
  FROM bronze_email)
WHERE rn = 1 AND hcp_id IS NOT NULL AND event_type IS NOT NULL AND event_timestamp IS NOT NULL""",
    "web": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(web_event_id AS VARCHAR) AS web_event_id, {_tid('hcp_id')} AS hcp_id, {_tid('session_id')} AS session_id,
         {_tid('campaign_id')} AS campaign_id, {_tid('drug_id')} AS drug_id,
         {_vocab('event_type', ['page_view', 'content_view', 'download', 'video_start', 'video_complete'])} AS event_type,
         TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
         {_nb('page_url')} AS page_url, {_nb('content_id')} AS content_id, {_nb('content_type')} AS content_type,
         {_nn('session_duration_seconds')} AS session_duration_seconds,
         {_allow('device_type', ['desktop', 'mobile', 'tablet'])} AS device_type,
         {_vocab('traffic_source', ['email', 'organic search', 'direct', 'professional referral'])} AS traffic_source,
         {_nb('source_system')} AS source_system,
         ROW_NUMBER() OVER (PARTITION BY CAST(web_event_id AS VARCHAR)
                            ORDER BY event_timestamp DESC NULLS LAST, page_url NULLS FIRST, content_id NULLS FIRST,
                                     session_duration_seconds NULLS FIRST) AS rn
  FROM bronze_web)
WHERE rn = 1 AND hcp_id IS NOT NULL AND event_type IS NOT NULL AND event_timestamp IS NOT NULL""",
    "rep": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(veeva_event_id AS VARCHAR) AS veeva_event_id, {_tid('hcp_id')} AS hcp_id,
         {_tid('interaction_id')} AS interaction_id, {_tid('campaign_id')} AS campaign_id, {_tid('drug_id')} AS drug_id,
         {_label('interaction_type', [('in-person visit', 'In-Person Visit'), ('phone call', 'Phone Call'), ('virtual meeting', 'Virtual Meeting')])} AS interaction_type,
         TRY_CAST(interaction_timestamp AS TIMESTAMP) AS interaction_timestamp,
         {_nn('interaction_duration_minutes')} AS interaction_duration_minutes,
         {_label('interaction_status', [('completed', 'Completed'), ('cancelled', 'Cancelled'), ('no show', 'No Show')])} AS interaction_status,
         {_nb('interaction_purpose')} AS interaction_purpose, {_nb('discussion_topic')} AS discussion_topic,
         CASE WHEN {_lt('follow_up_required')} IN ('true', '1', 'yes') THEN TRUE
              WHEN {_lt('follow_up_required')} IN ('false', '0', 'no') THEN FALSE ELSE NULL END AS follow_up_required,
         TRY_CAST(follow_up_date AS DATE) AS follow_up_date,
         {_nb('rep_id')} AS rep_id, {_nb('territory')} AS territory, {_nb('channel')} AS channel,
         {_nb('source_system')} AS source_system,
         ROW_NUMBER() OVER (PARTITION BY CAST(veeva_event_id AS VARCHAR) ORDER BY interaction_timestamp DESC NULLS LAST) AS rn
  FROM bronze_rep)
WHERE rn = 1 AND hcp_id IS NOT NULL AND interaction_type IS NOT NULL AND interaction_timestamp IS NOT NULL""",
    "event": f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(event_activity_id AS VARCHAR) AS event_activity_id, {_tid('hcp_id')} AS hcp_id, {_tid('event_id')} AS event_id,
         {_tid('campaign_id')} AS campaign_id, {_tid('drug_id')} AS drug_id, {_nb('event_name')} AS event_name,
         {_label('event_type', [('webinar', 'Webinar'), ('medical education', 'Medical Education'), ('product launch', 'Product Launch'), ('expert panel', 'Expert Panel'), ('clinical discussion', 'Clinical Discussion')])} AS event_type,
         {_vocab('event_activity_type', ['registration', 'attendance'])} AS event_activity_type,
         TRY_CAST(activity_timestamp AS TIMESTAMP) AS activity_timestamp,
         {_nb('registration_status')} AS registration_status,
         {_label('attendance_status', [('attended', 'Attended'), ('not applicable', 'Not Applicable')])} AS attendance_status,
         {_nn('attendance_duration_minutes')} AS attendance_duration_minutes,
         {_nn('questions_asked')} AS questions_asked, {_nn('poll_responses')} AS poll_responses,
         {_allow('device_type', ['desktop', 'mobile', 'tablet'])} AS device_type,
         {_nb('source_system')} AS source_system,
         ROW_NUMBER() OVER (PARTITION BY CAST(event_activity_id AS VARCHAR) ORDER BY activity_timestamp DESC NULLS LAST) AS rn
  FROM bronze_event)
WHERE rn = 1 AND hcp_id IS NOT NULL AND event_activity_type IS NOT NULL AND activity_timestamp IS NOT NULL""",
}

AS_OF = "DATE '2024-02-01'"


def _cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def rnd(expr: str, digits: int) -> str:
    """ROUND half-up on the shortest decimal form of a double (Spark's rule)."""
    return f"CAST(ROUND(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def xavg(expr: str) -> str:
    """Exact average: decimal sum / count (matches the Spark side's exact_avg)."""
    return f"(CAST(SUM(CAST({expr} AS DECIMAL(24, 6))) AS DOUBLE) / NULLIF(COUNT({expr}), 0))"


def _rate(num: str, den: str) -> str:
    return rnd(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)", 4)


def _since(ts: str) -> str:
    return f"CAST(date_diff('day', CAST({ts} AS DATE), {AS_OF}) AS INTEGER)"


FEATURE_SQL = {
    "email": f"""
SELECT hcp_id,
       {_cnt("event_type = 'delivered'")} AS emails_delivered,
       {_cnt("event_type = 'bounced'")} AS emails_bounced,
       {_cnt("event_type = 'open'")} AS email_opens,
       {_cnt("event_type = 'click'")} AS email_clicks,
       {_rate(_cnt("event_type = 'open'"), _cnt("event_type = 'delivered'"))} AS email_open_rate,
       {_rate(_cnt("event_type = 'click'"), _cnt("event_type = 'delivered'"))} AS email_click_rate,
       {_rate(_cnt("event_type = 'click'"), _cnt("event_type = 'open'"))} AS email_ctor,
       MAX(event_timestamp) AS last_email_activity,
       MAX(CASE WHEN event_type IN ('open', 'click') THEN event_timestamp END) AS last_email_engagement,
       {_since("MAX(CASE WHEN event_type IN ('open', 'click') THEN event_timestamp END)")} AS days_since_last_email_engagement,
       {_since('MAX(event_timestamp)')} AS days_since_last_email_activity
FROM silver_email GROUP BY hcp_id""",
    "web": f"""
SELECT hcp_id,
       CAST(COUNT(*) AS BIGINT) AS total_web_events,
       {_cnt("event_type = 'page_view'")} AS page_views,
       {_cnt("event_type = 'content_view'")} AS content_views,
       {_cnt("event_type = 'download'")} AS downloads,
       {_rate(_cnt("event_type = 'download'"), _cnt("event_type = 'content_view'"))} AS download_rate,
       {_cnt("event_type = 'video_start'")} AS video_starts,
       {_cnt("event_type = 'video_complete'")} AS video_completions,
       COALESCE({_rate(_cnt("event_type = 'video_complete'"), _cnt("event_type = 'video_start'"))}, 0) AS video_completion_rate,
       CAST(COUNT(DISTINCT session_id) AS BIGINT) AS sessions,
       {rnd(xavg('session_duration_seconds'), 2)} AS avg_session_duration,
       MAX(event_timestamp) AS last_web_activity,
       MAX(CASE WHEN event_type IN ('content_view', 'download', 'video_start', 'video_complete') THEN event_timestamp END) AS last_web_engagement,
       {_since("MAX(CASE WHEN event_type IN ('content_view', 'download', 'video_start', 'video_complete') THEN event_timestamp END)")} AS days_since_last_web_engagement,
       {_since('MAX(event_timestamp)')} AS days_since_last_web_activity
FROM silver_web GROUP BY hcp_id""",
    "rep": f"""
SELECT hcp_id,
       CAST(COUNT(*) AS BIGINT) AS total_veeva_interactions,
       {_cnt("interaction_type = 'In-Person Visit'")} AS in_person_visits,
       {_cnt("interaction_type = 'Phone Call'")} AS phone_calls,
       {_cnt("interaction_type = 'Virtual Meeting'")} AS virtual_meetings,
       {_cnt("interaction_status = 'Completed'")} AS completed_interactions,
       {_cnt("interaction_status = 'Cancelled'")} AS cancelled_interactions,
       {_cnt("interaction_status = 'No Show'")} AS no_show_interactions,
       {rnd(xavg('interaction_duration_minutes'), 2)} AS avg_interaction_duration_minutes,
       MAX(interaction_duration_minutes) AS max_interaction_duration_minutes,
       {_cnt("follow_up_required = TRUE")} AS followups_required,
       MAX(interaction_timestamp) AS last_veeva_activity,
       MAX(CASE WHEN interaction_status = 'Completed' THEN interaction_timestamp END) AS last_veeva_engagement,
       {_since("MAX(CASE WHEN interaction_status = 'Completed' THEN interaction_timestamp END)")} AS days_since_last_veeva_engagement,
       {_since('MAX(interaction_timestamp)')} AS days_since_last_veeva_activity
FROM silver_rep GROUP BY hcp_id""",
    "event": f"""
SELECT hcp_id,
       CAST(COUNT(*) AS BIGINT) AS total_event_activities,
       {_cnt("event_activity_type = 'registration'")} AS event_registrations,
       {_cnt("event_activity_type = 'attendance'")} AS event_attendance,
       COALESCE({_rate(_cnt("event_activity_type = 'attendance'"), _cnt("event_activity_type = 'registration'"))}, 0) AS event_attendance_rate,
       COALESCE({rnd(xavg("CASE WHEN event_activity_type = 'attendance' THEN attendance_duration_minutes END"), 2)}, 0) AS avg_event_attendance_duration,
       CAST(COALESCE(MAX(CASE WHEN event_activity_type = 'attendance' THEN attendance_duration_minutes END), 0) AS DOUBLE) AS max_event_attendance_duration,
       CAST(COALESCE(SUM(CASE WHEN event_activity_type = 'attendance' THEN questions_asked ELSE 0 END), 0) AS DOUBLE) AS event_questions,
       CAST(COALESCE(SUM(CASE WHEN event_activity_type = 'attendance' THEN poll_responses ELSE 0 END), 0) AS DOUBLE) AS event_polls,
       MAX(activity_timestamp) AS last_event_activity,
       MAX(CASE WHEN event_activity_type = 'attendance' THEN activity_timestamp END) AS last_event_engagement,
       {_since("MAX(CASE WHEN event_activity_type = 'attendance' THEN activity_timestamp END)")} AS days_since_last_event_engagement,
       {_since('MAX(activity_timestamp)')} AS days_since_last_event_activity
FROM silver_event GROUP BY hcp_id""",
}


def ctes(*names: str) -> str:
    """WITH clause providing bronze_*, silver_*, feat_* views as needed."""
    parts: list[tuple[str, str]] = []
    seen: set[str] = set()

    def need(n: str) -> None:
        if n in seen:
            return
        kind, ch = n.split("_", 1)
        if kind == "silver":
            need(f"bronze_{ch}")
            body = SILVER_SQL[ch]
        elif kind == "feat":
            need(f"silver_{ch}")
            body = FEATURE_SQL[ch]
        elif kind == "bronze":
            body = BRONZE_SQL[ch]
        else:
            body = EXTRA_SQL[n]
            for dep in EXTRA_DEPS.get(n, ()):
                need(dep)
        seen.add(n)
        parts.append((n, body))

    for n in names:
        need(n)
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in parts) + "\n"


# Further named CTEs (unification, snapshots, ...) register here.
EXTRA_SQL: dict[str, str] = {}
EXTRA_DEPS: dict[str, tuple[str, ...]] = {}


def sql_date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


# --- unification ---------------------------------------------------------------
def _unify_sql() -> None:
    from pulsegrid.operators.unify import CHANNEL_LAYOUT, FINAL_BUSINESS, NORM_SPEC

    EXTRA_SQL["features_raw"] = (
        "SELECT m.hcp_id, e.* EXCLUDE (hcp_id), w.* EXCLUDE (hcp_id), r.* EXCLUDE (hcp_id), v.* EXCLUDE (hcp_id) "
        "FROM (SELECT DISTINCT hcp_id FROM bronze_master) m "
        "LEFT JOIN feat_email e ON m.hcp_id = e.hcp_id LEFT JOIN feat_web w ON m.hcp_id = w.hcp_id "
        "LEFT JOIN feat_rep r ON m.hcp_id = r.hcp_id LEFT JOIN feat_event v ON m.hcp_id = v.hcp_id"
    )
    EXTRA_DEPS["features_raw"] = ("bronze_master", "feat_email", "feat_web", "feat_rep", "feat_event")
    cols = ["hcp_id"]
    for _, zero_cols, last_cols, rec_cols in CHANNEL_LAYOUT:
        cols += [f"COALESCE({c}, 0) AS {c}" for c in zero_cols]
        cols += last_cols
        cols += [f"COALESCE({c}, 31) AS {c}" for c in rec_cols]
    EXTRA_SQL["features_complete"] = "SELECT " + ", ".join(cols) + " FROM features_raw"
    EXTRA_DEPS["features_complete"] = ("features_raw",)

    rate = "CAST(completed_interactions AS DOUBLE) / NULLIF(CAST(total_veeva_interactions AS DOUBLE), 0)"
    stats = []
    for name, src, _ in NORM_SPEC:
        short = name[5:]
        v = rate if src is None else f"CAST({src} AS DOUBLE)"
        stats += [f"MIN({v}) AS min_{short}", f"MAX({v}) AS max_{short}"]
    EXTRA_SQL["norm_stats"] = "SELECT " + ", ".join(stats) + " FROM features_complete"
    EXTRA_DEPS["norm_stats"] = ("features_complete",)

    norm = ["f.hcp_id"]
    for name, src, inv in NORM_SPEC:
        short = name[5:]
        v = rate.replace("completed_interactions", "f.completed_interactions").replace(
            "total_veeva_interactions", "f.total_veeva_interactions"
        ) if src is None else f"CAST(f.{src} AS DOUBLE)"
        frac = f"({v} - s.min_{short}) / (s.max_{short} - s.min_{short})"
        body = f"1.0 - {frac}" if inv else frac
        norm.append(f"CAST(CASE WHEN s.max_{short} = s.min_{short} THEN 0 ELSE {body} END AS DOUBLE) AS {name}")
    EXTRA_SQL["features_normalized"] = "SELECT " + ", ".join(norm) + " FROM features_complete f CROSS JOIN norm_stats s"
    EXTRA_DEPS["features_normalized"] = ("features_complete", "norm_stats")

    EXTRA_SQL["features_final"] = (
        "SELECT n.hcp_id, " + ", ".join(f"c.{x}" for x in FINAL_BUSINESS) + ", "
        + ", ".join(f"n.{x}" for x, _, _ in NORM_SPEC)
        + " FROM features_normalized n INNER JOIN features_complete c ON n.hcp_id = c.hcp_id"
    )
    EXTRA_DEPS["features_final"] = ("features_normalized", "features_complete")


_unify_sql()


def asof_sql(dates: list[dt.date], data_start: dt.date) -> str:
    """The normalised features of each date from rows before it: the chain of
    statements once for each date, over filtered silver tables."""
    ts = {"email": "event_timestamp", "web": "event_timestamp", "rep": "interaction_timestamp", "event": "activity_timestamp"}
    parts, union = [], []
    for k, d in enumerate(dates):
        body = {"features_raw": EXTRA_SQL["features_raw"], "features_complete": EXTRA_SQL["features_complete"].replace(", 31)", f", {(d - data_start).days})"),
                "norm_stats": EXTRA_SQL["norm_stats"], "features_normalized": EXTRA_SQL["features_normalized"]}
        for ch in ts:
            body[f"feat_{ch}"] = FEATURE_SQL[ch].replace(f"FROM silver_{ch}", f"FROM (SELECT * FROM silver_{ch} WHERE {ts[ch]} < CAST({sql_date(d)} AS TIMESTAMP)) x").replace(AS_OF, sql_date(d))
        for name in (*[f"feat_{ch}" for ch in ts], "features_raw", "features_complete", "norm_stats", "features_normalized"):
            text = body[name]
            for other in body:
                text = text.replace(f"{other} ", f"{other}_{k} ") if not text.endswith(other) else text[: -len(other)].replace(f"{other} ", f"{other}_{k} ") + f"{other}_{k}"
            parts.append(f"{name}_{k} AS ({text})")
        union.append(f"SELECT {sql_date(d)} AS snapshot_date, n.* FROM features_normalized_{k} n")
    head = ctes("bronze_master", *[f"silver_{ch}" for ch in ts]).rstrip("\n")
    return head + ",\n" + ",\n".join(parts) + "\n" + " UNION ALL ".join(union)


# --- snapshots ------------------------------------------------------------------
def _dates_cte(p) -> str:
    rows = ", ".join(f"(DATE '{d.isoformat()}', '{s}')" for d, s in p.all_dates())
    return f"SELECT * FROM (VALUES {rows}) t(snapshot_date, split)"


def _win(ts: str, days: int, history: bool, p) -> str:
    T = "CAST(d.snapshot_date AS TIMESTAMP)"
    if history:
        hi = "<=" if p.hist_closed_right else "<"
        return f"s.{ts} >= {T} - INTERVAL {days} DAY AND s.{ts} {hi} {T}"
    lo = ">" if p.label_open_left else ">="
    hi = "<=" if p.label_open_left else "<"
    return f"s.{ts} {lo} {T} AND s.{ts} {hi} {T} + INTERVAL {days} DAY"


def _c(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def _ds(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(24, 6))) AS DOUBLE)"


def _dm(x: str) -> str:
    return f"({_ds(x)} / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))"


def _nd(x: str) -> str:
    return f"CAST(COUNT(DISTINCT {x}) AS BIGINT)"


def _rec(last: str, p) -> str:
    r = (f"COALESCE(CAST(epoch_us(CAST(snapshot_date AS TIMESTAMP)) - epoch_us({last}) AS DOUBLE)"
         f" / CAST(1000000 AS DOUBLE) / CAST(86400 AS DOUBLE), CAST({p.hist_days} AS DOUBLE))")
    return f"LEAST({r}, CAST({p.hist_days} AS DOUBLE))" if p.clip_recency else r


def _rt(a: str, b: str, p) -> str:
    if p.ratio_guard == "max1":
        return f"CAST({a} AS DOUBLE) / GREATEST(CAST({b} AS DOUBLE), 1.0)"
    return f"CAST({a} AS DOUBLE) / (CAST({b} AS DOUBLE) + 1e-5)"


def snapshot_ctes(p) -> dict[str, str]:
    """Per-channel history aggregates, spine, features and labels for profile ``p``."""
    A = p.name == "A"
    att = "event_activity_type = 'attendance'" if p.attendance_rule == "activity" else "attendance_status = 'Attended'"
    web_eng = ", ".join(f"'{t}'" for t in p.web_engagement_types)
    q = {}
    q["snap_dates"] = _dates_cte(p)
    src = {
        "email": ("silver_email", "event_timestamp"),
        "web": ("silver_web", "event_timestamp"),
        "event": ("silver_event", "activity_timestamp"),
        "rep": ("silver_rep", "interaction_timestamp"),
    }
    for ch, (tbl, ts) in src.items():
        q[f"snap_{ch}_rows"] = f"SELECT s.*, d.snapshot_date FROM {tbl} s JOIN snap_dates d ON {_win(ts, p.hist_days, True, p)}"
    if A:
        email_aggs = [
            f"{_c("event_type = 'delivered'")} AS email_delivered", f"{_c("event_type = 'bounced'")} AS email_bounced",
            f"{_c("event_type = 'open'")} AS email_opens", f"{_c("event_type = 'click'")} AS email_clicks",
        ]
    else:
        email_aggs = [
            f"{_c("delivery_status = 'delivered'")} AS email_delivered", f"{_c("delivery_status = 'bounced'")} AS email_bounced",
            f"{_c("event_type = 'open'")} AS email_open", f"{_c("event_type = 'click'")} AS email_click",
        ]
    email_aggs += [
        f"{_nd('email_id')} AS email_unique_emails", f"{_nd('campaign_id')} AS email_unique_campaigns",
        f"{_nd('drug_id')} AS email_unique_drugs", f"{_nd('CAST(event_timestamp AS DATE)')} AS email_active_days",
        "MAX(event_timestamp) AS _last",
        "MAX(CASE WHEN event_type IN ('open', 'click') THEN event_timestamp END) AS _last_eng",
    ]
    q["snap_email_g"] = f"SELECT hcp_id, snapshot_date, {', '.join(email_aggs)} FROM snap_email_rows GROUP BY hcp_id, snapshot_date"
    dur = "session_duration_seconds"
    web_aggs = [
        "CAST(COUNT(web_event_id) AS BIGINT) AS web_total_events", f"{_nd('session_id')} AS web_unique_sessions",
        f"{_c("event_type = 'page_view'")} AS web_page_views", f"{_c("event_type = 'content_view'")} AS web_content_views",
        f"{_c("event_type = 'download'")} AS web_downloads", f"{_c("event_type = 'video_start'")} AS web_video_starts",
        f"{_c("event_type = 'video_complete'")} AS web_video_completes",
    ]
    if A:
        web_aggs += [
            f"{_ds(dur)} AS web_total_duration", f"{_dm(dur)} AS web_avg_duration", f"MAX({dur}) AS web_max_duration",
            f"{_nd('CAST(event_timestamp AS DATE)')} AS web_active_days", f"{_nd('campaign_id')} AS web_unique_campaigns",
            f"{_nd('drug_id')} AS web_unique_drugs",
        ]
    else:
        web_aggs += [
            f"{_ds(dur)} AS web_total_session_duration", f"{_dm(dur)} AS web_avg_session_duration",
            f"MAX({dur}) AS web_max_session_duration", f"{_nd('CAST(event_timestamp AS DATE)')} AS web_active_days",
            f"{_nd('content_type')} AS web_content_type_diversity", f"{_nd('device_type')} AS web_device_diversity",
        ]
    web_aggs += ["MAX(event_timestamp) AS _last", f"MAX(CASE WHEN event_type IN ({web_eng}) THEN event_timestamp END) AS _last_eng"]
    q["snap_web_g"] = f"SELECT hcp_id, snapshot_date, {', '.join(web_aggs)} FROM snap_web_rows GROUP BY hcp_id, snapshot_date"
    dur = "attendance_duration_minutes"
    ev = [
        f"{_c("event_activity_type = 'registration'")} AS event_registrations", f"{_c(att)} AS event_attendances",
        f"{_ds(dur)} AS event_total_duration", f"{_dm(dur)} AS event_avg_duration",
    ]
    if not A:
        ev.append(f"MAX({dur}) AS event_max_duration")
    ev += [
        f"{_ds('questions_asked')} AS event_questions", f"{_ds('poll_responses')} AS event_polls",
        f"{_nd('CAST(activity_timestamp AS DATE)')} AS event_active_days", f"{_nd('event_id')} AS event_unique_events",
    ]
    if A:
        ev += [f"{_nd('campaign_id')} AS event_unique_campaigns", f"{_nd('drug_id')} AS event_unique_drugs"]
    ev += ["MAX(activity_timestamp) AS _last", f"MAX(CASE WHEN {att} THEN activity_timestamp END) AS _last_eng"]
    q["snap_event_g"] = f"SELECT hcp_id, snapshot_date, {', '.join(ev)} FROM snap_event_rows GROUP BY hcp_id, snapshot_date"
    dur = "interaction_duration_minutes"
    rp = [
        ("CAST(COUNT(*) AS BIGINT)" if A else "CAST(COUNT(veeva_event_id) AS BIGINT)") + " AS veeva_total_interactions",
        f"{_c("interaction_status = 'Completed'")} AS veeva_completed",
        f"{_c("interaction_status = 'Cancelled'")} AS veeva_cancelled",
        f"{_c("interaction_status = 'No Show'")} AS veeva_no_show",
        f"{_c("interaction_type = 'In-Person Visit'")} AS veeva_in_person",
        f"{_c("interaction_type = 'Phone Call'")} AS veeva_phone",
        f"{_c("interaction_type = 'Virtual Meeting'")} AS veeva_virtual",
        f"{_ds(dur)} AS veeva_total_duration", f"{_dm(dur)} AS veeva_avg_duration",
    ]
    if A:
        rp += [
            f"{_c('follow_up_required = TRUE')} AS veeva_follow_up_count",
            f"{_nd('CAST(interaction_timestamp AS DATE)')} AS veeva_active_days", f"{_nd('rep_id')} AS veeva_unique_reps",
            f"{_nd('campaign_id')} AS veeva_unique_campaigns", f"{_nd('drug_id')} AS veeva_unique_drugs",
        ]
    else:
        rp += [
            f"MAX({dur}) AS veeva_max_duration", f"{_c('follow_up_required = TRUE')} AS veeva_followups",
            f"{_nd('CAST(interaction_timestamp AS DATE)')} AS veeva_active_days",
        ]
    rp += ["MAX(interaction_timestamp) AS _last",
           "MAX(CASE WHEN interaction_status = 'Completed' THEN interaction_timestamp END) AS _last_eng"]
    q["snap_rep_g"] = f"SELECT hcp_id, snapshot_date, {', '.join(rp)} FROM snap_rep_rows GROUP BY hcp_id, snapshot_date"

    # per-channel finished tables (rates + recency), entities with activity only
    if A:
        q["snap_email"] = (
            "SELECT * EXCLUDE (_last, _last_eng), "
            f"{_rt('email_opens', 'email_delivered', p)} AS email_open_rate, {_rt('email_clicks', 'email_delivered', p)} AS email_click_rate, "
            f"{_rt('email_clicks', 'email_opens', p)} AS email_ctor, {_rec('_last', p)} AS email_recency_days, "
            f"{_rec('_last_eng', p)} AS email_eng_recency_days FROM snap_email_g"
        )
        q["snap_web"] = (
            f"SELECT * EXCLUDE (_last, _last_eng), {_rt('web_video_completes', 'web_video_starts', p)} AS web_video_completion_rate, "
            f"{_rec('_last', p)} AS web_recency_days, {_rec('_last_eng', p)} AS web_eng_recency_days FROM snap_web_g"
        )
        q["snap_event"] = (
            f"SELECT * EXCLUDE (_last, _last_eng), {_rt('event_attendances', 'event_registrations', p)} AS event_attendance_rate, "
            f"{_rec('_last', p)} AS event_recency_days, {_rec('_last_eng', p)} AS event_att_recency_days FROM snap_event_g"
        )
        q["snap_rep"] = (
            f"SELECT * EXCLUDE (_last, _last_eng), {_rt('veeva_completed', 'veeva_total_interactions', p)} AS veeva_completion_rate, "
            f"{_rec('_last', p)} AS veeva_recency_days, {_rec('_last_eng', p)} AS veeva_comp_recency_days FROM snap_rep_g"
        )
    else:
        names = {"email": ("email_recency", "email_eng_recency"), "web": ("web_recency", "web_eng_recency"),
                 "event": ("event_recency", "event_eng_recency"), "rep": ("veeva_recency", "veeva_eng_recency")}
        for ch, (r1, r2) in names.items():
            q[f"snap_{ch}"] = f"SELECT * RENAME (_last AS _last_{ch}, _last_eng AS _last_eng_{ch}) FROM snap_{ch}_g"
    q["snap_spine"] = "SELECT m.hcp_id, d.snapshot_date, d.split FROM (SELECT DISTINCT hcp_id FROM bronze_master) m CROSS JOIN snap_dates d"
    joined = (
        "SELECT * FROM snap_spine sp "
        + " ".join(f"LEFT JOIN snap_{ch} USING (hcp_id, snapshot_date)" for ch in ("email", "web", "event", "rep"))
    )
    q["snap_joined"] = joined
    return q


def snapshot_sql(p, with_norm: bool = True, with_labels: bool = True, label_set: str = "train") -> str:
    """Full snapshot table of profile ``p`` (features [+ norm] [+ labels])."""
    from pulsegrid.plans import oracle as O

    q = snapshot_ctes(p)
    A = p.name == "A"
    hist = f"CAST({p.hist_days} AS DOUBLE)"
    if A:
        fill = (
            "SELECT COLUMNS(lambda c: c IN ('hcp_id', 'snapshot_date', 'split')), "
            f"COALESCE(COLUMNS(lambda c: c NOT IN ('hcp_id', 'snapshot_date', 'split') AND c LIKE '%recency%'), {hist}), "
            "COALESCE(COLUMNS(lambda c: c NOT IN ('hcp_id', 'snapshot_date', 'split') AND c NOT LIKE '%recency%'), 0) FROM snap_joined"
        )
        q["snap_filled"] = fill
        tot = "(email_delivered + web_total_events + event_registrations + veeva_total_interactions)"
        dig = "(email_delivered + web_total_events + event_registrations)"
        q["snap_feat"] = (
            f"SELECT *, {tot} AS total_touchpoints, "
            "CAST((email_delivered > 0)::INT + (web_total_events > 0)::INT + (event_registrations > 0)::INT + (veeva_total_interactions > 0)::INT AS INTEGER) AS active_channel_count, "
            + ", ".join(
                f"CAST({c} AS DOUBLE) / GREATEST(CAST({tot} AS DOUBLE), 1.0) AS {n}"
                for c, n in (("email_delivered", "email_proportion"), ("web_total_events", "web_proportion"),
                             ("event_registrations", "event_proportion"), ("veeva_total_interactions", "veeva_proportion"))
            )
            + f", {dig} AS digital_touchpoints, veeva_total_interactions AS field_touchpoints, "
            f"CAST({dig} AS DOUBLE) / GREATEST(CAST(veeva_total_interactions AS DOUBLE), 1.0) AS digital_to_field_ratio FROM snap_filled"
        )
    else:
        rec = []
        for ch, (r1, r2) in {"email": ("email_recency", "email_eng_recency"), "web": ("web_recency", "web_eng_recency"),
                             "event": ("event_recency", "event_eng_recency"), "rep": ("veeva_recency", "veeva_eng_recency")}.items():
            rec += [f"{_rec(f'_last_{ch}', p)} AS {r1}", f"{_rec(f'_last_eng_{ch}', p)} AS {r2}"]
        q["snap_rec"] = "SELECT * EXCLUDE (" + ", ".join(
            f"_last_{c}, _last_eng_{c}" for c in ("email", "web", "event", "rep")) + "), " + ", ".join(rec) + " FROM snap_joined"
        q["snap_filled"] = (
            "SELECT COLUMNS(lambda c: c IN ('hcp_id', 'snapshot_date', 'split') OR c LIKE '%recency%'), "
            "COALESCE(COLUMNS(lambda c: c NOT IN ('hcp_id', 'snapshot_date', 'split') AND c NOT LIKE '%recency%'), 0) FROM snap_rec"
        )
        e = "1e-5"
        tot = "(email_delivered + web_total_events + event_registrations + veeva_total_interactions)"
        q["snap_feat"] = (
            "SELECT *, "
            f"email_open / (email_delivered + {e}) AS email_open_rate, email_click / (email_delivered + {e}) AS email_click_rate, "
            f"email_click / (email_open + {e}) AS email_ctor, web_downloads / (web_content_views + {e}) AS web_download_rate, "
            f"web_video_completes / (web_video_starts + {e}) AS web_video_completion_rate, "
            f"event_attendances / (event_registrations + {e}) AS event_attendance_rate, "
            f"veeva_completed / (veeva_total_interactions + {e}) AS veeva_completion_rate, "
            f"veeva_followups / (veeva_total_interactions + {e}) AS veeva_followup_rate, "
            f"{tot} AS total_touchpoints, "
            "CAST((email_delivered > 0)::INT + (web_total_events > 0)::INT + (event_registrations > 0)::INT + (veeva_total_interactions > 0)::INT AS INTEGER) AS active_channels_count, "
            f"email_delivered / ({tot} + {e}) AS email_prop, web_total_events / ({tot} + {e}) AS web_prop, "
            f"event_registrations / ({tot} + {e}) AS event_prop, veeva_total_interactions / ({tot} + {e}) AS veeva_prop, "
            "email_delivered + web_total_events AS digital_touchpoints, event_registrations + veeva_total_interactions AS field_touchpoints, "
            "(email_delivered + web_total_events) / (event_registrations + veeva_total_interactions + 1.0) AS digital_to_field_ratio, "
            "LEAST(email_recency, web_recency, event_recency, veeva_recency) AS min_recency_days FROM snap_filled"
        )
    final = "snap_feat"
    if with_norm:
        q["snap_norm"] = "SELECT * FROM snap_feat LEFT JOIN features_normalized USING (hcp_id)"
        final = "snap_norm"
    if with_labels:
        att = "event_activity_type = 'attendance'" if p.attendance_rule == "activity" else "attendance_status = 'Attended'"
        if A:
            preds = {"email_target": ("silver_email", "event_timestamp", "event_type IN ('open', 'click')"),
                     "web_target": ("silver_web", "event_timestamp", "event_type IN ('content_view', 'download', 'video_complete')")}
        elif label_set == "eval":
            preds = {"email_target": ("silver_email", "event_timestamp", "event_type IN ('open', 'click')"),
                     "web_target": ("silver_web", "event_timestamp", "event_type IN ('content_view', 'download', 'video_start', 'video_complete')")}
        else:
            preds = {"email_target": ("silver_email", "event_timestamp", "event_type = 'click'"),
                     "web_target": ("silver_web", "event_timestamp", "event_type IN ('download', 'video_complete')")}
        preds["webinar_target"] = ("silver_event", "activity_timestamp", att)
        preds["veeva_target"] = ("silver_rep", "interaction_timestamp", "interaction_status = 'Completed'")
        for t, (tbl, ts, cond) in preds.items():
            q[f"lab_{t}"] = (f"SELECT DISTINCT s.hcp_id, d.snapshot_date FROM {tbl} s JOIN snap_dates d ON "
                             f"{_win(ts, p.fut_days, False, p)} WHERE {cond}")
        sel = ", ".join(
            f"CAST(CASE WHEN l_{i}.hcp_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS {t}" for i, t in enumerate(preds)
        )
        joins = " ".join(
            f"LEFT JOIN lab_{t} l_{i} ON f.hcp_id = l_{i}.hcp_id AND f.snapshot_date = l_{i}.snapshot_date"
            for i, t in enumerate(preds)
        )
        q["snap_final"] = f"SELECT f.*, {sel} FROM {final} f {joins}"
        final = "snap_final"
    deps = ["bronze_master", "silver_email", "silver_web", "silver_event", "silver_rep"]
    if with_norm:
        deps.append("features_normalized")
    head = O.ctes(*deps).rstrip("\n")
    body = ",\n".join(f"{k} AS ({v})" for k, v in q.items())
    return f"{head},\n{body}\nSELECT * FROM {final}"


# --- scoring (deterministic rate propensities, profile A) -----------------------------
def _avg_rank(x: str, part: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    pp = f"{part}, {x}" if part else x
    return f"(RANK() OVER ({p}ORDER BY {x}) + (COUNT(*) OVER (PARTITION BY {pp}) - 1) / 2.0)"


def scoring_sql(kind: str, p=None) -> str:
    from pulsegrid.config import PROFILE_A
    from pulsegrid.operators.metrics import threshold_grid
    from pulsegrid.operators.scoring import CHANNEL_WEIGHT_CANDIDATES, HYBRID_CANDIDATES

    p = p or PROFILE_A
    base = snapshot_sql(p, with_norm=False, with_labels=True)
    head, _, _ = base.rpartition("\nSELECT * FROM snap_final")
    w = p.channel_weights

    def clip(x: str) -> str:
        return f"LEAST(GREATEST({x}, 0.0), 100.0)" if p.clip_scores else x
    q = {
        "scored0": (
            "SELECT hcp_id, snapshot_date, split, total_touchpoints, LEAST(email_open_rate, 1.0) AS p_email, "
            "LEAST(CAST(web_content_views + web_downloads + web_video_completes AS DOUBLE) / GREATEST(CAST(web_total_events AS DOUBLE), 1.0), 1.0) AS p_web, "
            "LEAST(event_attendance_rate, 1.0) AS p_webinar, veeva_completion_rate AS p_rep, "
            "email_target, web_target, webinar_target, veeva_target FROM snap_final"
        ),
        "trange": "SELECT MIN(total_touchpoints) AS lo, MAX(total_touchpoints) AS hi FROM scored0 WHERE split = 'train'",
        "scoredh": (
            "SELECT s.*, CASE WHEN r.hi = r.lo THEN 0.0 ELSE LEAST(GREATEST((CAST(s.total_touchpoints AS DOUBLE) - r.lo) / CAST(r.hi - r.lo AS DOUBLE) * 100.0, 0.0), 100.0) END AS hist_score "
            "FROM scored0 s CROSS JOIN trange r"
        ),
        "scored": (
            f"SELECT *, (p_email * {w[0]} + p_web * {w[1]} + p_webinar * {w[2]} + p_rep * {w[3]}) * 100.0 AS pred_score FROM scoredh"
            if not p.select_channel_weights else
            "SELECT s.*, " + clip("(s.p_email * k.a + s.p_web * k.b + s.p_webinar * k.c + s.p_rep * k.d) * 100.0")
            + " AS pred_score FROM scoredh s CROSS JOIN wbest k"
        ),
        "lp": " UNION ALL ".join(
            f"SELECT split, '{t}' AS target, {pc} AS prob, {t} AS label FROM scored"
            for pc, t in (("p_email", "email_target"), ("p_web", "web_target"), ("p_webinar", "webinar_target"), ("p_rep", "veeva_target"))
        ),
        "lt": "SELECT * FROM lp WHERE split = 'test'",
        "val0": "SELECT *, email_target + web_target + webinar_target + veeva_target AS fut FROM scoredh WHERE split = 'val'",
        "val": "SELECT *, email_target + web_target + webinar_target + veeva_target AS fut FROM scored WHERE split = 'val'",
    }
    q["roc"] = (
        f"SELECT target, (SUM(r) FILTER (WHERE label = 1) - CAST(SUM(label) AS DOUBLE) * (CAST(SUM(label) AS DOUBLE) + 1) / 2.0)"
        f" / NULLIF(CAST(SUM(label) AS DOUBLE) * CAST(COUNT(*) - SUM(label) AS DOUBLE), 0) AS roc_auc "
        f"FROM (SELECT target, label, {_avg_rank('prob', 'target')} AS r FROM lt) GROUP BY target"
    )
    q["pr"] = (
        "SELECT target, SUM(pos * (prec + prev) / 2.0) / NULLIF(CAST(SUM(pos) AS DOUBLE), 0) AS pr_auc, "
        "SUM(pos * prec) / NULLIF(CAST(SUM(pos) AS DOUBLE), 0) AS average_precision FROM ("
        " SELECT target, pos, CAST(tp AS DOUBLE) / (tp + fp) AS prec,"
        " CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) ELSE 1.0 END AS prev FROM ("
        "  SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM ("
        "   SELECT target, prob, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM lt GROUP BY target, prob)"
        "  WINDOW w AS (PARTITION BY target ORDER BY prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))) GROUP BY target"
    )
    q["cm"] = (
        "SELECT target, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy, "
        "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, "
        "CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall, "
        "CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM ("
        " SELECT target, COUNT(*) FILTER (WHERE prob >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (WHERE prob >= 0.5 AND label <> 1) AS fp,"
        " COUNT(*) FILTER (WHERE prob < 0.5 AND label = 1) AS fn, COUNT(*) FILTER (WHERE prob < 0.5 AND label <> 1) AS tn FROM lt GROUP BY target)"
    )
    names = "CASE target WHEN 'email_target' THEN 'Email' WHEN 'web_target' THEN 'Website' WHEN 'webinar_target' THEN 'Webinar' ELSE 'Sales Rep' END"
    q["per"] = (
        f"SELECT {names} AS channel, {rnd('roc_auc', 4)} AS roc_auc, {rnd('pr_auc', 4)} AS pr_auc, "
        + ", ".join(f"{rnd(c, 4)} AS {c}" for c in ("accuracy", "precision", "recall", "f1"))
        + " FROM roc JOIN pr USING (target) JOIN cm USING (target)"
    )
    grid = threshold_grid()
    q["grid"] = "SELECT * FROM (VALUES " + ", ".join(f"({j}, CAST('{repr(t)}' AS DOUBLE))" for j, t in enumerate(grid)) + ") g(j, thr)"
    q["acc"] = (
        "SELECT v.target, g.j, g.thr, CAST(COUNT(*) FILTER (WHERE (v.prob >= g.thr) = (v.label = 1)) AS DOUBLE) / COUNT(*) AS accuracy "
        "FROM (SELECT * FROM lp WHERE split = 'val') v CROSS JOIN grid g GROUP BY v.target, g.j, g.thr"
    )
    hc = " UNION ALL ".join(f"SELECT {i} AS cand, CAST({h} AS DOUBLE) AS h, CAST({w2} AS DOUBLE) AS w" for i, (h, w2) in enumerate(HYBRID_CANDIDATES))
    q["hcand"] = hc
    q["hgrid"] = (
        f"SELECT cand, CORR(rx, ry) AS spearman FROM (SELECT cand, {_avg_rank('x', 'cand')} AS rx, {_avg_rank('fut', 'cand')} AS ry "
        "FROM (SELECT c.cand, v.hist_score * c.h + v.pred_score * c.w AS x, v.fut FROM val v CROSS JOIN hcand c)) GROUP BY cand"
    )
    wc = " UNION ALL ".join(
        f"SELECT {i} AS cand, {a} AS a, {b} AS b, {c} AS c, {d} AS d" for i, (a, b, c, d) in enumerate(CHANNEL_WEIGHT_CANDIDATES)
    )
    q["wcand"] = wc
    q["wgrid"] = (
        f"SELECT cand, CORR(rx, ry) AS spearman FROM (SELECT cand, {_avg_rank('x', 'cand')} AS rx, {_avg_rank('fut', 'cand')} AS ry "
        "FROM (SELECT c.cand, (v.p_email * c.a + v.p_web * c.b + v.p_webinar * c.c + v.p_rep * c.d) * 100.0 AS x, v.fut FROM val0 v CROSS JOIN wcand c)) GROUP BY cand"
    )
    q["wbest"] = "SELECT c.a, c.b, c.c, c.d FROM wgrid g JOIN wcand c USING (cand) ORDER BY g.spearman DESC NULLS LAST, g.cand LIMIT 1"
    q["best"] = "SELECT c.h, c.w FROM hgrid g JOIN hcand c USING (cand) ORDER BY g.spearman DESC NULLS LAST, g.cand LIMIT 1"
    vh = clip("v.hist_score * b.h + v.pred_score * b.w")
    q["cuts"] = (
        f"SELECT b.h AS w_hist, b.w AS w_pred, quantile_cont({vh}, {p.quantiles[0]}) AS q33, "
        f"quantile_cont({vh}, {p.quantiles[1]}) AS q66 FROM val v CROSS JOIN best b GROUP BY b.h, b.w"
    )
    q["base"] = "SELECT " + ", ".join(f"AVG({c}) AS base_{c}" for c in ("p_email", "p_web", "p_webinar", "p_rep")) + " FROM val"
    if p.next_best_by_lift:
        vals = [f"s.{c} / GREATEST(b.base_{c}, 1e-6)" for c in ("p_email", "p_web", "p_webinar", "p_rep")]
    else:
        vals = [f"s.{c}" for c in ("p_email", "p_web", "p_webinar", "p_rep")]
    rep = p.rep_label
    nbc = (
        f"CASE WHEN {vals[0]} >= {vals[1]} AND {vals[0]} >= {vals[2]} AND {vals[0]} >= {vals[3]} THEN 'Email' "
        f"WHEN {vals[1]} >= {vals[2]} AND {vals[1]} >= {vals[3]} THEN 'Website' WHEN {vals[2]} >= {vals[3]} THEN 'Webinar' ELSE '{rep}' END"
    )
    hyb = clip("(s.hist_score * k.w_hist + s.pred_score * k.w_pred)")
    le = "<=" if p.tier_cut_inclusive else "<"
    q["gold"] = (
        f"SELECT s.hcp_id, {rnd('s.hist_score', 2)} AS historical_engagement_score, {rnd('s.pred_score', 2)} AS predicted_engagement_score, "
        f"{rnd(hyb, 2)} AS hybrid_engagement_score, "
        f"CASE WHEN {hyb} {le} k.q33 THEN 'Low' WHEN {hyb} {le} k.q66 THEN 'Medium' ELSE 'High' END AS engagement_level, "
        f"{rnd('s.p_email', 4)} AS email_probability, {rnd('s.p_web', 4)} AS website_probability, "
        f"{rnd('s.p_webinar', 4)} AS webinar_probability, {rnd('s.p_rep', 4)} AS sales_rep_probability, {nbc} AS next_best_channel "
        "FROM scored s CROSS JOIN cuts k CROSS JOIN base b WHERE s.split = 'current'"
    )
    first = ["scored0", "trange", "scoredh", "val0", "wcand", "wgrid", "wbest"]
    q = {k: q[k] for k in first} | {k: v for k, v in q.items() if k not in first}
    finals = {
        "scored": "SELECT * FROM scored",
        "roc_auc": f"SELECT target, {rnd('roc_auc', 4)} AS roc_auc FROM roc",
        "pr_auc": f"SELECT target, {rnd('pr_auc', 4)} AS pr_auc, {rnd('average_precision', 4)} AS average_precision FROM pr",
        "confusion": "SELECT target, " + ", ".join(f"{rnd(c, 4)} AS {c}" for c in ("accuracy", "precision", "recall", "f1")) + " FROM cm",
        "metrics_overall": "SELECT * FROM per UNION ALL SELECT 'Overall', "
        + ", ".join(f"{rnd(f'AVG({c})', 4)}" for c in ("roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1")) + " FROM per",
        "threshold": f"SELECT target, {rnd('thr', 6)} AS threshold, {rnd('accuracy', 6)} AS accuracy FROM ("
        "SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY ABS(accuracy - 0.75), j) AS rn FROM acc) WHERE rn = 1",
        "spearman": f"SELECT {rnd('CORR(rx, ry)', 6)} AS spearman FROM (SELECT {_avg_rank('pred_score')} AS rx, {_avg_rank('fut')} AS ry FROM val)",
        "hybrid_grid": f"SELECT cand, {rnd('spearman', 6)} AS spearman FROM hgrid",
        "weight_grid": f"SELECT cand, {rnd('spearman', 6)} AS spearman FROM wgrid",
        "weight_gram": "SELECT CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(CAST((fut / 4.0) * (fut / 4.0) AS DECIMAL(38, 12))) AS DOUBLE) AS yy, "
        + ", ".join(
            f"CAST(SUM(CAST({a} * {b} AS DECIMAL(38, 12))) AS DOUBLE) AS g{i}{j}"
            for i, a in enumerate(("p_email", "p_web", "p_webinar", "p_rep"))
            for j, b in enumerate(("p_email", "p_web", "p_webinar", "p_rep")) if j >= i
        )
        + ", "
        + ", ".join(
            f"CAST(SUM(CAST({a} * (fut / 4.0) AS DECIMAL(38, 12))) AS DOUBLE) AS b{i}"
            for i, a in enumerate(("p_email", "p_web", "p_webinar", "p_rep"))
        )
        + " FROM val",
        "tier_cuts": f"SELECT w_hist, w_pred, {rnd('q33', 6)} AS q33, {rnd('q66', 6)} AS q66 FROM cuts",
        "base_rates": "SELECT " + ", ".join(f"{rnd(f'base_{c}', 8)} AS base_{c}" for c in ("p_email", "p_web", "p_webinar", "p_rep")) + " FROM base",
        "final_scores": "SELECT * FROM gold",
        "lift_rows": "SELECT s.hcp_id, " + ", ".join(
            f"{rnd(f's.{c} / GREATEST(b.base_{c}, 1e-6)', 6)} AS lift_{c[2:]}" for c in ("p_email", "p_web", "p_webinar", "p_rep")
        ) + " FROM scored s CROSS JOIN base b WHERE s.split = 'current'",
        "metrics_overall_b": "SELECT * FROM (WITH thr AS (SELECT target, thr FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY ABS(accuracy - 0.75), j) AS rn FROM acc) WHERE rn = 1), "
        "cmb AS (SELECT target, any_value(thr) AS threshold, COUNT(*) FILTER (WHERE prob >= thr AND label = 1) AS tp, COUNT(*) FILTER (WHERE prob >= thr AND label <> 1) AS fp, "
        "COUNT(*) FILTER (WHERE prob < thr AND label = 1) AS fn, COUNT(*) FILTER (WHERE prob < thr AND label <> 1) AS tn FROM lt JOIN thr USING (target) GROUP BY target), "
        f"perb AS (SELECT {names.replace('Sales Rep', 'Veeva')} AS channel, {rnd('threshold', 6)} AS threshold, {rnd('roc_auc', 4)} AS roc_auc, {rnd('average_precision', 4)} AS pr_auc, "
        f"{rnd('CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn)', 4)} AS accuracy, {rnd('CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END', 4)} AS precision, "
        f"{rnd('CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END', 4)} AS recall, "
        f"{rnd('CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END', 4)} AS f1 FROM cmb JOIN roc USING (target) JOIN pr USING (target)) "
        "SELECT * FROM perb UNION ALL SELECT 'Overall', NULL, " + ", ".join(rnd(f"(SELECT AVG({c}) FROM perb)", 4) for c in ("roc_auc", "pr_auc"))
        + f", {rnd('CAST(SUM(tp + tn) AS DOUBLE) / SUM(tp + tn + fp + fn)', 4)}, " + ", ".join(rnd(f"(SELECT AVG({c}) FROM perb)", 4) for c in ("precision", "recall", "f1")) + " FROM cmb)",
        "score_summary": " UNION ALL ".join(
            f"SELECT '{c}' AS metric, MIN({c}) AS min, MAX({c}) AS max, {rnd(f'AVG({c})', 4)} AS mean FROM gold"
            for c in ("historical_engagement_score", "predicted_engagement_score", "hybrid_engagement_score",
                      "email_probability", "website_probability", "webinar_probability", "sales_rep_probability")
        ),
        "value_counts": "SELECT 'engagement_level' AS field, engagement_level AS value, CAST(COUNT(*) AS BIGINT) AS count FROM gold GROUP BY 2 "
        "UNION ALL SELECT 'next_best_channel', next_best_channel, CAST(COUNT(*) AS BIGINT) FROM gold GROUP BY 2",
    }
    body = ",\n".join(f"{k} AS ({v})" for k, v in q.items())
    return f"{head},\n{body}\n{finals[kind]}"


SCORING_BASE_CTES = ("scored", "gold")


# --- serving (over the deterministic gold table) --------------------------------------
def serving_sql(final: str, extra: dict[str, str] | None = None) -> str:
    full = scoring_sql("final_scores")
    head = full[: full.rindex("\nSELECT * FROM gold")]
    more = "".join(f",\n{k} AS ({v})" for k, v in (extra or {}).items())
    return f"{head}{more}\n{final}"


def _reasons_sql() -> str:
    """(hcp_id, recommended_reason) of the gold rows: see ``scoring.rate_reason``."""
    from pulsegrid.functions.reasons import PHRASES_A
    from pulsegrid.operators.scoring import RATE_DRIVERS, RATE_PARTS

    probs = ("email_probability", "website_probability", "webinar_probability", "sales_rep_probability")
    prob = "CASE g.next_best_channel " + " ".join(f"WHEN '{c}' THEN g.{p}" for c, p in zip(RATE_DRIVERS, probs)) + " END"
    pct = f"CAST(ROUND(CAST({prob} AS DECIMAL(9, 4)) * 100, 1) AS DECIMAL(9, 1))"
    most = f"GREATEST({', '.join('s.' + c for c in RATE_PARTS)})"
    web = " ".join(f"WHEN s.{c} = {most} THEN '{PHRASES_A[c]}'" for c in RATE_PARTS)
    driver = "CASE " + " ".join(
        f"WHEN g.next_best_channel = '{c}' THEN " + (f"'{PHRASES_A[parts[0]]}'" if len(parts) == 1 else f"CASE {web} END") for c, parts in RATE_DRIVERS.items()
    ) + " END"
    # The sentences of functions.reasons.reason_a.
    return (
        "SELECT hcp_id, CASE engagement_level WHEN 'High' THEN 'Since this HCP is highly engaged overall, ' || c || ' is the ideal next step (' || pct || "
        "'% likelihood), driven largely by their ' || d || '.' "
        "WHEN 'Medium' THEN 'We recommend reaching out via ' || c || ' (' || pct || '% likelihood). The model selected this channel primarily due to the HCP''s ' || d || '.' "
        "ELSE 'To build momentum with this lower-engagement HCP, ' || c || ' is the safest bet (' || pct || '% likelihood), which strongly aligns with their ' || d || '.' END AS recommended_reason "
        f"FROM (SELECT g.hcp_id, g.engagement_level, g.next_best_channel AS c, CAST({pct} AS VARCHAR) AS pct, {driver} AS d "
        "FROM gold g JOIN snap_final s ON g.hcp_id = s.hcp_id AND s.split = 'current')"
    )


REASONS_SQL = _reasons_sql()
