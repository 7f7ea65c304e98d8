"""Profiling and data-quality reports (each returns a small DataFrame).

All reports are single aggregations over the silver or feature table: scalar
checks fold into one ``agg`` (one scan), listings are filters. Nothing is
collected; the caller decides whether to show, write or assert.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulsegrid.functions.cleaning import any_negative, exact_avg, ratio
from pulsegrid.plans.channels import ChannelSpec


def profile_counts(df: DataFrame, distinct_cols: list[str] | tuple[str, ...]) -> DataFrame:
    """A1: COUNT(*) plus exact COUNT(DISTINCT c) for each column."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_distinct(c).alias(f"unique_{c}") for c in distinct_cols],
    )


def category_distribution(df: DataFrame, categories: list[str] | tuple[str, ...]) -> DataFrame:
    """A2: rows and distinct entities per category value (NULL is a group).

    Several category columns are profiled in one pass: each row is unpivoted
    to (category, value) pairs map-side, then a single shuffle aggregates.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in categories])
    )
    long = df.select(F.col("hcp_id"), pairs.alias("p")).select("hcp_id", "p.category", "p.value")
    return (
        long.groupBy("category", "value")
        .agg(F.count(F.lit(1)).alias("records"), F.count_distinct("hcp_id").alias("unique_hcps"))
        .orderBy(F.col("category"), F.col("records").desc(), F.col("value").asc_nulls_first())
    )


def duplicate_key_count(df: DataFrame, key: str, out: str = "duplicate_ids") -> DataFrame:
    """Number of key values occurring more than once (two-level aggregate)."""
    return df.groupBy(key).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias(out))


def duplicate_listing(df: DataFrame, key: str = "hcp_id") -> DataFrame:
    """Key values with more than one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("records")).where(F.col("records") > 1)


def null_counts(df: DataFrame, cols: list[str] | tuple[str, ...], prefix: str = "null_") -> DataFrame:
    """Per-column NULL counts in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in cols])


def activity_range(df: DataFrame, ts: str, label: str) -> DataFrame:
    """First and last activity (min/max come from parquet footers when unfiltered)."""
    return df.agg(F.min(ts).alias(f"first_{label}_activity"), F.max(ts).alias(f"last_{label}_activity"))


def entity_coverage(df: DataFrame, label: str) -> DataFrame:
    """Distinct active entities."""
    return df.agg(F.count_distinct("hcp_id").alias(f"{label}_active_hcps"))


def coverage_vs_master(master: DataFrame, feats: DataFrame, label: str) -> DataFrame:
    """Distinct master entities and how many of them have channel features."""
    f = feats.select(F.col("hcp_id").alias("f_id")).distinct()
    j = master.select("hcp_id").join(f, F.col("hcp_id") == F.col("f_id"), "left")
    return j.agg(F.count_distinct("hcp_id").alias("total_hcps"), F.count_distinct("f_id").alias(f"{label}_active_hcps"))


def range_stats(df: DataFrame, cols: dict[str, tuple[str, int]]) -> DataFrame:
    """Min / max / rounded mean per column (mean is the exact decimal mean).

    ``cols`` maps column -> (short name, digits of the rounded mean)."""
    aggs: list[Column] = []
    for c, (short, digits) in cols.items():
        aggs += [
            F.min(c).alias(f"min_{short}"),
            F.max(c).alias(f"max_{short}"),
            exact_avg(c, digits).alias(f"avg_{short}"),
        ]
    return df.agg(*aggs)


def negative_rows(df: DataFrame, cols: list[str] | tuple[str, ...], out: str) -> DataFrame:
    """rows with any negative value among ``cols``."""
    return df.where(any_negative(cols)).agg(F.count(F.lit(1)).alias(out))


def recompute_ratio(df: DataFrame, num: str, den: str, stored: str, out: str) -> DataFrame:
    """Q3/Q4/Q6: stored rate next to the recomputed ROUND(num / NULLIF(den,0), 4)."""
    return df.select("hcp_id", den, num, stored, ratio(F.col(num), F.col(den)).alias(out))


def clicks_without_open(silver_email: DataFrame) -> DataFrame:
    """Clicks whose ``email_id`` never appears on an open.

    Same answer as ``email_id NOT IN (SELECT email_id ... open ... NOT NULL)``
    (null-aware) without any join: clicks and opens are counted per id first;
    ids without an open give their clicks, and NULL-id clicks count only when
    no id has an open (an empty NOT IN list is true for every row, NULL
    included).
    """
    # one partially aggregated count per id: a mass mailing is one row a task in the shuffle
    g = silver_email.where(F.col("event_type").isin("click", "open")).groupBy("email_id").agg(
        F.count_if(F.col("event_type") == "click").alias("c"), F.count_if(F.col("event_type") == "open").alias("p")
    )
    known = F.col("email_id").isNotNull()
    s = g.agg(
        F.sum(F.when(known & (F.col("p") == 0), F.col("c"))).alias("a"),
        F.sum(F.when(~known, F.col("c"))).alias("n"),
        F.sum(F.when(known, F.col("p"))).alias("o"),
    )
    return s.select(
        (F.coalesce(F.col("a"), F.lit(0)) + F.when(F.coalesce(F.col("o"), F.lit(0)) == 0, F.coalesce(F.col("n"), F.lit(0))).otherwise(F.lit(0)))
        .cast("bigint")
        .alias("clicks_without_open")
    )


def attendance_without_registration(silver_event: DataFrame) -> DataFrame:
    """Attendance rows with no registration for the same (entity, event).

    ``NOT EXISTS`` as one partially aggregated count per (entity, event); NULL
    keys never match, so such attendance rows are counted (as in the correlated
    subquery).
    """
    kind = F.col("event_activity_type")
    g = silver_event.where(kind.isin("attendance", "registration")).groupBy("hcp_id", "event_id").agg(
        F.count_if(kind == "attendance").alias("a"), F.count_if(kind == "registration").alias("r")
    )
    alone = (F.col("r") == 0) | F.col("hcp_id").isNull() | F.col("event_id").isNull()
    return g.agg(F.coalesce(F.sum(F.when(alone, F.col("a"))), F.lit(0)).alias("attendance_without_registration"))


def completion_rate(silver_rep: DataFrame) -> DataFrame:
    """Overall completed / total interactions."""
    g = silver_rep.agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.count_if(F.col("interaction_status") == "Completed").alias("completed_interactions"),
    )
    return g.select("*", ratio(F.col("completed_interactions"), F.col("total_interactions")).alias("overall_completion_rate"))


def count_consistency(feat_rep: DataFrame) -> DataFrame:
    """Q7: entities whose total differs from the sum of the typed counts."""
    parts = F.col("in_person_visits") + F.col("phone_calls") + F.col("virtual_meetings")
    return feat_rep.where(F.col("total_veeva_interactions") != parts).select(
        "hcp_id", "total_veeva_interactions", parts.alias("calculated_total_interactions")
    )


def session_validation(silver_web: DataFrame) -> DataFrame:
    """Distinct sessions and distinct sessions with a page view."""
    return silver_web.agg(
        F.count_distinct("session_id").alias("unique_sessions"),
        F.count_distinct(F.when(F.col("event_type") == "page_view", F.col("session_id"))).alias(
            "sessions_with_page_view"
        ),
    )


def silver_null_report(silver: DataFrame, spec: ChannelSpec) -> DataFrame:
    return null_counts(silver, [spec.key, "hcp_id", spec.gate_type, spec.ts])


def scalar_checks(spec: ChannelSpec) -> list[Column]:
    """Every scalar check of a silver log that needs no distinct count: rows,
    NULLs of the gate columns, rows with a negative value, first and last
    activity, and rows per category column that name no value (A12, A17, F5)."""
    checks = [F.count(F.lit(1)).alias("total_rows")]
    checks += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in dict.fromkeys((spec.key, "hcp_id", spec.gate_type, spec.ts))]
    if spec.non_negative:
        checks.append(F.count_if(any_negative(spec.non_negative)).alias("negative_values"))
    checks += [F.min(spec.ts).alias("first_activity"), F.max(spec.ts).alias("last_activity")]
    checks += [F.count_if(F.col(c).isNull()).alias(f"unnamed_{c}") for c in spec.categories]
    return checks


def observed(df: DataFrame, checks: list[Column], write: Callable[[DataFrame], object]) -> DataFrame:
    """``write(df)`` once, with ``checks`` computed on the rows as they are written:
    one row of their results, equal to ``df.agg(*checks)`` without another scan.

    The checks sit above the last shuffle, so their sums come from the writing
    tasks and a task that is run again counts once."""
    empty = df.limit(0).agg(*checks)
    watch = Observation()
    write(df.observe(watch, *checks))
    got = watch.get
    nothing = {} if got else empty.first().asDict()  # a plan proved empty reports no metrics
    return df.sparkSession.createDataFrame([tuple(got.get(c, nothing.get(c)) for c in empty.columns)], empty.schema)
