"""Serving tables: dashboard aggregates, directory search, paging, extracts.

The reference serves these through an HTTP API over a relational store; here
each endpoint's *data work* is a DataFrame function over the gold score table
and the entity profile (no server). The dashboard is one aggregation pass
(every count, average and bucket is a conditional aggregate of the same
scan) unpivoted with ``stack``; zero-filled buckets come from the aggregate
itself, not from a join against a bucket list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.cleaning import channel_key

TIERS = ["High", "Medium", "Low"]
# Score histogram buckets (upper bound inclusive, last is the rest).
BUCKETS = [("0-20", 20), ("21-40", 40), ("41-60", 60), ("61-80", 80), ("81-100", None)]
CHANNEL_COLS = [
    ("Email", "email_probability"),
    ("Website", "website_probability"),
    ("Webinar", "webinar_probability"),
    ("Sales_Rep", "sales_rep_probability"),
]


def _bucket_of(score: Column) -> Column:
    expr = None
    for label, hi in BUCKETS[:-1]:
        expr = F.when(score <= hi, label) if expr is None else expr.when(score <= hi, label)
    return expr.otherwise(BUCKETS[-1][0])


def dashboard_aggregates(gold: DataFrame) -> DataFrame:
    """One scan: totals, tier counts, average score, bucket counts, channel averages."""
    s = F.col("hybrid_engagement_score")
    b = _bucket_of(s)
    ident = F.col("hcp_id")
    # every count is COUNT(hcp_id) of the matching rows, as in the reference
    aggs = [F.count(ident).alias("total_hcps")]
    aggs += [F.count(F.when(F.col("engagement_level") == t, ident)).alias(f"{t.lower()}_engagement") for t in TIERS]
    aggs += [F.coalesce(F.avg(s), F.lit(0.0)).alias("average_engagement_score")]
    aggs += [F.count(F.when(b == label, ident)).alias(f"bucket_{i}") for i, (label, _) in enumerate(BUCKETS)]
    aggs += [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"avg_{n}") for n, c in CHANNEL_COLS]
    if "updated_at" in gold.columns:
        aggs += [F.coalesce(F.max("updated_at"), F.localtimestamp()).alias("last_updated")]
    return gold.agg(*aggs)


def dash_tiers(gold: DataFrame) -> DataFrame:
    """Total and per-tier counts (zero-filled; unknown tiers ignored)."""
    return dashboard_aggregates(gold).select("total_hcps", "high_engagement", "medium_engagement", "low_engagement")


def dash_avg(gold: DataFrame) -> DataFrame:
    """Average hybrid score, 0.0 when there is none."""
    return dashboard_aggregates(gold).select("average_engagement_score")


def dash_histogram(gold: DataFrame) -> DataFrame:
    """Five score buckets in order, zero-filled (NULL scores fall in the last)."""
    a = dashboard_aggregates(gold)
    arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(label).alias("bucket"), F.col(f"bucket_{i}").alias("count"))
                    for i, (label, _) in enumerate(BUCKETS)])
    return a.select(F.explode(arr).alias("b")).select("b.pos", "b.bucket", "b.count").orderBy("pos")


def dash_allocation(gold: DataFrame) -> DataFrame:
    """Channel share of the summed average probabilities; effectiveness = share*100 (1 dp)."""
    a = dashboard_aggregates(gold)
    total = sum(F.col(f"avg_{n}") for n, _ in CHANNEL_COLS)
    arr = F.array(*[F.struct(F.lit(n).alias("channel"), F.col(f"avg_{n}").alias("avg_probability")) for n, _ in CHANNEL_COLS])
    x = a.select(total.alias("_t"), F.explode(arr).alias("c")).select("_t", "c.channel", "c.avg_probability")
    share = F.when(F.col("_t") > 0, F.col("avg_probability") / F.col("_t")).otherwise(F.lit(0.0))
    return x.select("channel", "avg_probability", share.alias("allocation"), F.round(share * 100, 1).alias("effectiveness"))


def dash_allocation_vs_baseline(gold: DataFrame) -> DataFrame:
    """Even 25% baseline next to the model allocation in percent."""
    return dash_allocation(gold).select("channel", F.lit(25.0).alias("baseline_pct"), (F.col("allocation") * 100).alias("model_pct"))


def dash_last_updated(profiles: DataFrame) -> DataFrame:
    """Latest profile update, else the current time."""
    return profiles.agg(F.coalesce(F.max("updated_at"), F.localtimestamp()).alias("last_updated"))  # wall clock, no zone


def dash_high_pct(gold: DataFrame) -> DataFrame:
    """Share of high-tier entities in whole percent (half-up), 0 when empty."""
    a = dashboard_aggregates(gold)
    pct = F.when(F.col("total_hcps") > 0, F.round(F.col("high_engagement") / F.col("total_hcps") * 100, 0)).otherwise(F.lit(0.0))
    return a.select(pct.cast("bigint").alias("high_pct"))


def dashboard(gold: DataFrame, profiles: DataFrame) -> DataFrame:
    """The whole dashboard as one nested row (struct / array-of-struct columns).

    Profile rows are stacked under the score rows (their score columns are
    NULL and their ``hcp_id`` is absent), so one aggregate computes the score
    statistics and the latest profile update together."""
    stacked = gold.unionByName(profiles.select("updated_at"), allowMissingColumns=True)
    a = dashboard_aggregates(stacked)
    total = sum(F.col(f"avg_{n}") for n, _ in CHANNEL_COLS)
    share = {n: F.when(total > 0, F.col(f"avg_{n}") / total).otherwise(F.lit(0.0)) for n, _ in CHANNEL_COLS}
    return a.select(
        "total_hcps", "high_engagement", "medium_engagement", "low_engagement", "average_engagement_score",
        F.struct(*[F.col(f"{t.lower()}_engagement").alias(t) for t in TIERS]).alias("engagement_distribution"),
        F.when(F.col("total_hcps") > 0, F.array(*[
            F.struct(F.lit(label).alias("bucket"), F.col(f"bucket_{i}").alias("count")) for i, (label, _) in enumerate(BUCKETS)
        ])).otherwise(F.array().cast("array<struct<bucket:string,count:bigint>>")).alias("score_distribution"),
        F.struct(*[F.round(share[n] * 100, 1).alias(n) for n, _ in CHANNEL_COLS]).alias("channel_effectiveness"),
        F.struct(*[share[n].alias(n) for n, _ in CHANNEL_COLS]).alias("channel_allocation"),
        "last_updated",
    )


# --- directory ---------------------------------------------------------------------
PROFILE_COLS = [
    "hcp_id", "first_name", "last_name", "specialty", "sub_specialty", "organization_type",
    "city", "state", "country", "hcp_status", "preferred_language",
]
SCORE_COLS = [
    "historical_engagement_score", "predicted_engagement_score", "hybrid_engagement_score", "engagement_level",
    "email_probability", "website_probability", "webinar_probability", "sales_rep_probability",
    "next_best_channel", "recommended_reason",
]


def directory(profiles: DataFrame, gold: DataFrame) -> DataFrame:
    """Every profile with its scores (LEFT OUTER: profiles without scores stay)."""
    g = gold
    if "recommended_reason" not in g.columns:
        g = g.withColumn("recommended_reason", F.lit(None).cast("string"))
    return profiles.select(*PROFILE_COLS).join(g.select("hcp_id", *SCORE_COLS), "hcp_id", "left")


def search_directory(directory_df: DataFrame, query: str | None = None, skip: int = 0, limit: int = 50) -> DataFrame:
    """F7 + T3: case-insensitive substring match on first/last name, id, specialty;
    id order, offset ``skip``, at most ``limit`` rows (a page)."""
    df = directory_df
    if query:
        pat = f"%{query}%"
        cond = None
        for c in ("first_name", "last_name", "hcp_id", "specialty"):
            term = F.col(c).ilike(pat)
            cond = term if cond is None else cond | term
        df = df.where(F.coalesce(cond, F.lit(False)))
    return df.orderBy(F.col("hcp_id").asc()).offset(skip).limit(limit)


def suggest(directory_df: DataFrame, text: str, n: int = 8) -> DataFrame:
    """type-ahead: nothing below 2 characters, else the first ``n`` matches."""
    if text is None or len(text.strip()) < 2:
        return directory_df.limit(0).select("hcp_id", "first_name", "last_name", "specialty")
    return search_directory(directory_df, text.strip(), 0, n).select("hcp_id", "first_name", "last_name", "specialty")


def lookup_entity(directory_df: DataFrame, hcp_id: str) -> DataFrame:
    """F8: one entity's profile and scores; an empty frame means not found."""
    return directory_df.where(F.col("hcp_id") == F.lit(hcp_id))


def _filter_cond(channel: str = "all", level: str = "all") -> Column:
    cond = F.lit(True)
    if channel.lower() != "all":
        want = channel.lower().replace("_", "").replace(" ", "")
        cond = cond & (channel_key(F.coalesce(F.col("next_best_channel"), F.lit(""))) == F.lit(want))
    if level.lower() != "all":
        cond = cond & (F.lower(F.coalesce(F.col("engagement_level"), F.lit(""))) == F.lit(level.lower()))
    return cond


def filter_directory(rows: DataFrame, channel: str = "all", level: str = "all") -> DataFrame:
    """Next-best-channel (normalised spelling) and tier filters; 'all' passes."""
    return rows.where(_filter_cond(channel, level))


def filter_counts(rows: DataFrame, channel: str = "all", level: str = "all") -> DataFrame:
    """'Showing n of m' counts for a filter, in one aggregate."""
    return rows.agg(F.count_if(_filter_cond(channel, level)).alias("shown"), F.count(F.lit(1)).alias("total"))


# --- paging ------------------------------------------------------------------------
def key_bounds(df: DataFrame, key: str, n_buckets: int, sample_per_bucket: int = 20, seed: int = 7) -> list:
    """``n_buckets - 1`` ordered split points of ``key`` from a bounded sample
    (about ``sample_per_bucket * n_buckets`` keys reach the driver)."""
    total = df.count()
    if total == 0 or n_buckets <= 1:
        return []
    frac = min(1.0, sample_per_bucket * n_buckets / total)
    keys = [r[0] for r in df.select(key).where(F.col(key).isNotNull()).sample(False, frac, seed).orderBy(key).collect()]
    if not keys:
        return []
    step = len(keys) / n_buckets
    return sorted({keys[int(i * step)] for i in range(1, n_buckets) if int(i * step) < len(keys)})


def paginate(df: DataFrame, key: str, page: int, limit: int, n_buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows ``(page-1)*limit+1 .. page*limit`` in ``key`` order, plus the metadata row.

    Positions are global but computed without a one-partition window: each row
    gets a range bucket that is a pure function of its key (split points from a
    bounded sample), rows are numbered inside their bucket, and shifted by the
    row count of all lower buckets (a table of ``n_buckets`` rows; as many
    buckets as shuffle partitions unless given). Only the buckets that hold the
    page are numbered.
    Deep pages cost the same as the first one."""
    if page < 1 or not (1 <= limit <= 10000):
        raise ValueError("page >= 1 and 1 <= limit <= 10000")
    if n_buckets is None:
        n_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = key_bounds(df, key, n_buckets)
    if bounds:
        arr = F.array(*[F.lit(b) for b in bounds])
        bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.size(F.filter(arr, lambda b: b < F.col(key))))
    else:
        bucket = F.lit(0)
    r = df.withColumn("_b", bucket)
    order = F.col(key).asc_nulls_first()
    start, end = (page - 1) * limit, page * limit
    sizes = r.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    off = sizes.select("_b", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    holds = off.where((F.col("_off") < end) & (F.col("_off") + F.col("_n") > start)).select("_b", "_off")
    pos = r.join(holds, "_b").withColumn("_row", F.row_number().over(Window.partitionBy("_b").orderBy(order)) + F.col("_off"))
    rows = pos.where((F.col("_row") > start) & (F.col("_row") <= end)).orderBy("_row").drop("_b", "_off", "_row")
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"))
    pages = F.floor((F.col("total_records") + limit - 1) / limit).cast("bigint")
    meta = total.select(
        F.lit(page).alias("page"),
        F.lit(limit).alias("limit"),
        "total_records",
        pages.alias("total_pages"),
        (F.lit(page) < pages).alias("has_next"),
        F.lit(page > 1).alias("has_previous"),
    )
    return rows, meta


def dataset_counts(named: dict[str, DataFrame]) -> DataFrame:
    """Row count per dataset, stacked."""
    out = None
    for name, d in named.items():
        part = d.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def directory_extract(directory_df: DataFrame, n: int | None = None) -> DataFrame:
    """Report rows - id, full name, location, score as 'NN%' or 'N/A', channel
    or 'N/A'; all entities, or the first ``n`` by id if the caller asks for them.

    A zero score prints 'N/A' as in the reference (it tests truthiness)."""
    name = F.trim(F.concat(F.coalesce(F.col("first_name"), F.lit("")), F.lit(" "), F.coalesce(F.col("last_name"), F.lit(""))))
    s = F.col("hybrid_engagement_score")
    score = F.when(s.isNotNull() & (s != 0), F.format_string("%.0f%%", s)).otherwise(F.lit("N/A"))
    rows = directory_df if n is None else directory_df.orderBy(F.col("hcp_id").asc()).limit(n)
    place = F.concat_ws(", ", *[F.when(F.trim(c) != "", F.trim(c)) for c in ("city", "state", "country")])
    return rows.select(
        "hcp_id", name.alias("name"), place.alias("location"), score.alias("engagement_score"),
        F.coalesce(F.col("next_best_channel"), F.lit("N/A")).alias("next_best_channel"),
    )


def export_lowercase(df: DataFrame, run_id: int | None = None) -> DataFrame:
    """The export copy with lower-case column names (written by the caller's
    sink), and a ``run_id`` if given: appended exports are then told apart."""
    out = df.toDF(*[c.lower() for c in df.columns])
    return out if run_id is None else out.withColumn("run_id", F.lit(run_id).cast("bigint"))


def latest_run(exported: DataFrame, key: str = "hcp_id") -> DataFrame:
    """Of appended exports, each entity's row of the highest ``run_id`` (one
    aggregate with map-side combine)."""
    cols = [c for c in exported.columns if c not in (key, "run_id")]
    top = exported.groupBy(key).agg(F.max_by(F.struct(*cols), "run_id").alias("_row"))
    return top.select(key, "_row.*")
