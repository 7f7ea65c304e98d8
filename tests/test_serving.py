import datetime as dt

from pulsegrid.operators import serving as SE

GOLD = "hcp_id string, hybrid_engagement_score double, engagement_level string, email_probability double, " \
       "website_probability double, webinar_probability double, sales_rep_probability double, next_best_channel string"


def test_dashboard_buckets_and_tiers(spark):
    gold = spark.createDataFrame([
        ("a", None, "High", 0.9, 0.1, 0.0, 0.0, "Email"),
        ("b", 20.0, "Low", 0.1, 0.1, 0.0, 0.0, "Sales Rep"),
        ("c", 20.5, "Medium", None, 0.1, 0.0, 0.0, None),
        ("d", 100.0, "Unknown", 0.2, 0.1, 0.0, 0.0, "Webinar"),
    ], GOLD)
    profiles = spark.createDataFrame([(dt.datetime(2024, 1, 3),), (dt.datetime(2024, 1, 9),)], "updated_at timestamp_ntz")
    d = SE.dashboard(gold, profiles).collect()[0]
    assert (d.total_hcps, d.high_engagement, d.medium_engagement, d.low_engagement) == (4, 1, 1, 1)
    assert [(x.bucket, x["count"]) for x in d.score_distribution] == [
        ("0-20", 1), ("21-40", 1), ("41-60", 0), ("61-80", 0), ("81-100", 2)]   # NULL lands in the last bucket
    assert d.last_updated == dt.datetime(2024, 1, 9)
    alloc = d.channel_allocation
    assert abs(alloc.Email + alloc.Website + alloc.Webinar + alloc.Sales_Rep - 1.0) < 1e-12


def test_empty_dashboard(spark):
    gold = spark.createDataFrame([], GOLD)
    a = SE.dashboard_aggregates(gold).collect()[0]
    assert a.total_hcps == 0 and a.average_engagement_score == 0.0
    assert SE.dash_high_pct(gold).collect()[0][0] == 0


def test_paging_beyond_last_and_large_limit(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(25)], "k string")
    rows, meta = SE.paginate(df, "k", 3, 10, n_buckets=4)
    assert [r.k for r in rows.collect()] == [f"k{i:03d}" for i in range(20, 25)]
    m = meta.collect()[0]
    assert (m.total_records, m.total_pages, m.has_next, m.has_previous) == (25, 3, False, True)
    rows, meta = SE.paginate(df, "k", 4, 10)
    assert rows.count() == 0 and meta.collect()[0].has_next is False
    rows, _ = SE.paginate(df, "k", 1, 10000)
    assert rows.count() == 25


def test_lookup_miss_and_search(spark):
    prof = spark.createDataFrame([("1", "Ann", "Lee", "CARDIO"), ("2", "Bob", "Ray", "derm")],
                                 "hcp_id string, first_name string, last_name string, specialty string")
    for c in SE.PROFILE_COLS:
        if c not in prof.columns:
            prof = prof.withColumn(c, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("string"))
    gold = spark.createDataFrame([("1", 50.0, "High", 0.5, 0.2, 0.1, 0.1, "Email")], GOLD)
    for c in SE.SCORE_COLS:
        if c not in gold.columns:
            gold = gold.withColumn(c, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast("double"))
    d = SE.directory(prof, gold)
    assert SE.lookup_entity(d, "99").count() == 0
    got = SE.lookup_entity(d, "2").collect()[0]
    assert got.hybrid_engagement_score is None                     # profile kept without scores
    assert [r.hcp_id for r in SE.search_directory(d, "CaRd").collect()] == ["1"]
    assert SE.suggest(d, "a").count() == 0


def test_latest_run_of_appended_exports(spark):
    a = SE.export_lowercase(spark.createDataFrame([("1", 10.0), ("2", 20.0)], "HCP_ID string, Score double"), run_id=1)
    b = SE.export_lowercase(spark.createDataFrame([("1", 11.0)], "HCP_ID string, Score double"), run_id=2)
    assert sorted(tuple(r) for r in SE.latest_run(a.unionByName(b)).collect()) == [("1", 11.0), ("2", 20.0)]


def test_extract_keeps_every_entity(spark):
    prof = spark.range(12_000).selectExpr("cast(id as string) hcp_id", *[f"'x' AS {c}" for c in SE.PROFILE_COLS if c != "hcp_id"])
    scores = spark.createDataFrame([], "hcp_id string, " + ", ".join(f"{c} {'string' if c in ('engagement_level', 'next_best_channel', 'recommended_reason') else 'double'}" for c in SE.SCORE_COLS))
    d = SE.directory(prof, scores)
    assert SE.directory_extract(d).count() == 12_000 and SE.directory_extract(d, 5).count() == 5
