"""Pane states against aggregates over copied rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import panes as PN

DAY = dt.date(2024, 3, 1)


def log(spark, n=600, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        at = dt.datetime(2024, 2, 1) + dt.timedelta(days=r.randint(0, 60), hours=r.choice([0, 0, 5, 23]), microseconds=r.choice([0, 0, 1, 999_999]))
        rows.append((r.choice(["a", "b", "hot", "hot", None]), at, r.choice([None, "desktop", "mobile", "tablet"]), f"s{r.randrange(40)}" if r.random() < 0.9 else None, r.choice([None, 1.25, 2.5])))
    rows.append(("alone", dt.datetime(2024, 3, 1), None, None, None))
    return spark.createDataFrame(rows, "hcp_id string, ts timestamp_ntz, device_type string, session_id string, v double")


def measures():
    return [
        PN.count("n", F.lit(True)),
        PN.count("desktops", F.col("device_type") == "desktop"),
        PN.distinct("devices", "device_type"),
        PN.distinct("sessions", "session_id"),
        PN.total("total", "v"),
        PN.mean("mean", "v"),
        PN.greatest("last", F.col("ts")),
    ]


def plain(df, windows, closed_left, closed_right):
    """One filter per date over all rows."""
    out = []
    for d, (lo, _), (hi, _) in windows.spans:
        t, a, b = F.col("ts"), F.lit(str(lo)).cast("timestamp_ntz"), F.lit(str(hi)).cast("timestamp_ntz")
        rows = df.where(((t >= a) if closed_left else (t > a)) & ((t <= b) if closed_right else (t < b)))
        g = rows.groupBy("hcp_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("device_type") == "desktop").alias("desktops"), F.count_distinct("device_type").alias("devices"),
            F.count_distinct("session_id").alias("sessions"), F.sum("v").alias("total"), F.avg("v").alias("mean"), F.max("ts").alias("last"), F.count_distinct(F.to_date("ts")).alias("days"),
        )
        out += [(r.hcp_id, d, *r[1:]) for r in g.collect()]
    return sorted(out, key=str)


@pytest.mark.parametrize("days,step,n,kind", [(10, 3, 5, "closed"), (60, 1, 3, "half_open"), (2, 7, 4, "label_open"), (7, 1, 45, "label_closed")])
def test_window_aggregates_match_plain_filters(spark, days, step, n, kind):
    dates = [DAY + dt.timedelta(days=step * i - 20) for i in range(n)]
    windows, ends = {
        "closed": (PN.Windows.history(dates, days, True), (True, True)),
        "half_open": (PN.Windows.history(dates, days, False), (True, False)),
        "label_open": (PN.Windows.label(dates, days, True), (False, True)),
        "label_closed": (PN.Windows.label(dates, days, False), (True, False)),
    }[kind]
    df = log(spark)
    got = PN.window_aggregates(df, "hcp_id", "ts", windows, [*measures(), PN.active_days("days", "ts", windows)])
    assert sorted([tuple(r) for r in got.collect()], key=str) == plain(df, windows, *ends)


def test_many_panes_take_several_words(spark):
    windows = PN.Windows.history([DAY + dt.timedelta(days=i) for i in range(90)], 200, True)
    assert windows.words() == 3
    df = log(spark, 200)
    got = PN.window_aggregates(df, "hcp_id", "ts", windows, [PN.distinct("sessions", "session_id")]).where(F.col("snapshot_date") == F.lit(DAY))
    want = df.where(F.col("ts") <= F.lit(str(DAY)).cast("timestamp_ntz")).groupBy("hcp_id").agg(F.count_distinct("session_id").alias("sessions"))
    assert {(r.hcp_id, r.sessions) for r in got.collect()} == {(r.hcp_id, r.sessions) for r in want.collect()}


def test_window_flags(spark):
    rows = [("a", dt.datetime(2024, 3, 2), "x"), ("a", dt.datetime(2024, 3, 9), "y"), ("b", dt.datetime(2024, 3, 1), "x"), ("c", dt.datetime(2024, 5, 1), "x")]
    df = spark.createDataFrame(rows, "hcp_id string, ts timestamp_ntz, tag string")
    windows = PN.Windows.label([DAY, DAY + dt.timedelta(days=4)], 5, True)
    got = PN.window_flags(df, "hcp_id", "ts", windows, "tag", ["x", "y"])
    assert sorted(tuple(r) for r in got.collect()) == [("a", DAY, 1, 0), ("a", DAY + dt.timedelta(days=4), 0, 1)]


def test_no_log_row_is_copied_per_window(spark, tmp_path):
    """Rows are folded before dates come in, and no distinct count expands them."""
    log(spark).write.parquet(str(tmp_path / "log"))
    df = spark.read.parquet(str(tmp_path / "log"))
    windows = PN.Windows.history([DAY + dt.timedelta(days=2 * i) for i in range(9)], 60, True)
    plan = PN.window_aggregates(df, "hcp_id", "ts", windows, [*measures(), PN.distinct("sessions2", "device_type")])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert "GreaterThanOrEqual(ts" in plan
    for chain in plan.split("Scan parquet")[:-1]:  # between the final aggregate and a scan: aggregate above, dates after the fold
        assert chain.rfind("Generate") < chain.rfind("HashAggregate")


def test_windows_without_rows(spark):
    df = log(spark, 20).where("hcp_id = 'nobody'")
    windows = PN.Windows.history([DAY], 5, True)
    assert PN.window_aggregates(df, "hcp_id", "ts", windows, measures()).count() == 0
    assert PN.window_flags(df.withColumn("tag", F.lit("x")), "hcp_id", "ts", windows, "tag", ["x"]).count() == 0


def test_nothing_copied_per_date_is_shuffled(spark, tmp_path):
    log(spark).write.parquet(str(tmp_path / "log"))
    windows = PN.Windows.history([DAY + dt.timedelta(days=2 * i) for i in range(9)], 60, True)
    plan = PN.window_aggregates(spark.read.parquet(str(tmp_path / "log")), "hcp_id", "ts", windows, measures())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")  # top down: dates come in after the last shuffle


@pytest.mark.parametrize("spans", [
    [(dt.date.min, False, DAY, False), (dt.date.min, False, DAY + dt.timedelta(days=2), True)],
    [(DAY, True, DAY + dt.timedelta(days=900), False), (DAY + dt.timedelta(days=65), False, DAY + dt.timedelta(days=66), True)],
])
def test_panes_of_windows_with_far_borders(spark, spans):
    windows = PN.Windows(tuple((lo if lo != dt.date.min else hi, (lo, a), (hi, b)) for lo, a, hi, b in spans))
    shown = windows.pane_of("ts")._jc.toString()
    assert len(shown) < 20_000  # one entry a day since the year 1 took minutes to plan
    far = [dt.datetime(1, 1, 1), dt.datetime(1971, 5, 5, 3), dt.datetime(2026, 8, 17), dt.datetime(2026, 8, 18), dt.datetime(2026, 8, 18, 1), dt.datetime(9999, 1, 1)]
    near = [dt.datetime(2024, 2, 27) + dt.timedelta(hours=12 * i) for i in range(200)] + [dt.datetime(2024, 3, 1, 0, 0, 0, 1)]
    rows = spark.createDataFrame([(t,) for t in [*far, *near, None]], "ts timestamp_ntz")

    def mark(d, after):  # sorts before or after the rows of its instant
        return dt.datetime(d.year, d.month, d.day), int(after)

    borders = [mark(*b) for b in windows.borders()]
    used = {i for r in windows.panes().values() for i in r}
    for t, pane in rows.select("ts", windows.pane_of("ts")).collect():
        want = None
        if t is not None:
            at = sum(b <= (t, 0) for b in borders) - 1
            want = at if at in used else None
        assert pane == want, t


def test_parts_meet_without_another_shuffle_of_the_dates(spark):
    dates = [DAY + dt.timedelta(days=3 * i) for i in range(4)]
    windows = PN.Windows.history(dates, 10, True)
    df = log(spark)
    entities = df.select("hcp_id").where(F.col("hcp_id").isNotNull()).union(spark.createDataFrame([("idle",)], "hcp_id string")).distinct()
    rows = entities.select("hcp_id", F.explode(windows.dates()).alias("snapshot_date"))
    parts = [PN.window_aggregates(df, "hcp_id", "ts", windows, measures()), PN.window_flags(df, "hcp_id", "ts", windows, "device_type", ["desktop", "tablet"])]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        want, got = rows, rows
        for p in parts:
            want, got = want.join(p, ["hcp_id", "snapshot_date"], "left"), PN.meet(got, p)
        plan = got._jdf.queryExecution().executedPlan().toString()
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert shuffles and not any("snapshot_date" in x for x in shuffles)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
