import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import search_index as SI
from pulsegrid.operators import serving as SE
from pulsegrid.sources import blocks as B

NAMES = ["Ann", "Bob", "ANNA", "", None, "Zoë", "İnci", "a_b", "50%", "x"]
SCHEMA = "hcp_id string, first_name string, last_name string, specialty string, level string"


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    r = random.Random(5)
    rows = [(f"id{i:05d}", r.choice(NAMES), r.choice(["Lee", "Leeds", "van Leer", None]), r.choice(["Cardiology", "derm", None]), "high" if i % 97 == 0 else "low")
            for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = str(tmp_path_factory.mktemp("blocks"))
    table = B.write_blocks(df, f"{path}/t", "hcp_id", facets=["level"], parts=4, block_bits=6, row_group_bytes=1 << 14)
    return df, table, SI.write_index(table, f"{path}/grams", block_bits=6)


def same(a, b):
    return [tuple(x) for x in a.collect()] == [tuple(x) for x in b.collect()]


def test_blocks_are_bounded_and_keep_every_row(people):
    df, table, _ = people
    assert table.counts.groupBy("_block").agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] <= 64
    assert table.rows.count() == 3000 and table.counts.agg(F.sum("_n")).first()[0] == 3000
    assert same(table.rows.orderBy("_row").select(*df.columns), df.orderBy("hcp_id"))


def test_pages_equal_a_sort_and_deep_ones_read_no_more(people):
    df, table, _ = people
    for skip, limit in ((0, 50), (50, 50), (2990, 50), (3000, 50), (9999, 5), (0, 3000)):
        assert same(B.page_of(table, skip, limit), df.orderBy("hcp_id").offset(skip).limit(limit)), skip
    for where in (F.col("level") == "high", F.col("level") == "none"):
        assert same(B.page_of(table, 7, 20, where), df.where(where).orderBy("hcp_id").offset(7).limit(20))
    first, deep = (B.holding(table.counts, skip, 50) for skip in (0, 2900))
    assert max(len(first), len(deep)) <= 2
    plan = B.page_of(table, 2900, 50)._jdf.queryExecution().toString()
    assert "GlobalLimit" not in plan and "TakeOrdered" not in plan and "In(_block" in plan
    m = B.page_meta(table, 3, 1000).first()
    assert (m.total_records, m.total_pages, m.has_next, m.has_previous) == (3000, 3, False, True)
    assert B.page_meta(table, 1, 10, F.col("level") == "high").first().total_records == 31


def test_a_shared_key_is_split_and_null_keys_come_first(spark, tmp_path):
    df = spark.range(2000).select(F.when(F.col("id") < 700, "same").when(F.col("id") < 705, None).otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id")
    table = B.write_blocks(df, str(tmp_path / "t"), "k", parts=4, block_bits=5)
    got = table.rows.orderBy("_row").collect()
    assert [x.k for x in got] == sorted((x.k for x in df.collect()), key=lambda v: (v is not None, v or ""))
    assert table.rows.where("k = 'same'").select(F.shiftright("_row", 33)).distinct().count() > 1
    seen = [x.id for skip in range(0, 2000, 250) for x in B.page_of(table, skip, 250).collect()]
    assert sorted(seen) == list(range(2000))


def test_empty_table_and_bad_arguments(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    table = B.write_blocks(empty, str(tmp_path / "t"), "hcp_id")
    index = SI.write_index(table, str(tmp_path / "g"))
    assert B.page_of(table, 0, 10).count() == 0 and SI.search(index, "ann").count() == 0
    assert B.page_meta(table, 1, 10).first().total_pages == 0
    for skip, limit in ((-1, 10), (0, 0), (0, 10_001)):
        with pytest.raises(ValueError):
            B.page_of(table, skip, limit)
    with pytest.raises(ValueError):
        B.write_blocks(empty.withColumnRenamed("level", "_row"), str(tmp_path / "u"), "hcp_id")


def test_a_point_lookup_reads_one_row_group(spark, tmp_path):
    df = spark.range(60_000).select(F.format_string("%08d", F.col("id") * 7919 % 60_000).alias("hcp_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = B.write_blocks(df, str(tmp_path / "t"), "hcp_id", parts=4, row_group_bytes=1 << 18)
    assert table.rows.count() == 60_000
    for key, n in (("00041234", 1), ("absent", 0)):
        found = B.lookup(table, key)
        assert len(found.collect()) == n
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        read = leaves.apply(0).metrics().apply("numOutputRows").value()
        assert read <= 7_500, (key, read)  # a file holds 15,000 rows in several row groups


@pytest.mark.parametrize("text", ["ann", "AN", "lee", "leed", "zoë", "a_b", "a\\_b", "50\\%", "n%a", "x", "_", "%", "id000", "an lee", "nothing", "i̇nci", "card", "ee"])
def test_search_equals_the_scan(people, text):
    df, _, index = people
    want = df.where(B.any_of([F.col(c).ilike(f"%{text}%") for c in SI.SEARCHED])).orderBy("hcp_id")
    assert same(SI.search(index, text, 0, 5000), want)
    assert same(SI.search(index, text, 40, 9), want.offset(40).limit(9))


def test_grams_and_suggestions(people):
    df, table, index = people
    assert SI.pattern_grams("Furn") == ["fur", "urn"] and SI.pattern_grams("bu") == ["bu"]
    assert SI.pattern_grams("a%bcd_ef") == ["bcd", "ef"] and SI.pattern_grams("a%b") == [] and SI.pattern_grams("") == []
    assert SI.suggest(index, " a").count() == 0 and SI.suggest(index, None).count() == 0
    assert [x.hcp_id for x in SI.suggest(index, " lee ").collect()] == [x.hcp_id for x in df.where("last_name ILIKE '%lee%'").orderBy("hcp_id").limit(8).collect()]
    assert same(SI.search(index, None, 10, 5), df.orderBy("hcp_id").offset(10).limit(5))
