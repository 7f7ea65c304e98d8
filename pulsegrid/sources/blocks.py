"""Tables written in blocks: range-sorted files that point reads can skip, and
row counts per block, so that a page of any depth is read where it lies.

A block is at most ``2 ** BLOCK_BITS`` rows next to each other in the order of
the key; ``_row`` numbers the rows in that order (block number in the upper
bits, place in the block in the lower ones, with gaps between blocks). Files
are sorted by the key with a Bloom filter on it. Rows with a null key come
first. Rows of one key follow each other in the order of a hash of the whole
row, so a key that many rows share is split over blocks and tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a block: 32,768.
BLOCK_BITS = 15
ROW, BLOCK = "_row", "_block"
#: Row number of a page's last row at most; more blocks than rows cannot hold a page.
MAX_LIMIT = 10_000


@dataclass(frozen=True)
class BlockTable:
    """The rows of a written table (with ``_row`` and ``_block``) and its counts
    per block and value of the facet columns (``_block``, facets, ``_n``)."""

    key: str
    rows: DataFrame
    counts: DataFrame

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in (ROW, BLOCK)]


def write_blocks(df: DataFrame, path: str, key: str, facets: list[str] | None = None, parts: int | None = None,
                 block_bits: int = BLOCK_BITS, row_group_bytes: int = 8 << 20) -> BlockTable:
    """Write ``df`` in blocks to ``path`` (a new folder) and count its rows.

    ``facets``: columns of few values whose counts are kept per block, so that
    pages filtered by them are found from the counts alone. One range shuffle;
    the counts read the written ``_block`` and facet columns only.
    """
    clash = {ROW, BLOCK} & set(df.columns)
    if clash:
        raise ValueError(f"columns of these names are taken: {sorted(clash)}")
    spark, path = df.sparkSession, path.rstrip("/")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = df.withColumn("_tie", tie).repartitionByRange(parts, F.col(key).asc_nulls_first(), "_tie")
    placed = ranged.sortWithinPartitions(F.col(key).asc_nulls_first(), "_tie").drop("_tie")
    # ids of a sorted partition: its number in the upper bits, then rows counted from 0
    numbered = placed.withColumn(ROW, F.monotonically_increasing_id()).withColumn(BLOCK, F.shiftright(ROW, block_bits))
    writer = numbered.write.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", row_group_bytes)
    writer.parquet(f"{path}/rows")
    rows = spark.read.schema(numbered.schema).parquet(f"{path}/rows")
    counts = rows.groupBy(BLOCK, *(facets or [])).agg(F.count(F.lit(1)).alias("_n"))
    counts.write.parquet(f"{path}/counts")
    return open_blocks(spark, path, key)


def open_blocks(spark: SparkSession, path: str, key: str) -> BlockTable:
    path = path.rstrip("/")
    return BlockTable(key, spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/counts"))


def holding(counts: DataFrame, skip: int, limit: int) -> list:
    """(block, rows before it) of the blocks that hold rows skip+1 .. skip+limit,
    given the rows per block (``_block``, ``_n``).

    Blocks are summed in spans of 4,096 first, so each window sees one row a
    span, then the blocks of the spans that hold the page. At most ``limit``
    rows reach the driver: every block among them holds a row of the page.
    """
    per = counts.where("_n > 0").groupBy(BLOCK).agg(F.sum("_n").alias("_n")).withColumn("_span", F.shiftright(BLOCK, 12))

    def spread(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("_before", F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    page = (F.col("_before") < skip + limit) & (F.col("_before") + F.col("_n") > skip)
    spans = spread(per.groupBy("_span").agg(F.sum("_n").alias("_n")), Window.orderBy("_span")).where(page)
    inner = spread(per.join(spans.select("_span", F.col("_before").alias("_base")), "_span"), Window.partitionBy("_span").orderBy(BLOCK))
    inner = inner.withColumn("_before", F.col("_before") + F.col("_base"))
    return inner.where(page).select(BLOCK, "_before").orderBy(BLOCK).collect()


def page(rows: DataFrame, counts: DataFrame, skip: int, limit: int) -> DataFrame:
    """Rows skip+1 .. skip+limit in key order, without ``_row`` and ``_block``.

    ``rows`` must hold exactly the rows that ``counts`` counts. Only the
    blocks of the page are read, whatever ``skip`` is; rows are numbered inside
    their block."""
    if skip < 0 or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"skip >= 0 and 1 <= limit <= {MAX_LIMIT}")
    blocks = holding(counts, skip, limit)
    names = [c for c in rows.columns if c not in (ROW, BLOCK)]
    if not blocks:
        return rows.limit(0).select(*names)
    before = rows.sparkSession.createDataFrame([tuple(b) for b in blocks], f"{BLOCK} long, _before long")
    near = rows.where(F.col(BLOCK).isin([b[0] for b in blocks])).join(before, BLOCK)
    at = F.row_number().over(Window.partitionBy(BLOCK).orderBy(ROW)) + F.col("_before")
    found = near.withColumn("_at", at).where((F.col("_at") > skip) & (F.col("_at") <= skip + limit))
    return found.orderBy("_at").select(*names)


def page_of(table: BlockTable, skip: int, limit: int, where: Column | None = None) -> DataFrame:
    """A page of a block table, of the rows that pass ``where`` if given. A filter
    that uses facet columns only is also answered by the counts alone."""
    if where is None:
        return page(table.rows, table.counts, skip, limit)
    return page(table.rows.where(where), table.counts.where(where), skip, limit)


def page_meta(table: BlockTable, number: int, limit: int, where: Column | None = None) -> DataFrame:
    """The paging row of page ``number`` from the counts alone."""
    counts = table.counts if where is None else table.counts.where(where)
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"))
    pages = F.floor((F.col("total_records") + limit - 1) / limit).cast("bigint")
    return total.select(
        F.lit(number).alias("page"), F.lit(limit).alias("limit"), "total_records", pages.alias("total_pages"),
        (F.lit(number) < pages).alias("has_next"), F.lit(number > 1).alias("has_previous"),
    )


def lookup(table: BlockTable, value) -> DataFrame:
    """The rows of one key: Parquet bounds and Bloom filters leave the row groups that hold it."""
    return table.rows.where(F.col(table.key) == F.lit(value)).select(*table.columns)


def any_of(conditions: list[Column]) -> Column:
    """True where one of the conditions is; null counts as false."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions]), F.lit(False))
