"""Substring search over the directory through posting lists.

The index holds, for each gram (two or three characters of a lower-cased
searchable value) and block of the directory (see ``sources.blocks``), the
ascending places of the rows that hold it. A list is cut at blocks, so the list
of a gram that a third of all rows share is dealt over blocks and no task holds
more than a block of it. A search reads the lists of the grams of its pattern,
intersects them block by block, and verifies the rows left with the pattern
itself: the result equals that of a scan.

Patterns as in ``ILIKE '%text%'``: ``%`` and ``_`` in the text are wildcards and
a backslash escapes. Grams are taken from the runs between wildcards. A text
whose runs are all of one character (or a text without any run) names no gram;
such a search reads all blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources import blocks as B

#: The columns that a search looks at.
SEARCHED = ("first_name", "last_name", "hcp_id", "specialty")
SIZES = (2, 3)


@dataclass(frozen=True)
class SearchIndex:
    table: B.BlockTable
    postings: DataFrame
    fields: tuple[str, ...] = SEARCHED
    block_bits: int = B.BLOCK_BITS


def _gram_rows(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(gram, row): the distinct grams of each row's searchable values."""
    def of_size(value, n: int):
        starts = F.sequence(F.lit(1), F.length(value) - (n - 1))
        cut = F.transform(starts, lambda i: F.substring(value, i, F.lit(n)))
        return F.when(F.length(value) >= n, cut).otherwise(F.array().cast("array<string>"))

    def grams(value):
        return F.concat(*[of_size(value, n) for n in SIZES])

    values = [F.coalesce(grams(F.lower(F.col(c).cast("string"))), F.array().cast("array<string>")) for c in fields]
    return rows.select(B.ROW, F.explode(F.array_distinct(F.concat(*values))).alias("gram"))


def write_index(table: B.BlockTable, path: str, fields: tuple[str, ...] = SEARCHED, block_bits: int = B.BLOCK_BITS) -> SearchIndex:
    """Write the posting lists of a block table to ``path`` (a new folder), sorted
    by gram, so that reading a gram skips the files and row groups of others."""
    spark = table.rows.sparkSession
    place = (F.col(B.ROW) % (1 << block_bits)).cast("int")
    lists = (
        _gram_rows(table.rows, fields)
        .groupBy("gram", F.shiftright(B.ROW, block_bits).alias(B.BLOCK))
        .agg(F.array_sort(F.collect_list(place)).alias("places"))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = lists.repartitionByRange(parts, "gram", B.BLOCK).sortWithinPartitions("gram", B.BLOCK)
    spread.write.option("parquet.bloom.filter.enabled#gram", "true").option("parquet.block.size", 8 << 20).parquet(path)
    return open_index(spark, table, path, fields, block_bits)


def open_index(spark: SparkSession, table: B.BlockTable, path: str, fields: tuple[str, ...] = SEARCHED, block_bits: int = B.BLOCK_BITS) -> SearchIndex:
    return SearchIndex(table, spark.read.parquet(path), fields, block_bits)


def pattern_grams(text: str) -> list[str]:
    """The grams that every match of ``%text%`` holds: those of three characters,
    of two where a run has no more; none for runs of one character."""
    runs, run, escaped = [], "", False
    for ch in text.lower():
        if escaped:
            run, escaped = run + ch, False
        elif ch == "\\":
            escaped = True
        elif ch in "%_":
            runs, run = [*runs, run], ""
        else:
            run += ch
    found: dict[str, None] = {}
    for r in [*runs, run]:
        n = min(len(r), max(SIZES))
        if n >= min(SIZES):
            found.update((r[i : i + n], None) for i in range(len(r) - n + 1))
    return list(found)


def candidates(index: SearchIndex, text: str) -> DataFrame | None:
    """(``_row``): rows that hold every gram of the text; None if it names none."""
    grams = pattern_grams(text)
    if not grams:
        return None
    lists = index.postings.where(F.col("gram").isin(grams)).groupBy(B.BLOCK).agg(F.collect_list("places").alias("lists"))
    whole = lists.where(F.size("lists") == len(grams))  # a list per gram, each at most a block long
    both = F.aggregate(F.slice("lists", 2, len(grams)), F.element_at("lists", 1), lambda a, b: F.array_intersect(a, b))
    placed = whole.select(B.BLOCK, F.explode(both).alias("place"))
    return placed.select((F.shiftleft(B.BLOCK, index.block_bits) + F.col("place")).alias(B.ROW))


def matches(index: SearchIndex, text: str) -> DataFrame:
    """The matching rows, with ``_row`` and ``_block``, in no order."""
    rows, found = index.table.rows, candidates(index, text)
    if found is not None:
        rows = rows.join(found, B.ROW, "left_semi")
    return rows.where(B.any_of([F.col(c).ilike(f"%{text}%") for c in index.fields]))


def search(index: SearchIndex, text: str | None, skip: int = 0, limit: int = 50) -> DataFrame:
    """Rows skip+1 .. skip+limit of the matches in key order; every row matches a
    null or empty text (its page is read from the block counts alone)."""
    if not text:
        return B.page_of(index.table, skip, limit)
    found = matches(index, text)
    return B.page(found, found.groupBy(B.BLOCK).agg(F.count(F.lit(1)).alias("_n")), skip, limit)


def suggest(index: SearchIndex, text: str | None, n: int = 8) -> DataFrame:
    """The first ``n`` matches of a typed text; none below two characters."""
    shown = ["hcp_id", "first_name", "last_name", "specialty"]
    if text is None or len(text.strip()) < 2:
        return index.table.rows.limit(0).select(*shown)
    return search(index, text.strip(), 0, n).select(*shown)
