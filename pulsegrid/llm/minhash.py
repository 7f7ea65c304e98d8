"""MinHash near-duplicate detection with tensored banding.

Two small collections of ``side`` sub-signatures (``width`` minhashes each)
are computed per distinct shingle set; the ``side * side`` table keys are all
pairs of one sub-signature from either collection. 2 * side * width minhashes
so serve side**2 tables. A link at Jaccard s is a candidate with probability
(1 - (1 - s**width)**side)**2: 0.9999 at 0.85 for side 8, width 2.

Documents with equal shingle sets collapse first (128-bit fingerprint and
size), so groups of copies never reach the tables. Only what joins components
is compared, never all pairs of a bucket:

1. every member of a shared bucket with one hub: of the smallest and largest
   members of its buckets, the one it shares most buckets with;
2. a few rounds in which every component tries its best pair with a hub of
   another component;
3. all bucket members that are still in different components: pair by pair in
   buckets of at most ``SMALL`` members; those of larger buckets in tiles, where
   two blocks of texts meet in one task, all intersections are products of
   0/1 matrices, and only edges that join components come out.

So each bucket is resolved completely. Links are confirmed on the full shingle
sets of the texts.

Null text, empty text and text of white space only: no shingles, no links.
A null id takes no part and keeps a null component. Rows that repeat an id
give one output row each, judged by the row's own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, mix, saved, saved_counted, shingle_hashes, string_views, word_hashes
from pulsegrid.llm.graph import components, extended, lowest

#: Rows of text handled at once in a task, in bytes.
BATCH_BYTES = 1 << 22
#: Members of a bucket that is compared pair by pair, and texts in a block of a tile.
SMALL, BLOCK = 32, 128


def _distinct(words: np.ndarray, k: int) -> np.ndarray:
    return np.unique(shingle_hashes(words, k))


def _signer(k: int, side: int, width: int):
    n_hash = 2 * side * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, 2 * n_hash + 1, dtype=np.uint64))
        mul, add = seeds[:n_hash, None] | np.uint64(1), seeds[n_hash:, None]
        shift = np.uint64(29)
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            words, bounds = word_hashes(*string_views(batch.column(1)))
            rows = batch.num_rows
            size = np.zeros(rows, np.int64)
            prints = np.zeros((rows, 2), np.uint64)
            subs = np.zeros((rows, 2 * side), np.uint64)
            for i in range(rows):
                s = _distinct(words[bounds[i] : bounds[i + 1]], k)
                size[i] = len(s)
                if not len(s):
                    continue
                prints[i] = s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)
                low = np.full(n_hash, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 4096):
                    h = s[None, at : at + 4096] * mul + add
                    np.minimum(low, (h ^ (h >> shift)).min(axis=1), out=low)
                low = low.reshape(2 * side, width)
                sub = low[:, 0]
                for j in range(1, width):
                    sub = mix(sub) + low[:, j]
                subs[i] = mix(sub)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(size),
                    pa.array(prints[:, 0].view(np.int64)),
                    pa.array(prints[:, 1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * 2 * side), pa.array(subs.view(np.int64).ravel())),
                ],
                names=["id", "n", "f1", "f2", "sub"],
            )

    return run


def _sets(column: pa.Array, k: int) -> list[np.ndarray]:
    words, bounds = word_hashes(*string_views(column))
    return [_distinct(words[bounds[i] : bounds[i + 1]], k) for i in range(len(column))]


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1
    matrices over slices of the values that occur more than once."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]
    kept = column >= 0
    owner, column = owner[kept], column[kept]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)))
    for at in range(0, int((count > 1).sum()), 4096):
        a, b = np.searchsorted(column, (at, at + 4096))
        m = np.zeros((len(sets), 4096), np.float32)
        m[owner[a:b], column[a:b] - at] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out


def _tile(k: int, part: int, whole: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        sets = _sets(group.column("t").combine_chunks(), k)
        blk, ti, tj = group.column("blk").to_numpy(), group.column("ti")[0].as_py(), group.column("tj")[0].as_py()
        names, comp = np.unique(group.column("c").to_numpy(), return_inverse=True)
        left, right = np.flatnonzero(blk == ti), np.flatnonzero(blk == tj)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        n = np.array([len(s) for s in sets], float)
        common = overlaps([sets[i] for i in left], [sets[i] for i in right])
        linked = (whole + part) * common >= part * (n[left][:, None] + n[right][None, :])
        i, j = np.nonzero(linked & (comp[left][:, None] != comp[right][None, :]))
        low = lowest(comp[left[i]], comp[right[j]], len(names))
        moved = np.flatnonzero(low != np.arange(len(names)))
        return pa.table({"a": pa.array(names[moved], pa.int64()), "b": pa.array(names[low[moved]], pa.int64())})

    return run


def _verifier(k: int, part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2, BATCH_BYTES // 2):
            left = _sets(batch.column(2), k)
            right = _sets(batch.column(3), k)
            keep = []
            for x, y in zip(left, right):
                small, large = sorted((len(x), len(y)))
                common = len(np.intersect1d(x, y, assume_unique=True)) if whole * small >= part * large else 0
                keep.append(bool(common) and whole * common >= part * (small + large - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    at_least: tuple[int, int] = (80, 100),
    side: int = 8,
    width: int = 2,
    rounds: int = 2,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if intersection / union of their sets of
    ``k``-word shingles is at least ``at_least[0] / at_least[1]``;
    component_id is the smallest id reachable over links, kept marks it.
    ``rounds``: hub rounds (step 2 above) before the exact rest."""
    part, whole = at_least
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    sig = saved(
        texts.mapInArrow(_signer(k, side, width), "id long, n long, f1 long, f2 long, sub array<long>"), "minhash-sig"
    )
    named = sig.where("n > 0 AND id IS NOT NULL")
    reps = saved(named.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"), F.first("sub").alias("sub")), "minhash-reps")
    keys = F.expr(
        f"flatten(transform(slice(sub, 1, {side}), (x, i) -> transform(slice(sub, {side + 1}, {side}), (y, j) -> xxhash64(i, j, x, y))))"
    )
    rows = reps.select("rep", "n", F.explode(keys).alias("key"))
    ends = rows.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    crowd = saved(rows.join(ends, "key").select("key", "rep", "n", "lo", "hi"), "minhash-crowd")
    member_texts = saved(texts.join(crowd.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), "minhash-texts")
    stars = saved(
        crowd.where("rep > lo").select("rep", F.col("lo").alias("hub"))
        .unionByName(crowd.where("rep > lo AND rep < hi").select("rep", F.col("hi").alias("hub")))
        .groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("shared")),
        "minhash-stars",
    )

    def links(pairs: DataFrame) -> tuple[DataFrame, int]:
        """The linked ones of distinct pairs (a, b), and their number."""
        left = member_texts.select(F.col("id").alias("a"), F.col("t").alias("ta"))
        right = member_texts.select(F.col("id").alias("b"), F.col("t").alias("tb"))
        full = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
        found, seen = saved_counted(full.mapInArrow(_verifier(k, part, whole), "a long, b long"), "minhash-links", n=F.count(F.lit(1)))
        return found, seen["n"]

    tested = saved(stars.groupBy("rep").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub")).select(F.col("rep").alias("a"), F.col("hub").alias("b")), "minhash-pairs")
    comp = components(links(tested)[0])
    for _ in range(rounds):
        of = comp.select(F.col("node"), "comp")
        rest = (
            stars.join(of.toDF("rep", "ca"), "rep", "left").join(of.toDF("hub", "cb"), "hub", "left")
            .select(F.col("rep").alias("a"), F.col("hub").alias("b"), "shared", F.coalesce("ca", "rep").alias("ca"), F.coalesce("cb", "hub").alias("cb"))
            .where("ca <> cb").join(tested, ["a", "b"], "left_anti")
        )
        sides = rest.select("a", "b", "shared", F.explode(F.array("ca", "cb")).alias("c"))
        best = sides.groupBy("c").agg(F.max_by(F.struct("a", "b"), F.struct("shared", "a", "b")).alias("p"))
        pairs = saved(best.select("p.a", "p.b").distinct(), "minhash-pairs")
        more, n_more = links(pairs)
        tested = tested.unionByName(pairs)
        if not n_more:
            break
        comp = extended(comp, more)

    held = crowd.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", "lo", "rep", F.coalesce("comp", "rep").alias("c"))
    sizes = held.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    tops = sizes.groupBy("key").agg(F.max_by("c", F.struct("m", "c")).alias("top"), F.sum("m").alias("all"), F.max("m").alias("most")).where("most < all")
    held, seen = saved_counted(held.join(tops, "key"), "minhash-open", few=F.count_if(F.col("all") <= small), many=F.count_if(F.col("all") > small))
    edges = []
    if seen["few"]:
        pairs = saved(_open_pairs(held.where(F.col("all") <= small)).join(tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti"), "minhash-pairs")
        edges.append(links(pairs)[0])
    if seen["many"]:
        edges.append(_tiled(held.where(F.col("all") > small), member_texts, k, part, whole, block))
    return _result(sig, reps, extended(comp, reduce(DataFrame.unionByName, edges)) if edges else comp)


def _open_pairs(few: DataFrame) -> DataFrame:
    """Distinct pairs (a > b) of members of a bucket that are in different components."""
    other = few.select("key", F.col("rep").alias("rep2"), F.col("c").alias("c2"))
    met = few.where("c <> top").select("key", "rep", "c").join(other, "key").where("c <> c2")
    return met.select(F.greatest("rep", "rep2").alias("a"), F.least("rep", "rep2").alias("b")).distinct()


def _tiled(many: DataFrame, member_texts: DataFrame, k: int, part: int, whole: int, block: int) -> DataFrame:
    """Edges that join components among the members of large buckets, block against block."""
    cluster = components(many.where("rep <> lo").select(F.col("rep").alias("a"), F.col("lo").alias("b"))).toDF("rep", "cluster")
    placed = many.select("rep", "c").distinct().join(cluster, "rep")
    blocks = placed.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("nb"))
    placed = placed.join(blocks, "cluster").withColumn("blk", F.expr("cast(pmod(xxhash64(rep), nb) AS int)"))
    placed = placed.withColumn("near", F.explode(F.expr("sequence(0, nb - 1)")))
    placed = placed.select("cluster", "rep", "c", "blk", F.least("blk", "near").alias("ti"), F.greatest("blk", "near").alias("tj"))
    met = placed.join(member_texts.withColumnRenamed("id", "rep"), "rep").groupBy("cluster", "ti", "tj").applyInArrow(_tile(k, part, whole), "a long, b long")
    return saved(met, "minhash-tiles")


def _result(sig: DataFrame, reps: DataFrame, comp: DataFrame) -> DataFrame:
    where = reps.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("n", "f1", "f2", F.coalesce("comp", "rep").alias("component_id"))
    full = sig.select("id", "n", "f1", "f2").join(where, ["n", "f1", "f2"], "left")
    return full.select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id"))).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)))
