"""Near-duplicate vectors by int8 tile products with error bounds.

Vectors of one label (and dimension) are dealt into blocks by a hash of their
id; every pair of blocks is a tile, multiplied in its own task. Unit vectors
are quantised to int8 with one scale each. With u = q / s + e for the code q,
scale s and residual e, Cauchy-Schwarz gives

    |u . v - (q_u / s_u) . (q_v / s_v)| <= |q_u / s_u| |e_v| + |e_u| |v|

so a pair whose bound interval lies on one side of the threshold is decided
by the integer product; only the others are multiplied in double precision.

Equal vectors of a label collapse first and count by multiplicity. A tile
returns link counts and, for connectivity, one edge per vector to the smallest
member of its component inside the tile: no list of pairs ever leaves it.

Rows with a null label or id, a null or empty vector, null or non-finite
components, or zero length link with nothing. Vectors of different dimension
are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import saved
from pulsegrid.llm.graph import components, lowest

#: Vectors in a block, on average; a tile holds two blocks.
BLOCK = 2048
#: Room for the rounding of the double products themselves.
SLACK = 1e-9


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of the coded vectors, lengths of the residuals."""
    scale = 127.0 / np.abs(units).max(axis=1)
    codes = np.rint(units * scale[:, None]).astype(np.int8)
    back = codes / scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(units - back, axis=1)


def _int_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: sums below 2**24 are exact in float32,
    so longer vectors are added in slices of 1024."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        out += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return out


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Places (i, j) with cosine >= threshold between unit rows of a and b, and
    how many pairs needed full precision."""
    qa, sa, la, ea = quantise(a)
    qb, sb, lb, eb = quantise(b)
    rows, cols, redone = [], [], 0
    step = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), step):
        end = min(at + step, len(a))
        near = _int_product(qa[at:end], qb) / (sa[at:end, None] * sb[None, :])
        bound = la[at:end, None] * eb[None, :] + ea[at:end, None] + SLACK
        i, j = np.nonzero(near + bound >= threshold)
        open_ = near[i, j] - bound[i, j] < threshold
        keep = ~open_
        oi, oj = i[open_], j[open_]
        redone += len(oi)
        exact = np.empty(len(oi), bool)
        for k in range(0, len(oi), 1 << 16):
            s = slice(k, k + (1 << 16))
            exact[s] = np.einsum("ij,ij->i", a[at + oi[s]], b[oj[s]]) >= threshold
        keep[open_] = exact
        rows.append(i[keep] + at)
        cols.append(j[keep])
    return np.concatenate(rows), np.concatenate(cols), redone


def _tile(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        rep = group.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        rep, blk, m = rep[order], group.column("blk").to_numpy()[order], group.column("m").to_numpy()[order]
        vectors = group.column("v").combine_chunks()
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rep), -1)[order]
        x = x / np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        ti, tj = group.column("ti")[0].as_py(), group.column("tj")[0].as_py()
        left, right = np.flatnonzero(blk == ti), np.flatnonzero(blk == tj)
        if len(left) and len(right):
            i, j, _ = tile_links(x[left], x[right], threshold)
            i, j = left[i], right[j]
        else:
            i = j = np.zeros(0, np.int64)
        if ti == tj:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, weights=m[j], minlength=len(rep)) + np.bincount(j, weights=m[i], minlength=len(rep))
        low = lowest(i, j, len(rep))
        some = links > 0
        return pa.table({"rep": rep[some], "links": links[some].astype(np.int64), "low": rep[low[some]]})

    return run


def near_vectors(
    rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: other vectors of
    the same label with cosine of at least ``threshold``, the smallest id
    reachable over such links, and whether it is the row's own."""
    every = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label"))
    fine = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0 "
        "AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)"
    )
    good = every.where(fine).withColumn("dim", F.size("v"))
    classes = saved(good.groupBy("label", "dim", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m")), "vec-classes")
    blocks = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("nb"))
    dealt = classes.join(blocks, ["label", "dim"]).withColumn("blk", F.expr("cast(pmod(xxhash64(rep), nb) AS int)"))
    sent = dealt.withColumn("other", F.explode(F.expr("sequence(0, nb - 1)")))
    sent = sent.select("label", "dim", "rep", "m", "v", "blk", F.least("blk", "other").alias("ti"), F.greatest("blk", "other").alias("tj"))
    tiles = saved(sent.groupBy("label", "dim", "ti", "tj").applyInArrow(_tile(threshold), "rep long, links long, low long"), "vec-tiles")
    comp = components(tiles.where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    counts = tiles.groupBy("rep").agg(F.sum("links").alias("links"))
    found = (
        classes.join(counts, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("comp", "rep").alias("component_id"))
    )
    linked = every.where(fine).join(found, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = every.where(F.coalesce(~fine, F.lit(True))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
