"""Packing of token sequences by a configuration linear program.

Documents become pieces of at most ``capacity`` tokens. Only the histogram of
piece lengths (at most ``capacity`` counts) reaches the driver. There the
covering program over bin configurations is solved by multiplicative weights:
each step prices lengths, finds the best configuration by an unbounded
knapsack dynamic program (on lengths rounded up to ``grid`` tokens), and adds
it. The fractional solution is rounded down to whole copies, each topped up
with the longest piece that fits; what remains is solved again, and the last
rest is packed by best fit on the histogram. The plan is a list of
(configuration, copies) whose size depends on the number of distinct lengths,
not on the number of pieces. Pieces find their place by their rank within
their length, counted in evenly dealt buckets, so a frequent length does not
meet in one task.

Null text is an empty document: a piece of the end id alone. Repeated rows and
null ids are packed like any other row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, saved
from pulsegrid.llm.tokens import WordBpe, loaded

BATCH_BYTES = 1 << 20
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, bucket int"

Plan = list[tuple[dict[int, int], int]]


def _cutter(path: str, capacity: int, end_id: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk, tail, dealt = loaded(WordBpe, path), np.array([end_id], np.uint32), 0
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            rows = []
            for name, x in zip(batch.column(0).to_pylist(), tk.ids([t or "" for t in batch.column(1).to_pylist()])):
                x = np.concatenate([x, tail]).astype("<u4")
                for piece, at in enumerate(range(0, len(x), capacity)):
                    part = x[at : at + capacity]
                    rows.append((name, piece, at, len(part), zlib.crc32(part.tobytes()), dealt % buckets))
                    dealt += 1
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "bucket"])

    return run


# -- the plan, on the driver: sizes bounded by the capacity ----------------------


def _best_configuration(sizes: np.ndarray, values: np.ndarray, cells: int) -> dict[int, int]:
    """Unbounded knapsack: index -> copies, of most value within ``cells``.
    ``sizes`` ascend."""
    best, last = np.zeros(cells + 1), np.full(cells + 1, -1)
    fits = np.searchsorted(sizes, np.arange(cells + 1), side="right")
    for c in range(1, cells + 1):
        best[c] = best[c - 1]
        if fits[c]:
            v = best[c - sizes[: fits[c]]] + values[: fits[c]]
            top = int(v.argmax())
            if v[top] > best[c]:
                best[c], last[c] = v[top], top
    out: Counter = Counter()
    c = cells
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            out[int(last[c])] += 1
            c -= int(sizes[last[c]])
    return dict(out)


def solve_configurations(counts: np.ndarray, sizes: np.ndarray, cells: int, steps: int, rate: float = 0.2) -> list[tuple[dict[int, int], float]]:
    """Multiplicative weights for: fewest configurations that cover ``counts``
    pieces of each of ``sizes``. Returns configurations and amounts, scaled so
    that no size is covered more than once."""
    weight, cover = np.ones(len(sizes)), np.zeros(len(sizes))
    amounts: dict[tuple, float] = {}
    for _ in range(steps):
        conf = _best_configuration(sizes, weight / counts, cells)
        if not conf:
            break
        at = np.fromiter(conf, int)
        per = np.fromiter(conf.values(), float) / counts[at]
        amount = 1 / per.max()
        key = tuple(sorted(conf.items()))
        amounts[key] = amounts.get(key, 0.0) + amount
        cover[at] += per * amount
        weight[at] *= np.exp(-rate * per * amount)
        weight /= weight.max()
    most = cover.max() if len(cover) else 1.0
    return [(dict(k), a / max(most, 1e-12)) for k, a in amounts.items()]


class _Pool:
    """Pieces left, by length."""

    def __init__(self, counts: np.ndarray):
        self.n = counts
        self.lengths = [int(x) for x in np.flatnonzero(counts)]

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.lengths[bisect_right(self.lengths, length) - 1]

    def longest(self, room: int) -> int:
        i = bisect_right(self.lengths, room)
        return self.lengths[i - 1] if i else 0

    def emit(self, want: list[int], copies: int, capacity: int, plan: Plan) -> int:
        """Pack up to ``copies`` of the lengths ``want``, topped up by best fit;
        returns how many were packed."""
        conf = Counter(want)
        room = capacity - sum(want)
        while room > 0:
            i = bisect_right(self.lengths, room)
            while i and self.n[self.lengths[i - 1]] <= conf.get(self.lengths[i - 1], 0):
                i -= 1
            if not i:
                break
            length = self.lengths[i - 1]
            n = min(room // length, int(self.n[length]) - conf.get(length, 0))
            conf[length] += n
            room -= n * length
        copies = min([copies, *(int(self.n[x]) // k for x, k in conf.items())])
        for x, k in conf.items():
            self.take(x, k * copies)
        plan.append((dict(conf), copies))
        return copies


def plan_bins(histogram: dict[int, int], capacity: int, grid: int = 8, steps: int = 300, passes: int = 4) -> Plan:
    """(length -> pieces, copies) for every bin kind; covers the histogram
    exactly."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan: Plan = []
    if counts[capacity]:
        plan.append(({capacity: 1}, int(counts[capacity])))
        counts[capacity] = 0
    pool = _Pool(counts)
    cells = capacity // grid
    for _ in range(passes):
        classes: dict[int, int] = {}
        for x in pool.lengths:
            g = min(-(-x // grid), cells)
            classes[g] = classes.get(g, 0) + int(counts[x])
        if not classes:
            break
        sizes = np.array(sorted(classes))
        packed = 0
        for conf, amount in sorted(solve_configurations(np.array([classes[s] for s in sizes], float), sizes, cells, steps), key=lambda c: -c[1]):
            copies = int(amount)
            while copies > 0:
                want: list[int] = []
                for i, k in sorted(conf.items(), reverse=True):
                    top = min(int(sizes[i]) * grid, capacity - 1)
                    for _ in range(k):
                        j = bisect_right(pool.lengths, top)
                        while j and pool.lengths[j - 1] > top - grid and counts[pool.lengths[j - 1]] <= want.count(pool.lengths[j - 1]):
                            j -= 1
                        if j and pool.lengths[j - 1] > top - grid:
                            want.append(pool.lengths[j - 1])
                if not want:
                    break
                done = pool.emit(want, copies, capacity, plan)
                copies -= done
                packed += done
        if not packed:
            break
    while pool.lengths:
        pool.emit([pool.lengths[-1]], int(counts[pool.lengths[-1]]), capacity, plan)
    return plan


def _places(plan: Plan) -> tuple[np.ndarray, ...]:
    """Sorted keys (length, first rank) and what stands there."""
    rows, used, base = [], Counter(), 0
    for conf, copies in plan:
        offset = 0
        for length, k in sorted(conf.items(), reverse=True):
            rows.append((length, used[length], base, k, offset))
            used[length] += k * copies
            offset += k * length
        base += copies
    rows.sort()
    t = np.array(rows, np.int64).reshape(-1, 5)
    return (t[:, 0] << 40) | t[:, 1], t[:, 1], t[:, 2], t[:, 3], t[:, 4]


def _placer(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, base, per, offset = places.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(key, (length << 40) | rank, side="right") - 1
            within = rank - first[at]
            sequence = base[at] + within // per[at]
            place = offset[at] + within % per[at] * length
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(place)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every
    piece; pieces of a sequence lie one after the other from 0."""
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    pieces = saved(rows.mapInArrow(_cutter(tokenizer, capacity, end_id, buckets), _PIECE), "pieces")
    sizes = pieces.groupBy("length", "bucket").count()
    histogram = {int(r[0]): int(r[1]) for r in sizes.groupBy("length").agg(F.sum("count")).collect()}  # at most ``capacity`` rows
    places = spark.sparkContext.broadcast(_places(plan_bins(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    one = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("nth", F.row_number().over(one)).join(bases, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth") - 1).alias("rank"))
    return ranked.mapInArrow(_placer(places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
