"""Boosted trees of several targets on the same rows, grown level by level together.

The trees are those of MLlib's ``GBTClassifier`` (log loss, variance splits on at
most 32 bins a feature, row samples and feature subsets by the same generators and
seeds) and come back as its model class. Its training keeps 4 bytes a feature and a
row object for every target in memory, and starts 16 to 20 jobs a round for four
targets. Here one job a level counts the histograms of all targets in numpy, and
the first of a round also brings the margins up to date.

* Features share an index while the product of their bins is at most ``CELLS``: a
  row is 2 bytes a group in column blocks that stay in Spark, and one count serves
  all features of the group, whose own histograms are its marginal sums.
* Of two children that are to be split, only the one with fewer rows is counted; the
  other is the parent without it.
* Both change the order of additions. MLlib lets rounding errors choose between
  equally good splits; here the first of them in its order is taken (``SLACK``).
  Up to ``PLAIN_ROWS`` rows neither is worth it: every feature and child is counted
  alone, row by row, which gives MLlib's sums but for the last digits of its
  exponential function.

What reaches the driver: the split sample (about 10,000 rows), and the histograms of
a level from at most ``FAN_IN`` partitions (beyond that they are merged in Spark
first).
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import ensure_checkpoint_dir

BINS = 32
MAX_DEPTH = 4
SAMPLE_ROWS = 10_000
RATE = 0.8  # of the rows a tree, of the features a node
#: Cells of the joint histogram of a group of features.
CELLS = 1024
#: Rows up to which features and children are counted one by one.
PLAIN_ROWS = 100_000
#: Part of a node's impurity below which a difference is a rounding error.
SLACK = 1e-13
#: Rows of a block, so that a task's arrays stay in the cache.
BLOCK_ROWS = 16_384
FAN_IN = 32
CHECKPOINT_EVERY = 10
_M64 = (1 << 64) - 1
_EPS = 2.0**-52


# --- the generators of Scala, Java and Spark -------------------------------------------
def _murmur(data: bytes, seed: int) -> int:
    h = seed & 0xFFFFFFFF
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    return h ^ h >> 16


def xorshift_seed(seed: int) -> int:
    """The first state of Spark's ``XORShiftRandom``."""
    data = struct.pack(">q", (seed + (1 << 63) & _M64) - (1 << 63))
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _next(s: int) -> int:
    s ^= s << 21 & _M64
    s ^= s >> 35
    return s ^ (s << 4 & _M64)


@lru_cache(maxsize=64)
def _jump(power: int) -> np.ndarray:
    """Tables (byte place x byte) of 2 ** power steps, which are linear in the bits."""
    images = [_next(1 << i) for i in range(64)]
    if power:
        images = _jumped(np.array([1 << i for i in range(64)], np.uint64), power - 1)
        images = [int(x) for x in _jumped(images, power - 1)]
    table = np.zeros((8, 256), np.uint64)
    for i in range(8):  # a byte with bit i set: the one without it, and the image of the bit
        table[:, 1 << i : 2 << i] = table[:, : 1 << i] ^ np.array(images[i::8], np.uint64)[:, None]
    return table


def _jumped(states: np.ndarray, power: int) -> np.ndarray:
    table, out = _jump(power), np.zeros(len(states), np.uint64)
    for place in range(8):
        out ^= table[place][(states >> np.uint64(8 * place) & np.uint64(255)).astype(np.intp)]
    return out


def xorshift_doubles(state: int, n: int) -> tuple[np.ndarray, int]:
    """The next ``n`` values of ``nextDouble`` and the state after them."""
    if not n:
        return np.zeros(0), state
    states, size, power = np.empty(2 * n, np.uint64), 1, 0
    states[0] = _next(state)
    while size < 2 * n:
        more = min(size, 2 * n - size)
        states[size : size + more] = _jumped(states[:more], power)
        size, power = size + more, power + 1
    high, low = states[0::2] & np.uint64((1 << 26) - 1), states[1::2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(np.float64) * 2.0**-53, int(states[-1])


class JavaRandom:
    """``nextLong`` of ``java.util.Random``."""

    def __init__(self, seed: int):
        self.s = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _bits(self) -> int:
        self.s = (self.s * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        x = self.s >> 16
        return x - (1 << 32) if x >> 31 else x

    def next_long(self) -> int:
        return ((self._bits() << 32) + self._bits() + (1 << 63) & _M64) - (1 << 63)


def feature_subset(n: int, k: int, seed: int) -> list[int]:
    """Reservoir sample of ``k`` of ``n`` features, in its order."""
    out = list(range(k))
    draws, _ = xorshift_doubles(xorshift_seed(seed), n - k)
    for item, u in zip(range(k, n), draws):
        at = int(u * (item + 1))
        if at < k:
            out[at] = item
    return out


# --- split candidates ---------------------------------------------------------------------
def split_candidates(values: np.ndarray, weights: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """Thresholds of one feature from sampled values; ``expected`` is the weight of
    the sample, of which zeros hold what the other values leave."""
    shown = values != 0.0
    v, at = np.unique(values[shown], return_inverse=True)
    if not len(v):
        return np.zeros(0)
    w = np.bincount(at, weights[shown])
    rest = expected - float(w.sum())
    if rest > _EPS * int(shown.sum()) * 100:
        place = int(np.searchsorted(v, 0.0))
        v, w = np.insert(v, place, 0.0), np.insert(w, place, rest)
    if len(v) - 1 < bins:
        return (v[:-1] + v[1:]) / 2.0
    stride = expected / bins
    out, current, target = [], float(w[0]), stride
    for i in range(1, len(v)):
        before, current = current, current + float(w[i])
        if abs(before - target) < abs(current - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
    return np.array(out)


# --- trees ----------------------------------------------------------------------------------
@dataclass
class Node:
    stats: tuple | None = None  # weight, weighted sum, weighted sum of squares
    rows: int = 0
    impurity: float = 0.0
    gain: float = 0.0
    feature: int = -1
    bin: int = -1  # rows up to this bin go left
    left: Node | None = None
    right: Node | None = None
    hist: np.ndarray | None = None  # (rows, weight, sum, sum of squares) x features x bins

    @property
    def prediction(self) -> float:
        return self.stats[1] / self.stats[0] if self.stats[0] != 0 else 0.0


def _impurity(w, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w == 0, 0.0, (q - (s * s) / w) / w)


def _made(h: np.ndarray) -> Node:
    return Node(tuple(h[1:].tolist()), int(h[0]), float(_impurity(*h[1:])))


def split_node(node: Node, n_splits: np.ndarray, subset: Sequence[int], slack: float) -> bool:
    """Give the node its best split and its children, if it has a split that gains."""
    order = np.array([f for f in subset if n_splits[f] > 0], dtype=np.intp)
    if not len(order):
        if node.stats is None:
            made = _made(node.hist[:, subset[0]].sum(axis=1))
            node.stats, node.rows, node.impurity = made.stats, made.rows, made.impurity
        return False
    below = node.hist[:, order].cumsum(axis=2)
    left, right = below[..., :-1], below[..., -1:] - below[..., :-1]
    if node.stats is None:  # the root
        made = _made(left[:, 0, 0] + right[:, 0, 0])
        node.stats, node.rows, node.impurity = made.stats, made.rows, made.impurity
    wl, wr = left[1], right[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = node.impurity - wl / (wl + wr) * _impurity(*left[1:]) - wr / (wl + wr) * _impurity(*right[1:])
    valid = (left[0] >= 1) & (right[0] >= 1) & (wl >= 0) & (wr >= 0) & (np.arange(left.shape[2]) < n_splits[order][:, None]) & (gain > 0)
    if not valid.any():
        return False
    gain = np.where(valid, gain, -np.inf)
    i, k = divmod(int(np.argmax(gain >= gain.max() - slack * node.impurity)), left.shape[2])
    node.gain, node.feature, node.bin = float(gain[i, k]), int(order[i]), k
    node.left, node.right = _made(left[:, i, k]), _made(right[:, i, k])
    return True


@dataclass
class Tree:
    """A growing tree: its nodes that wait for a split, in the order they are drawn,
    and those of them whose rows must be counted."""

    rng: JavaRandom
    plain: bool = False
    root: Node = field(default_factory=Node)
    open: list[Node] = field(default_factory=list)
    counted: list[Node] = field(default_factory=list)
    rest: list[tuple[Node, Node, Node]] = field(default_factory=list)  # node, parent, counted sibling
    level: int = 0

    def __post_init__(self):
        self.open, self.counted = [self.root], [self.root]

    def grow(self, hists: np.ndarray, n_splits: np.ndarray) -> None:
        """Split the open nodes by the histograms of the counted ones."""
        slack = 0.0 if self.plain else SLACK
        for node, h in zip(self.counted, hists):
            node.hist = h
        for node, parent, sibling in self.rest:
            node.hist = np.where(parent.hist[0] > sibling.hist[0], parent.hist - sibling.hist, 0.0)
        for parent in {id(p): p for _, p, _ in self.rest}.values():
            parent.hist = None
        d = len(n_splits)
        k = math.ceil(RATE * d)
        subsets = [feature_subset(d, k, self.rng.next_long()) if k < d else list(range(d)) for _ in self.open]
        stack, self.counted, self.rest = [], [], []
        for node, subset in zip(self.open, subsets):
            children = []
            if split_node(node, n_splits, subset, slack) and self.level + 1 < MAX_DEPTH:
                children = [c for c in (node.left, node.right) if abs(c.impurity) >= _EPS]
            stack += children
            if len(children) == 2 and not self.plain:
                few, many = sorted(children, key=lambda c: c.rows)
                self.counted.append(few)
                self.rest.append((many, node, few))
            else:
                self.counted += children
                node.hist = None
        self.open, self.level = stack[::-1], self.level + 1

    def flat(self) -> tuple[list, np.ndarray, np.ndarray]:
        """(feature, bin, first child or -1) by number, predictions, and the place of
        a node among those counted (-1: none)."""
        nodes, places = [self.root], {id(x): i for i, x in enumerate(self.counted)}
        table = []
        for x in nodes:  # grows meanwhile
            table.append((x.feature, x.bin, len(nodes) if x.left else -1))
            nodes += [x.left, x.right] if x.left else []
        return table, np.array([x.prediction if x.stats else 0.0 for x in nodes]), np.array([places.get(id(x), -1) for x in nodes])


# --- work on the blocks ------------------------------------------------------------------
@dataclass
class Groups:
    """Features that share an index: a feature's bin is index // stride % bins. Rarely
    a feature has more than ``BINS`` bins, as in MLlib."""

    bins: list[int]
    cells: int = CELLS
    group: list[int] = field(default_factory=list)
    stride: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)

    def __post_init__(self):
        self.group, self.stride, self.sizes = [-1] * len(self.bins), [1] * len(self.bins), [1]
        for f in sorted(range(len(self.bins)), key=lambda f: -self.bins[f]):
            if self.bins[f] > 1:
                g = next((g for g, size in enumerate(self.sizes) if size * self.bins[f] <= max(self.cells, self.bins[f])), len(self.sizes))
                self.sizes += [1] * (g == len(self.sizes))
                self.group[f], self.stride[f], self.sizes[g] = g, self.sizes[g], self.sizes[g] * self.bins[f]

    def bin_of(self, index: np.ndarray, f: int, rows: np.ndarray) -> np.ndarray:
        if self.group[f] < 0:
            return np.zeros(len(rows), np.uint16)
        return index[self.group[f]].take(rows) // np.uint16(self.stride[f]) % np.uint16(self.bins[f])

    def marginals(self, joint: list[np.ndarray]) -> np.ndarray:
        """sums x (nodes, cells) of every group to nodes x sums x features x bins."""
        n, kinds = joint[0].shape[1], joint[0].shape[0]
        out = np.zeros((n, kinds, len(self.bins), max(self.bins)))
        for f, size in enumerate(self.bins):
            x = joint[max(self.group[f], 0)]
            x = x.reshape(kinds, n, -1, size, self.stride[f]).sum(axis=(2, 4)) if self.group[f] >= 0 else x.sum(axis=2, keepdims=True)
            out[:, :, f, : x.shape[2]] = x.transpose(1, 0, 2)
        return out


def _node_of(index: np.ndarray, groups: Groups, table: list) -> np.ndarray:
    """The number of the node each row (column of ``index``) lies in."""
    at = np.zeros(index.shape[1], dtype=np.intp)
    for i, (f, b, child) in enumerate(table):
        if child >= 0:  # children have higher numbers
            here = np.flatnonzero(at == i)
            at[here] = child + (groups.bin_of(index, f, here) > b)
    return at


def _indexes(raw: bytes, n: int, groups: list[Groups]) -> list[np.ndarray]:
    flat, out, at = np.frombuffer(raw, np.uint16), [], 0
    for g in groups:
        out.append(flat[at : at + n * len(g.sizes)].reshape(-1, n))
        at += n * len(g.sizes)
    return out


def _binned(splits: list[list[np.ndarray]], groups: list[Groups]):
    """Arrow batches of (features, labels) to blocks (rows, group indexes, labels)."""
    d = len(splits[0])

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches)
        columns, found = [c.to_numpy() for c in t.columns], []
        for of_target, g in zip(splits, groups):
            index = np.zeros((len(g.sizes), t.num_rows), np.uint16)
            for f, thresholds in enumerate(of_target):
                if g.group[f] >= 0:
                    index[g.group[f]] += (np.searchsorted(thresholds, columns[f], side="left") * g.stride[f]).astype(np.uint16)
            found.append(index.tobytes())
        labels = np.array([c == 1 for c in columns[d:]], np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([t.num_rows]), pa.array([b"".join(found)], pa.binary()), pa.array([labels.tobytes()], pa.binary())], names=["n", "index", "labels"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for b in batches:
            if b.num_rows:
                waiting, rows = [*waiting, b], rows + b.num_rows
            if rows >= BLOCK_ROWS:
                yield block(waiting)
                waiting, rows = [], 0
        if rows:
            yield block(waiting)

    return run


def _single(rdd: RDD) -> RDD:
    """One record a batch, so that blocks and margins meet without another pass."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _drawn(seed: int, trees: list | None, step: float, groups: list[Groups]):
    """(block, margins before) to (margins, rows drawn for the next tree): the last
    trees are added to the margins."""

    def run(part: int, pairs):
        state = xorshift_seed(seed + part + 1)
        for x in pairs:
            (n, raw, labels), old = x if trees else (x, None)
            draws, state = xorshift_doubles(state, n)
            margins = np.zeros((len(groups), n))
            if trees:
                index = _indexes(raw, n, groups)
                margins += np.frombuffer(old[0]).reshape(-1, n)
                for k, (table, values, _) in enumerate(trees):
                    margins[k] += (step * values)[_node_of(index[k], groups[k], table)]
            yield margins.tobytes(), (draws < RATE).tobytes()

    return run


def _histograms(trees: list, weights: list[float | None], groups: list[Groups], first: bool):
    """Sums of one partition for every target: counted nodes x (rows, weight, weighted
    labels, weighted squares) x features x bins. The ``first`` trees are fitted to the
    labels."""

    def run(pairs) -> Iterator[list]:
        slots = [int((places >= 0).sum()) for _, _, places in trees]
        joint = [[np.zeros((4, s * size)) for size in g.sizes] for g, s in zip(groups, slots)]
        for (n, raw, labels), (margins, drawn) in pairs:
            index, y01 = _indexes(raw, n, groups), np.frombuffer(labels, np.uint8).reshape(-1, n)
            old, mask = np.frombuffer(margins).reshape(-1, n), np.frombuffer(drawn, np.bool_)
            for k, (table, _, places) in enumerate(trees):
                if not slots[k]:
                    continue
                place = places[_node_of(index[k], groups[k], table)]
                keep = np.flatnonzero(mask & (place >= 0))
                positive, place = y01[k].take(keep), place.take(keep)
                y = 2.0 * positive - 1.0
                y = y if first else residual(y, old[k].take(keep))
                w = None if weights[k] is None else np.where(positive == 1, weights[k], 1.0)
                wy = y if w is None else w * y
                wyy = wy * y
                for g, size in enumerate(groups[k].sizes):
                    at, cells = place * size + index[k][g].take(keep), slots[k] * size
                    sums, rows = joint[k][g], np.bincount(at, minlength=cells)
                    sums[0] += rows
                    sums[1] += rows if w is None else np.bincount(at, w, cells)
                    sums[2] += np.bincount(at, wy, cells)
                    sums[3] += np.bincount(at, wyy, cells)
        yield [g.marginals([x.reshape(4, s, -1) for x in of_target]) if s else np.zeros((0, 4, len(g.bins), max(g.bins))) for g, s, of_target in zip(groups, slots, joint)]

    return run


def residual(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """What is left of the labels (-1 and 1): the negative gradient of the log loss."""
    return 4.0 * y / (1.0 + np.exp(2.0 * y * margin))


def _merged(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b)]


# --- the whole fit ---------------------------------------------------------------------------
def _sampled(train: DataFrame, n: int, seed: int) -> pa.Table:
    """The rows from which split candidates are taken: MLlib's own sample."""
    if n <= SAMPLE_ROWS:
        return train.toArrow()
    spark, x = train.sparkSession, _next(xorshift_seed(seed)) & 0xFFFFFFFF
    rows = train._jdf.toJavaRDD().sample(False, SAMPLE_ROWS / n, x - (1 << 32) if x >> 31 else x)
    return DataFrame(spark._jsparkSession.createDataFrame(rows, train._jdf.schema()), spark).toArrow()


def fit(train: DataFrame, cols: Sequence[str], targets: Sequence[str], step: float, weighted: bool, n_trees: int, seed: int) -> dict:
    """An ensemble for each target on all rows of ``train`` (features ``cols`` without
    NULLs, 0/1 targets; read three times, so keep it), positives weighted by
    (n - pos) / max(pos, 1) if ``weighted``."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    train = train.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)], *[F.col(t).cast("double").alias(f"y{k}") for k, t in enumerate(targets)])
    d, told = len(cols), train.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y{k}").alias(f"y{k}") for k in range(len(targets))]).first()
    n = told["n"]
    if not n:
        raise ValueError("boosted trees need at least one row")
    positives = [told[f"y{k}"] or 0.0 for k in range(len(targets))]
    weights = [float((n - pos) / max(pos, 1)) if weighted else None for pos in positives]
    plain = n <= PLAIN_ROWS

    sample = _sampled(train, n, seed)
    values = [sample.column(i).to_numpy() for i in range(d)]
    splits = []
    for k, (w, pos) in enumerate(zip(weights, positives)):
        of_row = np.ones(sample.num_rows) if w is None else np.where(sample.column(d + k).to_numpy() == 1, w, 1.0)
        expected = min(1.0, SAMPLE_ROWS / n) * (n if w is None else pos * w + (n - pos))
        splits.append([split_candidates(v, of_row, expected, min(BINS, n)) for v in values])
    n_splits = [np.array([len(x) for x in of_target]) for of_target in splits]
    groups = [Groups((x + 1).tolist(), 1 if plain else CELLS) for x in n_splits]

    blocks = train.mapInArrow(_binned(splits, groups), "n long, index binary, labels binary").rdd.map(tuple)
    blocks = _single(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list[list[Tree]] = []
    margins = None
    try:
        for m in range(n_trees):
            last = [t.flat() for t in grown[-1]] if grown else None
            drawn = (blocks.zip(margins) if grown else blocks).mapPartitionsWithIndex(_drawn(seed + m, last, 1.0 if m == 1 else step, groups))
            drawn = _single(drawn).persist(StorageLevel.MEMORY_AND_DISK)
            if m % CHECKPOINT_EVERY == CHECKPOINT_EVERY - 1:
                drawn.checkpoint()
            pairs, trees = blocks.zip(drawn), [Tree(JavaRandom(seed + m), plain) for _ in targets]
            while any(t.open for t in trees):
                counted = pairs.mapPartitions(_histograms([t.flat() for t in trees], weights, groups, m == 0))
                hists = counted.treeReduce(_merged) if counted.getNumPartitions() > FAN_IN else reduce(_merged, counted.collect())
                for t, h, found in zip(trees, hists, n_splits):
                    t.grow(h, found)
            if margins is not None:
                margins.unpersist()
            margins = drawn
            grown.append(trees)
    finally:
        blocks.unpersist()
        if margins is not None:
            margins.unpersist()
    return {t: _model(spark, [trees[k].root for trees in grown], splits[k], step, seed) for k, t in enumerate(targets)}


def _model(spark, roots: list[Node], splits: list[np.ndarray], step: float, seed: int) -> GBTClassificationModel:
    """The ensemble as MLlib's model."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml, calculator = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    leaf_of, inner_of, split_of = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit

    def array(kind, items):
        out = gateway.new_array(kind, len(items))
        for i, x in enumerate(items):
            out[i] = x
        return out

    def pruned(x: Node) -> bool:
        """Without a split, or with two leaves that predict the same."""
        return x.left is None or (pruned(x.left) and pruned(x.right) and value(x.left) == value(x.right))

    def value(x: Node) -> float:
        return x.prediction if x.left is None else value(x.left)

    def node(x: Node):
        calc = calculator(array(jvm.double, [float(v) for v in x.stats]), x.rows)
        if pruned(x):
            return leaf_of(value(x), x.impurity, calc)
        split = split_of(x.feature, float(splits[x.feature][x.bin]))
        return inner_of(x.prediction, x.impurity, x.gain, node(x.left), node(x.right), split, calc)

    est = GBTClassifier(maxIter=len(roots), maxDepth=MAX_DEPTH, stepSize=step, subsamplingRate=RATE, featureSubsetStrategy=str(RATE), seed=seed)
    tree_of = ml.regression.DecisionTreeRegressionModel
    trees = array(tree_of, [tree_of(node(r), len(splits)) for r in roots])
    model = GBTClassificationModel(ml.classification.GBTClassificationModel(est.uid, trees, array(jvm.double, [1.0] + [step] * (len(roots) - 1)), len(splits), 2))
    return est._copyValues(model)
