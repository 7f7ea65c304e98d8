"""Benchmark decontamination with SimHash windows.

Each item gets a 64-bit SimHash of its weighted ``k``-word shingles (letter
case and ASCII punctuation do not count). A document is compared by windows
of exactly an item's number of words, at every word position; a text with
fewer words is its one window. Fingerprints are cut into 8 blocks of 8 bits;
by the pigeonhole principle a pair within Hamming ``radius`` agrees in some
block up to ``radius // 8`` bits, and the index holds every such neighbour of
every item block, so all items within the radius are found. Candidates are
verified by the exact weighted Jaccard similarity of the shingle multisets.

A shingle weighs 1 + idf / max idf over the items, between 1 and 2 (2 if no
item has it). Fingerprints of a pair at similarity 0.8 differ in 10 of 64 bits
on average and in 13 where the shared shingles are the light ones, so radius 23
lies three standard deviations or more beyond; the tests measure recall against
all windows of texts at that bound.

With weights between 1 and 2, a window of m shingles that reaches similarity t
with an item of n shares at least t (m + n) / 2 of them. Windows with fewer
known shingles are never hashed, and candidates that share fewer with their
item never weighed, which loses nothing.

The item index is broadcast in chunks of at most ``chunk`` items; a larger
benchmark takes several passes over the documents. Items with fewer than
``min_words`` words (``k`` unless the caller says otherwise) match nothing, nor
do null ones. With ``min_words`` below ``k``, an item of fewer than ``k`` words
is found wherever its whole word sequence stands. Null texts are clean.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, mix, shingle_hashes, string_views, word_hashes

BATCH_BYTES = 1 << 21
#: Blocks of a fingerprint and bits of each.
BLOCKS, BLOCK_BITS = 8, 8
#: Shingles of a text whose windows are hashed at once (or the longest item's, if more).
SLICE = 1 << 14
_MASK_BITS = 20


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*string_views(pc.utf8_lower(column)), punctuation=True)


def neighbours(bits: int, most: int) -> np.ndarray:
    """All masks of ``bits`` bits with at most ``most`` ones."""
    return np.array([sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(bits), n)], np.int64)


class ItemIndex:
    def __init__(self, ids: list, texts: list[str], k: int, at_least: float, radius: int, min_words: int):
        self.k, self.at_least, self.radius = k, at_least, radius
        words, at = words_of(pa.array(texts, pa.string()))
        self.ids, self.sizes, self.sets = [], [], []
        short: dict[int, list] = {}
        df: Counter = Counter()
        for i, name in enumerate(ids):
            w = words[at[i] : at[i + 1]]
            if len(w) < max(min_words, 1):
                continue
            if len(w) < k:
                short.setdefault(len(w), []).append((int(shingle_hashes(w, k)[0]), name))
                continue
            s = Counter(shingle_hashes(w, k).tolist())
            df.update(s.keys())
            self.ids.append(name)
            self.sizes.append(len(w))
            self.sets.append(s)
        #: Per number of words: the sorted hashes of whole items and their ids.
        self.short = {m: (np.array([h for h, _ in sorted(x)], np.uint64), [i for _, i in sorted(x)]) for m, x in short.items()}
        self.known = np.array(sorted(df), np.uint64)
        n = max(1, len(self.ids))
        idf = np.log(1 + n / np.array([df[s] for s in self.known.tolist()], float)) / np.log(1 + n) if len(df) else np.zeros(0)
        self.weight_of = 1 + idf
        self.mask = np.zeros(1 << _MASK_BITS, bool)
        self.mask[self.known >> np.uint64(64 - _MASK_BITS)] = True
        self.lengths = sorted(set(self.sizes))
        self.size_of = np.array(self.sizes, np.int64)
        prints = []
        for s in self.sets:
            keys = np.array(list(s), np.uint64)
            prints.append(self.fingerprints(keys, np.array(list(s.values())) * self.weights(keys), np.array([0]), np.array([len(keys)]))[0])
        self.prints = np.array(prints, np.uint64)
        self.keys = [np.array(sorted(s), np.uint64) for s in self.sets]
        #: Per block: bounds of (number of words, value) in the list of item numbers.
        near = neighbours(BLOCK_BITS, radius // BLOCKS)
        kind = np.searchsorted(self.lengths, self.size_of) << BLOCK_BITS
        self.blocks = []
        for b in range(BLOCKS):
            block = ((self.prints >> np.uint64(BLOCK_BITS * b)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            value = (kind[:, None] | (block[:, None] ^ near[None, :])).ravel()
            order = np.argsort(value, kind="stable")
            item = np.repeat(np.arange(len(self.ids), dtype=np.int32), len(near))[order]
            self.blocks.append((np.searchsorted(value[order], np.arange((len(self.lengths) << BLOCK_BITS) + 1)).astype(np.int64), item))

    def find_known(self, shingles: np.ndarray) -> np.ndarray:
        hit = self.mask[shingles >> np.uint64(64 - _MASK_BITS)]
        at = np.flatnonzero(hit)
        if len(at):
            i = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
            hit[at] = self.known[i] == shingles[at]
        return hit

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(shingles), 2.0)
        if len(self.known) and len(shingles):
            i = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
            same = self.known[i] == shingles
            out[same] = self.weight_of[i[same]]
        return out

    @staticmethod
    def fingerprints(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """SimHash of every window [start, end) of shingles."""
        bits = ((mix(shingles)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
        signed = (2 * bits - 1) * weights[:, None]
        total = np.concatenate([np.zeros((1, 64)), np.cumsum(signed, axis=0)])
        out = np.empty(len(starts), np.uint64)
        for at in range(0, len(starts), 1 << 13):
            s = slice(at, at + (1 << 13))
            out[s] = np.packbits(total[ends[s]] - total[starts[s]] > 1e-6, axis=1, bitorder="little").view("<u8").ravel()
        return out

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard of a window's shingle multiset and an item's."""
        have, want = Counter(window.tolist()), self.sets[item]
        keys = list(have.keys() | want.keys())
        w = self.weights(np.array(keys, np.uint64))
        a, b = np.array([have[x] for x in keys]), np.array([want[x] for x in keys])
        return float((w * np.minimum(a, b)).sum() / (w * np.maximum(a, b)).sum())

    def short_leaks(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, item id) of items of fewer than ``k`` words, given the words of several texts."""
        for m, (hashes, ids) in self.short.items():
            if len(words) < m:
                continue
            runs = shingle_hashes(words, m)  # also across texts; those are left out below
            at = np.flatnonzero(np.isin(runs, hashes))
            text = np.searchsorted(bounds, at, side="right") - 1
            inside = at + m <= bounds[text + 1]
            for t, h in np.unique(np.stack([text[inside].astype(np.uint64), runs[at[inside]]], axis=1), axis=0):
                for j in range(np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")):
                    yield int(t), ids[j]

    def leaks(self, shingles: np.ndarray, hit: np.ndarray) -> set[int]:
        """Items found in one text, given its shingles and which are known."""
        found: set[int] = set()
        wide = max(self.lengths) - self.k + 1
        places = np.flatnonzero(hit)
        gaps = np.flatnonzero(np.diff(places) > wide)
        for first, last in zip(places[np.concatenate([[0], gaps + 1])], places[np.concatenate([gaps, [len(places) - 1]])]):
            lo, hi = max(0, int(first) - wide), min(len(shingles), int(last) + wide + 1)
            for at in range(lo, hi, max(SLICE, wide)):
                end = min(hi, at + max(SLICE, wide) + wide)
                self._search(shingles[at:end], hit[at:end], found)
        return found

    def _windows(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, kind of item length) of the windows with enough known shingles."""
        seen = np.concatenate([[0], np.cumsum(hit)])
        parts = []
        for kind, length in enumerate(self.lengths):
            n = length - self.k + 1
            size = min(n, len(hit))  # slices are wider than any item unless the text is shorter
            at = np.flatnonzero(seen[size:] - seen[: len(seen) - size] >= self.at_least * (n + size) / 2 - 1e-9)
            parts.append(np.stack([at, np.full(len(at), size), np.full(len(at), kind)]))
        start, size, kind = np.concatenate(parts, axis=1)
        return start, size, kind

    def _search(self, s: np.ndarray, hit: np.ndarray, found: set[int]) -> None:
        """Items within the radius of a window, by the blocks of its fingerprint, then verified."""
        start, size, kind = self._windows(hit)
        prints = self.fingerprints(s, self.weights(s), start, start + size) if len(start) else np.zeros(0, np.uint64)
        for some in np.array_split(np.arange(len(start)), len(start) // 4096 + 1):
            pairs = []
            for b, (ends, items) in enumerate(self.blocks):
                value = kind[some] << BLOCK_BITS | ((prints[some] >> np.uint64(BLOCK_BITS * b)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
                n = ends[value + 1] - ends[value]
                window = np.repeat(some, n)
                inner = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
                item = items[np.repeat(ends[value], n) + inner].astype(np.int64)
                close = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
                pairs.append(item[close] * len(start) + window[close])
            item, window = np.divmod(np.unique(np.concatenate(pairs)), max(len(start), 1))
            for at in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1) if len(item) else []:
                j = int(item[at[0]])
                if j not in found and self._verified(s, start[window[at]], size[window[at]], prints[window[at]], j):
                    found.add(j)

    def _verified(self, s: np.ndarray, start: np.ndarray, size: np.ndarray, prints: np.ndarray, item: int) -> bool:
        """Whether one of the windows reaches the similarity with the item, nearest fingerprints first."""
        first, last = int(start.min()), int((start + size).max())
        keys = self.keys[item]
        part = s[first:last]
        seen = np.concatenate([[0], np.cumsum(keys[np.minimum(np.searchsorted(keys, part), len(keys) - 1)] == part)])
        shared = seen[start + size - first] - seen[start - first]
        n = int(self.size_of[item]) - self.k + 1
        left = np.flatnonzero(shared >= self.at_least * (n + size) / 2 - 1e-9)
        order = np.argsort(np.bitwise_count(prints[left] ^ self.prints[item]), kind="stable")
        return any(self.similarity(s[x : x + m], item) >= self.at_least for x, m in zip(start[left[order]].tolist(), size[left[order]].tolist()))


def _finder(shared, at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: ItemIndex = shared.value
        k = index.k
        for batch in by_bytes(batches, at, BATCH_BYTES):
            words, bounds = words_of(batch.column(at))
            out: list[list] = [[] for _ in range(batch.num_rows)]
            if index.ids and len(words) >= k:
                every = shingle_hashes(words, k)  # also across texts; those are left out below
                hit = index.find_known(every)
                last = np.searchsorted(bounds, np.flatnonzero(hit), side="right") - 1
                for i in np.unique(last).tolist():
                    a, b = bounds[i], bounds[i + 1] - k + 1
                    if b > a and hit[a:b].any():
                        out[i] = sorted({index.ids[x] for x in index.leaks(every[a:b], hit[a:b])})
            for i, item in index.short_leaks(words, bounds):
                out[i] = sorted({*out[i], item})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], schema=schema)

    return run


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    name: str = "leaked_items",
    k: int = 5,
    at_least: float = 0.8,
    radius: int = 23,
    min_words: int | None = None,
    chunk: int = 10_000,
) -> DataFrame:
    """All columns of ``docs`` and ``name`` (replacing one of that name): the ascending ids of the items
    found in the text (an empty list for a clean text), each id once, also where items repeat an id or a
    text; no shuffle. Ids of documents are not looked at: repeated and null ones keep their rows."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    wanted = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL")
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.LongType()))])
    arrow, at = to_arrow_schema(schema), docs.columns.index(text_col)
    out, after, first = docs, None, True
    while True:
        rows = (wanted if after is None else wanted.where(F.col("i") > after)).orderBy("i", "t").limit(chunk).collect()
        if len(rows) == chunk:  # ids may repeat: finish the last one in the next pass
            rest = [r for r in rows if r[0] != rows[-1][0]]
            rows = rest or wanted.where(F.col("i") == rows[-1][0]).orderBy("t").collect()
            after, more = rows[-1][0], True
        else:
            more = False
        index = spark.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows], k, at_least, radius, k if min_words is None else min_words))
        if first:
            out = docs.mapInArrow(_finder(index, at, arrow), schema)
        else:
            more_name = "_more"
            while more_name.lower() in {c.lower() for c in out.columns}:
                more_name += "_"
            fresh = T.StructType([*schema.fields, T.StructField(more_name, T.ArrayType(T.LongType()))])
            out = out.mapInArrow(_finder(index, at, to_arrow_schema(fresh)), fresh).withColumn(name, F.array_sort(F.array_union(name, more_name))).drop(more_name)
        first = False
        if not more:
            return out
