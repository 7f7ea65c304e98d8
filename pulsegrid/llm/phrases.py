"""Phrase collocations, counted on a vertically partitioned suffix tree.

The suffix tree over all word positions of a corpus, cut at depth
``max_words``, holds every phrase as a node; the phrase's count is the sum of
the leaf totals below it. The tree is never built as a whole:

1. ``vocabulary``: counts of all words per language. A phrase cannot be more
   frequent than its words, so only words of ``min_count`` open a path.
2. ``pair_counts``: counts of all two-word prefixes made of such words.
3. Vertical partitioning (``Partition``): prefixes are put into groups of
   about ``budget`` positions by ranges of their hash. A prefix that alone
   passes the budget is extended to the whole depth, and its leaves are dealt
   over groups of their own.
4. Every position sends its suffix, cut at ``max_words`` words, at the end of
   its piece or before a pair below ``min_count``, to the group of its prefix;
   equal suffixes of a task travel as one leaf with a total.
5. ``subtree``: each group is sorted into its subtree on its own, and the
   nodes' counts are read from the leaf totals. Nodes of a prefix that was
   dealt over several groups are added up afterwards.

Words are 64-bit hashes of (language, word) up to the last step. The hashes
of the whole vocabulary are checked for collisions, and the seed is changed
until there are none, so counts are exact. What is broadcast is bounded: two
bitmaps of at most 2**``MAX_BITS`` bits, which only save work (a wrongly set
bit sends a suffix too many and changes no count), 65,536 group borders, and
at most 2**20 heavy prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import _powers, by_bytes, mix, saved, string_views

#: Positions in a group; a task holds one group at a time (40 bytes a position).
BUDGET = 1 << 20
#: log2 of the largest bitmap (32 MB).
MAX_BITS = 28
#: Text bytes looked at together, and words held in a task before they are sent on.
BATCH_BYTES, FLUSH_WORDS = 1 << 22, 1 << 20
#: Salts of keys that many phrases look up.
SALTS = 16

_M1, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20
_KIND = np.zeros(256, np.uint8)  # 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 9]] = 1
_KIND[[*b".,;:!?", 10, 11, 12, 13]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- words -------------------------------------------------------------------


def _byte_values(seed: int) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD + np.uint64(seed) * _M1)
    values[65:91] = values[97:123]
    values[_KIND > 0] = 0
    return values


def _label_hash(label: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {label}".encode(), digest_size=8).digest(), "little")


def _slices(raw: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Parts of about ``limit`` bytes, cut where a row starts or after a break
    (a longer piece stays whole)."""
    at, total = 0, len(raw)
    while at < total:
        end = min(at + limit, total)
        if end < total:
            row = int(bounds[np.searchsorted(bounds, end, side="right") - 1])
            breaks = np.flatnonzero(_KIND[raw[at:end]] == 2)
            cut = max(row, at + int(breaks[-1]) + 1 if len(breaks) else 0)
            while cut <= at:  # no cut inside: the next one
                row = int(bounds[np.searchsorted(bounds, end, side="right")])
                more = min(end + limit, row)
                breaks = np.flatnonzero(_KIND[raw[end:more]] == 2)
                if len(breaks):
                    cut = end + int(breaks[0]) + 1
                elif more == row:
                    cut = row
                end = more
            end = cut
        yield at, end
        at = end


@dataclass
class Words:
    """The words of one slice: hashes, first bytes, lengths, number of the piece, row."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    pieces: np.ndarray
    rows: np.ndarray


def words_of(raw: np.ndarray, bounds: np.ndarray, labels: np.ndarray, values: np.ndarray) -> Iterator[Words]:
    """The words of all rows; ``labels`` are hashes of the rows' languages."""
    for lo, hi in _slices(raw, bounds, _SLICE):
        part = raw[lo:hi]
        kind = _KIND[part]
        solid = kind == 0
        opens = bounds[np.searchsorted(bounds, lo) : np.searchsorted(bounds, hi)] - lo
        breaks = kind == 2
        breaks[opens] = True
        first = solid.copy()
        first[1:] &= ~solid[:-1] | breaks[1:]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        up, down = _powers(len(part))
        h = np.add.reduceat(values[part] * up[: len(part)], starts) * down[starts]
        rows = np.searchsorted(bounds, starts + lo, side="right") - 1
        h = mix(h ^ labels[rows])
        h[h == 0] = 1
        yield Words(h, starts + lo, np.add.reduceat(solid, starts, dtype=np.int64), np.cumsum(breaks)[starts], rows)


def _gathered(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A string array of the words at these places, A-Z lower-cased."""
    ends = np.cumsum(lengths)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw[at]]))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct sorted keys, where one of each stands, and their summed counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], order[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _count_words(seed: int):
    values = _byte_values(seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            h, at, c = _summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            lang = pa.concat_arrays([x[2] for x in held]).take(pa.array(at))
            word = pa.concat_arrays([x[3] for x in held]).take(pa.array(at))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), lang, word, pa.array(c)], names=["h", "lang", "word", "c"])

        for batch in by_bytes(batches, 0, BATCH_BYTES):
            raw, bounds = string_views(batch.column(0))
            lang = batch.column(1)
            codes = lang.dictionary_encode()
            table = np.array([_label_hash(x, seed) for x in codes.dictionary.to_pylist()], np.uint64)
            found = list(words_of(raw, bounds, table[codes.indices.to_numpy()], values))
            if not found:
                continue
            h = np.concatenate([w.hashes for w in found])
            h, at, c = _summed(h, np.ones(len(h), np.int64))
            starts, lengths, rows = (np.concatenate([getattr(w, f) for w in found])[at] for f in ("starts", "lengths", "rows"))
            held.append((h, c, lang.take(pa.array(rows)), _gathered(raw, starts, lengths)))
            n += len(h)
            if n >= FLUSH_WORDS:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    return run


def vocabulary(texts: DataFrame, seed: int = 0) -> tuple[DataFrame, int]:
    """(h, lang, word, c) for every word of ``texts`` (columns text, lang) and
    the seed under which all hashes differ."""
    while True:
        parts = texts.mapInArrow(_count_words(seed), "h long, lang string, word string, c long")
        words = saved(parts.groupBy("h", "lang", "word").agg(F.sum("c").alias("c")), "words")
        if not words.groupBy("h").count().where("count > 1").limit(1).count():
            return words, seed
        seed += 1


# -- bitmaps -----------------------------------------------------------------


@dataclass
class Bitmap:
    """Bits at the leading ``bits`` bits of 64-bit hashes."""

    bits: int
    data: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap(rows: DataFrame, column: str, n: int) -> Bitmap:
    """A bitmap of the ``n`` hashes in ``column``, 64 bits a hash up to the bound."""
    bits = min(MAX_BITS, max(15, int(64 * max(n, 1) - 1).bit_length()))
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    found = rows.groupBy(F.shiftright(place, 15).cast("int").alias("b")).agg(F.expr(f"bitmap_construct_agg(shiftrightunsigned({column}, {64 - bits}) & 32767)").alias("m"))
    data = np.zeros(1 << (bits - 3), np.uint8)
    for b, m in found.toLocalIterator():
        data[b << 12 : (b << 12) + len(m)] = np.frombuffer(bytes(m), np.uint8)
    return Bitmap(bits, data)


# -- prefixes ----------------------------------------------------------------


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a * _M1 + _GOLD) + b)


def _texts_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Words]:
    values = _byte_values(seed)
    for batch in by_bytes(batches, 0, BATCH_BYTES):
        raw, bounds = string_views(batch.column(0))
        codes = batch.column(1).dictionary_encode()
        table = np.array([_label_hash(x, seed) for x in codes.dictionary.to_pylist()], np.uint64)
        yield from words_of(raw, bounds, table[codes.indices.to_numpy()], values)


def _packs(keys: np.ndarray, groups: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch | None:
    """One row a group: its rows of ``columns``, one column after the other."""
    if not len(keys):
        return None
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.append(first[1:], len(groups))
    blobs = [b"".join(c[s:e].tobytes() for c in columns) for s, e in zip(first.tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(groups[first]), pa.array(ends - first), pa.array(blobs, pa.binary())], names=["g", "n", "blob"])


PACK = "g long, n long, blob binary"


def _count_pairs(words, seed: int, split: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            k, _, c = _summed(np.concatenate(held), np.ones(n, np.int64))
            return _packs(k, (k >> np.uint64(64 - split)).astype(np.int64), [k, c.astype(np.uint32)])

        for w in _texts_words(batches, seed):
            known = words.value.has(w.hashes)
            ok = known[:-1] & known[1:] & (w.pieces[:-1] == w.pieces[1:])
            pairs = _pair(w.hashes[:-1][ok], w.hashes[1:][ok])
            if len(pairs):
                held.append(pairs)
                n += len(pairs)
            if n >= FLUSH_WORDS:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    return run


def _add_pairs(min_count: int):
    def run(group: pa.Table) -> pa.Table:
        keys, counts = [], []
        for n, blob in zip(group.column("n").to_pylist(), group.column("blob")):
            data = memoryview(blob.as_buffer())
            keys.append(np.frombuffer(data[: 8 * n], np.uint64))
            counts.append(np.frombuffer(data[8 * n :], np.uint32).astype(np.int64))
        k, _, c = _summed(np.concatenate(keys), np.concatenate(counts))
        often = c >= min_count
        return pa.table({"p": k[often].view(np.int64), "c": c[often]})

    return run


def pair_counts(texts: DataFrame, words: Bitmap, seed: int, n_words: int, min_count: int) -> DataFrame:
    """(p, c): hashes and counts of the two-word prefixes of at least ``min_count``."""
    split = min(24, max(3, (n_words >> 20).bit_length()))
    sent = texts.sparkSession.sparkContext.broadcast(words)
    parts = texts.mapInArrow(_count_pairs(sent, seed, split), PACK)
    pairs = saved(parts.groupBy("g").applyInArrow(_add_pairs(min_count), "p long, c long"), "pairs")
    sent.destroy()
    return pairs


@dataclass
class Partition:
    """Prefix hash -> group. Prefixes go by ranges of their hash; ``heavy`` ones
    are dealt over ``heavy_n`` groups from ``heavy_base`` on by their whole suffix."""

    base: np.ndarray
    parts: np.ndarray
    heavy: np.ndarray
    heavy_base: np.ndarray
    heavy_n: np.ndarray
    light: int  # groups below this number belong to ranges

    def groups(self, prefixes: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
        top = (prefixes >> np.uint64(48)).astype(np.int64)
        low = ((prefixes >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype(np.float64) / 4294967296.0
        out = self.base[top] + (low * self.parts[top]).astype(np.int64)
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, prefixes), len(self.heavy) - 1)
            hit = self.heavy[at] == prefixes
            out[hit] = self.heavy_base[at[hit]] + (suffixes[hit] % self.heavy_n[at[hit]].astype(np.uint64)).astype(np.int64)
        return out


def partition(pairs: DataFrame, total: int, budget: int) -> Partition:
    """Groups of about ``budget`` positions from the prefix counts."""
    limit = max(budget, total >> 20)
    heavy = sorted((r.p % (1 << 64), r.c) for r in pairs.where(F.col("c") > limit).collect())
    sums = np.zeros(1 << 16, np.int64)
    for top, c in pairs.where(F.col("c") <= limit).groupBy(F.shiftrightunsigned("p", 48).cast("int")).agg(F.sum("c")).collect():
        sums[top] = c
    base, parts = np.zeros(1 << 16, np.int64), np.maximum(1, -(-sums // budget))
    group, held = 0, 0
    for i, s in enumerate(sums.tolist()):
        if held and held + s > budget:
            group, held = group + 1, 0
        base[i] = group
        held += s
        if parts[i] > 1:
            group, held = group + int(parts[i]), 0
    light = group + 1
    heavy_n = np.array([-(-c // budget) for _, c in heavy], np.int64)
    heavy_base = light + np.concatenate([[0], np.cumsum(heavy_n)[:-1]]).astype(np.int64) if heavy else heavy_n
    return Partition(base, parts, np.array([p for p, _ in heavy], np.uint64), heavy_base, heavy_n, light)


# -- suffixes and subtrees ---------------------------------------------------


def _merged(paths: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal paths as one leaf with a total, ordered by their hash."""
    order = np.argsort(hashes)
    paths, hashes = paths[order], hashes[order]
    new = np.ones(len(paths), bool)
    new[1:] = (paths[1:] != paths[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return paths[first], np.add.reduceat(counts[order], first), hashes[first]


def _send_suffixes(shared, seed: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, part = shared.value
        held, n = [], 0

        def flush():
            paths = np.concatenate(held)
            whole = paths[:, 0]
            for d in range(1, depth):
                whole = _pair(whole, paths[:, d])
            paths, counts, whole = _merged(paths, np.ones(len(paths), np.int64), whole)
            groups = part.groups(_pair(paths[:, 0], paths[:, 1]), whole)
            order = np.argsort(groups, kind="stable")
            return _packs(groups[order], groups[order], [paths[order], counts[order].astype(np.uint32)])

        for w in _texts_words(batches, seed):
            h = w.hashes
            if len(h) < 2:
                continue
            near = np.zeros(len(h), bool)
            known = words.has(h)
            at = np.flatnonzero(known[:-1] & known[1:] & (w.pieces[:-1] == w.pieces[1:]))
            near[at] = pairs.has(_pair(h[at], h[at + 1]))
            at = np.flatnonzero(near)
            if not len(at):
                continue
            paths = np.zeros((len(at), depth), np.uint64)
            paths[:, 0], paths[:, 1] = h[at], h[at + 1]
            go, i = np.arange(len(at)), at
            for d in range(2, depth):
                on = near[i + 1]
                go, i = go[on], i[on] + 1
                paths[go, d] = h[i + 1]
            held.append(paths)
            n += len(at)
            if n >= FLUSH_WORDS:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    return run


def subtree(paths: np.ndarray, totals: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, paths, counts) of the nodes of depth 2 and more of the tree that
    these leaves make; nodes below ``least`` are left out."""
    order = np.lexsort(paths.T[::-1])
    paths, totals = paths[order], totals[order]
    new = np.zeros(len(paths), bool)
    if len(new):
        new[0] = True
    for d in range(1, paths.shape[1] + 1):
        new[1:] |= paths[1:, d - 1] != paths[:-1, d - 1]
        if d == 1:
            continue
        first = np.flatnonzero(new)
        if not len(first):
            continue
        sums = np.add.reduceat(totals, first)
        node = (paths[first, d - 1] != 0) & (sums >= least)
        yield d, paths[first[node], :d], sums[node]


def _build(depth: int, min_count: int, light: int):
    def run(group: pa.Table) -> pa.Table:
        paths, totals = [], []
        for n, blob in zip(group.column("n").to_pylist(), group.column("blob")):
            data = memoryview(blob.as_buffer())
            paths.append(np.frombuffer(data[: 8 * n * depth], np.uint64).reshape(n, depth))
            totals.append(np.frombuffer(data[8 * n * depth :], np.uint32).astype(np.int64))
        least = min_count if group.column("g")[0].as_py() < light else 1
        keys, counts, depths = [], [], []
        for d, nodes, sums in subtree(np.concatenate(paths), np.concatenate(totals), least):
            flat = np.ascontiguousarray(nodes.astype(">u8"))
            offsets = np.arange(len(nodes) + 1, dtype=np.int32) * (8 * d)
            keys.append(pa.Array.from_buffers(pa.binary(), len(nodes), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]))
            counts.append(sums)
            depths.append(np.full(len(sums), d, np.int32))
        if not keys:
            return pa.table({"key": pa.array([], pa.binary()), "m": pa.array([], pa.int32()), "a": pa.array([], pa.int64())})
        return pa.table({"key": pa.concat_arrays(keys), "m": np.concatenate(depths), "a": np.concatenate(counts)})

    return run


def phrase_counts(
    texts: DataFrame, words: DataFrame, seed: int, max_words: int = 5, min_count: int = 100, budget: int = BUDGET
) -> DataFrame:
    """(key, m, a): all phrases of 2 to ``max_words`` words with count ``a`` of at
    least ``min_count``; ``key`` holds the words' hashes, 8 bytes each."""
    spark = texts.sparkSession
    often = words.where(F.col("c") >= min_count)
    n_words, n_often = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") >= min_count)).first()
    known = bitmap(often, "h", n_often)
    pairs = pair_counts(texts, known, seed, n_words, min_count)
    n_pairs, total = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    part = partition(pairs, total, budget)
    shared = spark.sparkContext.broadcast((known, bitmap(pairs, "p", n_pairs), part))
    leaves = texts.mapInArrow(_send_suffixes(shared, seed, max_words), PACK)
    nodes = leaves.groupBy("g").applyInArrow(_build(max_words, min_count, part.light), "key binary, m int, a long")
    out = saved(nodes.groupBy("key", "m").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count), "phrases")
    shared.destroy()
    return out


# -- scores ------------------------------------------------------------------


def _salted(key: str, of: str):
    """Keys of one or two words are looked up by many phrases."""
    return F.expr(f"CASE WHEN length({key}) <= 16 THEN cast(pmod(xxhash64({of}), {SALTS}) AS int) ELSE 0 END")


def scored(phrases: DataFrame, words: DataFrame, max_words: int = 5, min_count: int = 100) -> DataFrame:
    """(lang, key, m, a, l, r, n, score) of the phrases that no longer phrase of
    the same count contains. A phrase's containing phrase has one word more on
    one side, so two extensions decide. Integer arithmetic of 38 digits."""
    cut = F.when(F.col("m") > 2, F.expr("array(substring(key, 1, 8 * (m - 1)), substring(key, 9, 8 * (m - 1)))"))
    inner = phrases.where("m > 2").select(F.explode(cut).alias("key"), F.lit(0).cast("long").alias("a"), F.col("a").alias("longer"))
    kept = (
        phrases.select("key", "a", F.lit(0).cast("long").alias("longer")).unionByName(inner)
        .groupBy("key").agg(F.max("a").alias("a"), F.max("longer").alias("longer")).where("longer < a")
        .select("key", (F.length("key") / 8).cast("int").alias("m"), "a")
    )
    wanted = kept.select(
        F.col("key").alias("whole"), "m", "a",
        F.explode(F.expr("flatten(transform(sequence(1, m - 1), k -> array(struct(k, 'l' AS side, substring(key, 1, 8 * k) AS key), struct(k, 'r' AS side, substring(key, 8 * k + 1, 8 * (m - k)) AS key))))")).alias("w"),
    ).select("whole", "m", "a", "w.k", "w.side", "w.key")
    one = words.where(F.col("c") >= min_count).select(F.expr("unhex(lpad(hex(h), 16, '0'))").alias("key"), F.col("c").alias("f"), "lang")
    counts = one.unionByName(phrases.select("key", F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")))
    counts = counts.withColumn("salt", F.explode(F.expr(f"CASE WHEN length(key) <= 16 THEN sequence(0, {SALTS - 1}) ELSE array(0) END")))
    found = wanted.withColumn("salt", _salted("key", "whole")).join(counts, ["key", "salt"])

    def of(k: int, side: str):
        return F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")

    wide = found.groupBy("whole", "m", "a").agg(
        F.max(F.when((F.col("k") == 1) & (F.col("side") == "l"), F.col("lang"))).alias("lang"),
        *[of(k, side) for k in range(1, max_words) for side in "lr"],
    )
    sizes = words.groupBy("lang").agg(F.sum("c").alias("n"))
    cuts = ", ".join(
        f"CASE WHEN m > {k} THEN named_struct('score', cast(floor((cast(1000 AS decimal(4,0)) * cast(a AS decimal(15,0)) * cast(n AS decimal(15,0)))"
        f" div (cast(l{k} AS decimal(19,0)) * cast(r{k} AS decimal(19,0)))) AS bigint), 'k', {k}, 'l', l{k}, 'r', r{k}) END"
        for k in range(1, max_words)
    )
    best = wide.join(sizes, "lang").withColumn("best", F.expr(f"array_min(filter(array({cuts}), x -> x IS NOT NULL))"))
    return best.select("lang", F.col("whole").alias("key"), "m", "a", "best.l", "best.r", "n", "best.score")


def collocations(
    docs: DataFrame, top: int = 2000, max_words: int = 5, min_count: int = 100, budget: int = BUDGET, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The ``top`` collocations of every language: (lang, rank, phrase, a, l, r,
    n, score), by score, then count, then phrase (bytes).

    Null texts are empty, a null language is ``und``; texts without words, an
    empty table and languages without frequent phrases give no rows. Repeated
    rows count each time. Other columns of ``docs`` are not looked at.
    """
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    words, seed = vocabulary(texts)
    phrases = phrase_counts(texts, words, seed, max_words, min_count, budget)
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = saved(scored(phrases, words, max_words, min_count).withColumn("place", F.rank().over(near)).where(F.col("place") <= top), "collocations")
    spelled = (
        first.select("key", F.posexplode(F.expr("transform(sequence(1, m), i -> substring(key, 8 * i - 7, 8))")).alias("i", "h"))
        .join(words.where(F.col("c") >= min_count).select(F.expr("unhex(lpad(hex(h), 16, '0'))").alias("h"), "word"), "h")
        .groupBy("key").agg(F.expr("array_join(transform(array_sort(collect_list(struct(i, word))), x -> x.word), ' ')").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = first.join(spelled, "key").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
