"""Shared helpers: table access, written intermediate tables, and vectorised
word and shingle hashing over Arrow string buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from pulsegrid.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and reread it:
    cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_counted(df: DataFrame, tag: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``saved`` and aggregates over the rows, observed while they are written."""
    seen = Observation()
    out = saved(df.observe(seen, *[c.alias(k) for k, c in counts.items()]), tag)
    return out, seen.get


def string_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column without copying; nulls are empty.
    Row i is ``bytes[bounds[i]:bounds[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text column of each holds about ``limit``
    bytes at most (a longer single row comes alone)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, bounds = string_views(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def lowest_hashed(df: DataFrame, column: str, n: int) -> DataFrame:
    """The rows whose ``column`` is among the ``n`` distinct non-null values of
    lowest hash. Only hashes are sorted, so a task never gathers texts."""
    from pyspark.sql import functions as F

    h = F.xxhash64(column)
    hashes = df.where(F.col(column).isNotNull()).select(h.alias("h")).distinct().orderBy("h").limit(n)
    cut = hashes.agg(F.max("h")).first()[0]
    return df.where(F.lit(False)) if cut is None else df.where(F.col(column).isNotNull() & (h <= F.lit(cut)))


# -- hashing -----------------------------------------------------------------

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15 | 1
_SEGMENT = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_PUNCT = _SPACE.copy()
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_TABLES = {False: (_SPACE, np.where(_SPACE, 0, _BYTE)), True: (_PUNCT, np.where(_PUNCT, 0, _BYTE))}
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, _SEGMENT + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(raw: np.ndarray, bounds: np.ndarray, punctuation: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of
    every row, and the row bounds in that array. With ``punctuation``, ASCII
    punctuation parts words like white space does. Works through the bytes in
    segments cut at white space, so memory stays a few times the input."""
    space, table = _TABLES[punctuation]
    total = len(raw)
    parts, starts_all, at = [], [], 0
    is_start = np.zeros(total + 1, bool)
    is_start[bounds] = True
    while at < total:
        end = min(at + _SEGMENT, total)
        while end < total and not space[raw[end]] and not is_start[end]:
            more = min(end + 4096, total)
            stop = np.flatnonzero(space[raw[end:more]] | is_start[end:more])
            end = end + int(stop[0]) if len(stop) else more
        seg = raw[at:end]
        solid = ~space[seg]
        first = solid.copy()
        first[1:] &= ~solid[:-1] | is_start[at + 1 : end]
        starts = np.flatnonzero(first)
        if len(starts):
            up, down = _powers(len(seg))
            parts.append(mix(np.add.reduceat(table[seg] * up[: len(seg)], starts) * down[starts]))
            starts_all.append(starts + at)
        at = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate(parts), np.searchsorted(np.concatenate(starts_all), bounds)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words of one text; of the whole sequence if
    it has fewer words; nothing for no words."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width)) * _GOLD
    for j in range(width):
        h = mix(h * _M1 + words[j : n - width + 1 + j])
    return h
