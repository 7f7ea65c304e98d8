"""Language identification with a blended-spectrum presence kernel.

A text is cut into segments of ``SEGMENT`` bytes; a segment is the set of its
byte n-grams of lengths 1 to 4 (lower-cased), hashed into ``BINS`` places.
k(x, z) = |x & z| / sqrt(|x| |z|). Landmark segments of every language give a
Nyström map of the kernel, and one-versus-rest kernel ridge regression in that
map one weight vector per language, so all scores of a batch are two matrix
products. A text's scores are the means over its segments weighted by their
n-gram counts.

At most ``sample`` texts of each language train the model (a documented bound,
lowest hashes first), and whole texts are scored. A null text or one without
a letter is ``und`` with score 0; equal scores go to the language that sorts
first; with no training text everything is ``und``. Repeated rows give one
output row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes

SEGMENT = 2048
BINS = 1 << 13
LENGTHS = (1, 2, 3, 4)
_MULT = np.uint32(2654435761)
_BATCH_BYTES = 1 << 19


def spectra(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(presence rows by segment, text of each segment)."""
    raws = [t.lower().encode("utf-8") for t in texts]
    sizes = np.array([len(r) for r in raws], np.int64)
    per = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), per)
    out = np.zeros((len(owner), BINS), np.uint8)
    flat = out.reshape(-1)
    first = np.concatenate([[0], np.cumsum(per)])
    for i, raw in enumerate(raws):
        if not raw:
            continue
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        base = (first[i] + np.arange(len(b)) // SEGMENT) * BINS
        key = np.zeros(len(b), np.uint32)
        for n in range(1, max(LENGTHS) + 1):
            if len(b) < n:
                break
            key = key[: len(b) - n + 1] * np.uint32(257) + b[n - 1 :] + np.uint32(1)
            if n in LENGTHS:
                at = ((key ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * _MULT) >> np.uint32(32 - 13)
                flat[base[: len(key)] + at] = 1
    return out, owner


class KernelRidge:
    """Nyström features on landmark segments and one-versus-rest ridge weights."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = 160, ridge: float = 1e-2):
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        rows, owner = spectra(texts)
        y = np.array([self.langs.index(x) for x in langs])[owner]
        x = self._unit(rows)
        rng = np.random.default_rng(0)
        each = max(1, landmarks // len(self.langs))
        marks = np.concatenate([rng.permutation(np.flatnonzero(y == k))[:each] for k in range(len(self.langs))])
        self.marks = np.ascontiguousarray(x[marks].T)
        k = (x[marks] @ self.marks).astype(np.float64)
        value, vector = np.linalg.eigh(k)
        fine = value > 1e-6 * value.max()
        nystrom = vector[:, fine] / np.sqrt(value[fine])
        z = (x @ self.marks).astype(np.float64) @ nystrom
        z = np.hstack([z, np.ones((len(z), 1))])
        share = np.bincount(y, minlength=len(self.langs))
        w = 1 / share[y]  # every language weighs the same
        target = np.where(y[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        gram = (z * w[:, None]).T @ z + ridge * np.eye(z.shape[1]) / len(share)
        beta = np.linalg.solve(gram, (z * w[:, None]).T @ target)
        self.weights = (nystrom @ beta[:-1]).astype(np.float32)
        self.bias = beta[-1].astype(np.float32)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        n = rows.sum(axis=1, dtype=np.int64).astype(np.float32)
        return rows.astype(np.float32) / np.sqrt(np.maximum(n, 1))[:, None]

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score in 0..1) of each text."""
        known = [t or "" for t in texts]
        best, score = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return best, score
        total = np.zeros((len(texts), len(self.langs)))
        mass = np.zeros(len(texts))
        at = 0
        while at < len(known):  # segments of a bounded number of bytes at a time
            end, size = at, 0
            while end < len(known) and (end == at or size + len(known[end]) <= _BATCH_BYTES):
                size += len(known[end]) + SEGMENT
                end += 1
            for piece, owner_of in _chunks(known[at:end]):
                rows, owner = spectra(piece)
                s = (self._unit(rows) @ self.marks) @ self.weights + self.bias
                n = rows.sum(axis=1, dtype=np.int64)
                where = at + np.asarray(owner_of)[owner]
                np.add.at(total, where, s * n[:, None])
                np.add.at(mass, where, n)
            at = end
        mean = total / np.maximum(mass, 1)[:, None]
        top = mean.argmax(axis=1)
        soft = np.exp(4 * (mean - mean.max(axis=1, keepdims=True)))
        soft /= soft.sum(axis=1, keepdims=True)
        for i, t in enumerate(known):
            if any(map(str.isalpha, t)):
                best[i], score[i] = self.langs[top[i]], soft[i, top[i]]
        return best, score


def _chunks(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
    """One long text in parts; else all texts together."""
    if len(texts) == 1 and len(texts[0]) > _BATCH_BYTES:
        for at in range(0, len(texts[0]), _BATCH_BYTES):
            yield [texts[0][at : at + _BATCH_BYTES]], [0]
    else:
        yield texts, list(range(len(texts)))


def train(docs: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang", sample: int = 300, clip: int = 1 << 14) -> KernelRidge:
    """Fit on at most ``sample`` texts a language among the rows ``where``
    holds; a training text longer than ``clip`` characters gives its middle."""
    rows = docs.where(where).where(F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    rows = rows.select("lang", F.when(F.length("t") > clip, F.substr("t", ((F.length("t") - clip) / 2).cast("int") + 1, F.lit(clip))).otherwise(F.col("t")).alias("t"))
    # only hashes are ranked per language; then the few texts below each cut are read
    h = F.xxhash64("t")
    ranked = rows.select("lang", h.alias("h")).distinct().withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    cuts = ranked.where(F.col("nth") <= sample).groupBy("lang").agg(F.max("h")).collect()  # a row for each language of the model
    if not cuts:
        return KernelRidge([], [])
    cut = F.element_at(F.create_map(*[F.lit(x) for r in cuts for x in r]), F.col("lang"))
    picked = rows.where(h <= cut).groupBy("lang", h.alias("h")).agg(F.first("t").alias("t")).select("lang", "t").collect()
    picked = sorted((r[0], r[1]) for r in picked)
    return KernelRidge([t for _, t in picked], [lang for lang, _ in picked])


def _decider(shared, at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: KernelRidge = shared.value
        for batch in by_bytes(batches, at, 1 << 20):
            lang, score = model.decide(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], schema=schema)

    return run


def identify(docs: DataFrame, model: KernelRidge, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the two named ones, which replace columns of
    the same names; no shuffle."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop(lang_name, score_name)
    kind = T.StructType([*docs.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_decider(shared, docs.columns.index(text_col), to_arrow_schema(kind)), kind)
