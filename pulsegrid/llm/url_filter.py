"""URL filter: allow and block rules, and a character language-model ratio for
URLs that no rule decides.

Two variable-order Markov models over bytes, one of accepted and one of
rejected URLs, are smoothed by Witten-Bell interpolation from order ``order``
down to a uniform byte. A URL's score is the mean log-likelihood difference
per byte; it is blocked below a threshold calibrated on URLs accepted for a
reason (an allow rule, no seed word; with fewer than 1 / ``false_block`` of
them, undecided ones too), so that at most ``false_block`` of those would be
lost: the quantile is exact and over all of them, scored in Spark.

The models count every distinct training URL, in Spark: (order, context, byte)
with contexts hashed into 2 ** ``BIN_BITS`` bins an order, so that what is
broadcast stays bounded. Rejected are URLs whose host holds a seed word or is
blocked as a whole by a rule. A rule that blocks a path says nothing about the
host; such URLs train no class (they are the rejected ones if there are no
others). URLs allowed by a rule and, at first, the undecided ones are accepted;
in ``rounds`` rounds of self-training undecided URLs below the threshold are
taken out (they never enter the rejected class, so an error does not feed
itself). No host vouches for itself: hosts are dealt by hash into ``FOLDS``
folds, and a URL is scored by the accepted URLs of the other folds.

A null URL or one without ``://`` has an empty host and path and is scored as
the text it is; an empty text, or a missing class, is allowed. Repeated rows
give one output row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, mix, saved, string_views
from pulsegrid.operators.metrics import exact_quantiles

#: Host words of link farms, pill shops and gambling; fixed values.
SEED_WORDS = ("spam", "casino", "poker", "betting", "pills", "pharma", "viagra", "cialis", "porn", "xxx", "escort", "payday", "replica", "warez", "torrent")

#: Contexts of an order are hashed into 2 ** BIN_BITS bins.
BIN_BITS = 16
#: Folds of hosts.
FOLDS = 4
# Kinds of training URLs, and of undecided ones that were taken out.
ALLOWED, REJECTED, UNDECIDED, PATH_BLOCKED, TAKEN_OUT = range(5)

Rules = list[tuple[str, str]]  # (verdict, host/path)


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits the host (or a domain above it) and the
    beginning of the path; null if none does."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


# -- Markov models -----------------------------------------------------------


def _contexts(raw: np.ndarray, bounds: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order k: 64-bit keys of the k bytes before every byte, and of
    these with the byte. Bytes before a text are zero."""
    n = len(raw)
    place = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    nxt = raw.astype(np.uint64) + np.uint64(1)
    key = np.zeros(n, np.uint64)
    for k in range(order + 1):
        if k:
            back = np.zeros(n, np.uint64)
            back[k:] = nxt[:-k]
            back[place < k] = 0
            key = mix(key * np.uint64(257) + back + np.uint64(k << 32))
        yield key, mix(key ^ (nxt * np.uint64(0x9E3779B97F4A7C15)))


def _slots(raw: np.ndarray, bounds: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For each order: (order, context bin, byte) of every byte as one number below 2 ** 32."""
    for k, (ctx, _) in enumerate(_contexts(raw, bounds, order)):
        yield (k << 24 | (ctx >> np.uint64(64 - BIN_BITS)).astype(np.int64) << 8 | raw).astype(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and their summed counts."""
    every, where = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    return every, np.bincount(where, weights=np.concatenate([np.zeros(0), *counts]), minlength=len(every))


def _lookup(keys: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(at))
    i = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
    return np.where(keys[i] == at, values[i], 0.0)


class MarkovModel:
    """Byte model of variable order with Witten-Bell interpolation."""

    def __init__(self, texts: list[str], order: int = 4):
        self.order, self.tables, self.binned = order, [], False
        raw, bounds = string_views(pa.array(texts, pa.string()))
        for ctx, gram in _contexts(raw, bounds, order):
            grams, first, count = np.unique(gram, return_index=True, return_counts=True)
            ctxs, where = np.unique(ctx[first], return_inverse=True)
            total = np.bincount(where, weights=count, minlength=len(ctxs))
            kinds = np.bincount(where, minlength=len(ctxs)).astype(float)
            self.tables.append((grams, count.astype(float), ctxs, total, kinds))

    @classmethod
    def of_counts(cls, slots: np.ndarray, counts: np.ndarray, order: int) -> MarkovModel:
        """From ascending distinct slots and their counts."""
        model = cls.__new__(cls)
        model.order, model.tables, model.binned = order, [], True
        for k in range(order + 1):
            a, b = np.searchsorted(slots, [k << 24, (k + 1) << 24])
            ctxs, first = np.unique(slots[a:b] >> 8, return_index=True)
            total = np.add.reduceat(counts[a:b], first) if b > a else np.zeros(0)
            model.tables.append((slots[a:b], counts[a:b], ctxs, total, np.diff(np.append(first, b - a)).astype(float)))
        return model

    def _keys(self, raw: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return ((slot >> 8, slot) for slot in _slots(raw, bounds, self.order)) if self.binned else _contexts(raw, bounds, self.order)

    def log_likelihood(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sum of log probabilities of each text."""
        p = np.full(len(raw), 1 / 256)
        for (ctx, gram), (grams, count, ctxs, total, kinds) in zip(self._keys(raw, bounds), self.tables):
            n, t = _lookup(ctxs, total, ctx), _lookup(ctxs, kinds, ctx)
            p = np.where(n > 0, (_lookup(grams, count, gram) + t * p) / np.maximum(n + t, 1), p)
        ends = np.concatenate([[0.0], np.cumsum(np.log(p))])
        return ends[bounds[1:]] - ends[bounds[:-1]]


class RatioFilter:
    """Accepted against rejected model with a calibrated threshold."""

    def __init__(self, accepted: list[str], rejected: list[str], order: int = 4, false_block: float = 0.005):
        self.ready = bool(accepted) and bool(rejected)
        if not self.ready:
            return
        held = accepted[::5] if len(accepted) >= 5 else accepted
        kept = [u for i, u in enumerate(accepted) if i % 5] or accepted
        self.models = MarkovModel(kept, order), MarkovModel(rejected, order)
        self.threshold = min(0.0, float(np.quantile(self.scores(pa.array(held, pa.string())), false_block)))

    def scores(self, urls: pa.Array) -> np.ndarray:
        """Log-likelihood difference per byte; 0 for an empty URL."""
        raw, bounds = string_views(urls)
        if not self.ready:
            return np.zeros(len(bounds) - 1)
        good, bad = (m.log_likelihood(raw, bounds) for m in self.models)
        return (good - bad) / np.maximum(np.diff(bounds), 1)

    def allowed(self, scores: np.ndarray) -> np.ndarray:
        return scores >= self.threshold if self.ready else np.ones(len(scores), bool)


class FoldedFilter:
    """Accepted against rejected models for every fold of hosts, from counts by (kind, fold, slot).

    The threshold is fitted after the models and goes to the tasks beside them."""

    def __init__(self, slots: np.ndarray, counts: np.ndarray, order: int):
        def part(kind: int, folds: list[int]) -> tuple[list, list]:
            cuts = [np.searchsorted(slots, [(kind * FOLDS + f) << 32, (kind * FOLDS + f + 1) << 32]) for f in folds]
            return [slots[a:b] & 0xFFFFFFFF for a, b in cuts], [counts[a:b] for a, b in cuts]

        def model(parts: list[tuple[list, list]]) -> MarkovModel | None:
            keys, n = _merged([x for p in parts for x in p[0]], [x for p in parts for x in p[1]])
            return MarkovModel.of_counts(keys, n, order) if len(keys) else None

        every = list(range(FOLDS))
        rejected = part(REJECTED, every)
        if not any(map(len, rejected[0])):
            rejected = part(PATH_BLOCKED, every)
        self.models, bad = [], model([rejected])
        for fold in every:
            others = [f for f in every if f != fold]
            good = model([part(k, others) for k in (ALLOWED, UNDECIDED)]) or model([part(k, every) for k in (ALLOWED, UNDECIDED)])
            self.models.append((good, bad))
        self.ready = all(g is not None and b is not None for g, b in self.models)

    def scores(self, urls: pa.Array, folds: np.ndarray) -> np.ndarray:
        """Log-likelihood difference per byte; 0 for an empty URL."""
        out = np.zeros(len(urls))
        for fold, (good, bad) in enumerate(self.models if self.ready else []):
            at = np.flatnonzero(folds == fold)
            raw, bounds = string_views(urls.take(pa.array(at)))
            out[at] = (good.log_likelihood(raw, bounds) - bad.log_likelihood(raw, bounds)) / np.maximum(np.diff(bounds), 1)
        return out

    def allowed(self, scores: np.ndarray, threshold: float) -> np.ndarray:
        return scores >= threshold if self.ready else np.ones(len(scores), bool)


def _counter(shared, threshold: float, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: FoldedFilter | None = shared and shared.value
        keys, counts = np.zeros(0, np.int64), np.zeros(0)
        for batch in by_bytes(batches, 0, 1 << 19):
            urls, folds, kinds = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            if model is not None:
                kinds = np.where((kinds == UNDECIDED) & ~model.allowed(model.scores(urls, folds), threshold), TAKEN_OUT, kinds)
            raw, bounds = string_views(urls)
            group = np.repeat((kinds.astype(np.int64) * FOLDS + folds) << 32, np.diff(bounds))
            fresh, n = np.unique(np.concatenate([group | slot for slot in _slots(raw, bounds, order)]), return_counts=True)
            keys, counts = _merged([keys, fresh], [counts, n])
            if len(keys) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["slot", "n"])
                keys, counts = np.zeros(0, np.int64), np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["slot", "n"])

    return run


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 0, 1 << 21):
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.scores(batch.column(0), batch.column(1).to_numpy()))], names=["score"])

    return run


def _learn(urls: DataFrame, order: int, false_block: float, rounds: int) -> tuple:
    """Broadcast models and their threshold, from distinct URLs (u, fold, kind)."""
    spark = urls.sparkSession
    held = urls.where(F.col("kind") == ALLOWED)
    if held.count() * false_block < 1:
        held = urls.where(F.col("kind").isin(ALLOWED, UNDECIDED))
    shared, threshold = None, 0.0
    while True:
        counted = urls.mapInArrow(_counter(shared, threshold, order), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        slots = counted.column("slot").to_numpy()
        at = np.argsort(slots)
        model = FoldedFilter(slots[at], counted.column("n").to_numpy()[at].astype(float), order)
        shared, threshold = spark.sparkContext.broadcast(model), 0.0
        if not model.ready:
            return shared, threshold
        (cut,) = exact_quantiles(held.select("u", "fold").mapInArrow(_scores(shared), "score double"), "score", [false_block])
        threshold = min(0.0, cut) if cut is not None else 0.0
        if rounds == 0:
            return shared, threshold
        rounds -= 1


def _scorer(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: FoldedFilter = shared.value
        for batch in by_bytes(batches, 4, 1 << 21):
            scores = model.scores(batch.column(4), batch.column(5).to_numpy())
            verdict = np.where(model.allowed(scores, threshold), "allow", "block")
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(verdict, pa.string()), pa.array(scores)], names=["page_id", "host", "path", "rule", "judged", "score"])

    return run


def filter_urls(
    pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url", sample: int = 8000, order: int = 4, false_block: float = 0.005, rounds: int = 2
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row. ``sample`` is
    kept for callers and bounds nothing: every accepted URL calibrates."""
    url = F.col("url")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.lower(F.coalesce(url, F.lit(""))).alias("u"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    kinds = {rule: verdict for verdict, rule in rules}
    ruled = F.lit(None).cast("string")
    for rule, verdict in kinds.items():
        ruled = F.when(F.col("rule") == rule, verdict).otherwise(ruled)
    seeded = F.col("host").rlike("(^|[.-])(" + "|".join(SEED_WORDS) + ")([.-]|$)")
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)))
    whole = [rule for verdict, rule in rules if verdict == "block" and not rule.partition("/")[2]]
    kind = F.when(seeded | F.coalesce(F.col("rule").isin(whole), F.lit(False)), REJECTED).when(ruled == "allow", ALLOWED).when(ruled == "block", PATH_BLOCKED).otherwise(UNDECIDED)
    urls = saved(rows.select("u", "fold", kind.cast("long").alias("kind")).distinct(), "urls")
    shared, threshold = _learn(urls, order, false_block, rounds)
    kind = "page_id long, host string, path string, rule string, judged string, score double"
    judged = rows.select("page_id", "host", "path", "rule", "u", "fold").mapInArrow(_scorer(shared, threshold), kind)
    return judged.withColumn("verdict", F.coalesce(ruled, F.col("judged"))).select("page_id", "host", "path", "rule", "verdict", "score")
