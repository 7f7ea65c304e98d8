"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every text (bad, good, or no vote).
Only the counts of vote patterns reach the driver (at most 3 ** labellers,
however many documents); there expectation-maximisation fits a two-class model
in which every labeller has its own rates of voting per class, and gives each
pattern its posterior. At most ``sample`` texts (a documented bound, lowest
hashes first) with their posteriors train a hashed linear scorer (logistic
regression on hashed words, binned statistics and votes), and the scorer
judges all texts. The same is done for abuse with its own labellers; one of
them counts word stems that a bounded sample of rows flagged as toxic shows and
unflagged rows do not, if such flags are given.

``quality`` is the probability of a good text, ``toxic`` of an abusive one;
a text is kept if quality >= 0.5 and toxic < 0.5. Null, empty and blank texts
have quality 0. Repeated rows give one output row each.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, lowest_hashed, saved, string_views, word_hashes

BITS = 15
BINS = 1 << BITS
BATCH_BYTES = 1 << 20

#: Common function words of English, German, French and Spanish; fixed values.
STOP_WORDS = frozenset(
    "the of and to in is that it for as with was on be at by this are or from an he have not they which you were but had "
    "der die und das von zu den mit sich des auf ist im dem nicht ein eine als auch es an er aus bei nach wird sind "
    "le la les de des et un une du en que est pour qui dans par sur au il ne pas plus avec ce se sont "
    "el los las del y una por con para su al lo como más pero sus le ha sin sobre este ya entre cuando".split()
)
#: Insults and words of contempt; fixed values.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers imbecile dumb dumbass fool fools jerk bastard bitch asshole cretin clown clowns "
    "retard retarded dimwit halfwit simpleton nitwit scumbag freak freaks".split()
)
CONTEMPT = frozenset(
    "scum trash garbage vermin filth filthy pathetic worthless disgusting despicable loathsome revolting subhuman "
    "parasite parasites degenerate degenerates useless hateful shit fuck fucking".split()
)
_STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_~`/\\"

_CLASS = {name: np.zeros(256, bool) for name in ("upper", "lower", "symbol", "space", "mark")}
_CLASS["upper"][65:91] = True
_CLASS["lower"][97:123] = True
_CLASS["lower"][128:] = True
_CLASS["symbol"][[ord(c) for c in "#$%&*|~^=+\\{}<>_@"]] = True
_CLASS["space"][[9, 10, 11, 12, 13, 32]] = True
_CLASS["mark"][[ord(c) for c in ".!?"]] = True

STATS = ("symbols", "upper", "shouts", "bars", "echo", "distinct", "stops", "marks", "twins", "letters", "words", "insults", "contempt", "abuse", "stems")
_EDGES = {
    "symbols": [0.002, 0.01, 0.03, 0.06, 0.12], "upper": [0.05, 0.12, 0.25, 0.4, 0.7], "shouts": [0.01, 0.05, 0.15, 0.4], "bars": [0.01, 0.05, 0.15, 0.4],
    "echo": [0.02, 0.05, 0.1, 0.2, 0.5], "distinct": [0.05, 0.1, 0.2, 0.35, 0.6, 0.8], "stops": [0.01, 0.03, 0.06, 0.1, 0.2], "marks": [0.005, 0.02, 0.05, 0.15, 0.3],
    "twins": [0.1, 0.3, 0.5], "letters": [0.6, 0.75, 0.85, 0.93], "words": [1, 5, 20, 100, 500, 2000], "insults": [0.5, 1.5, 3.5], "contempt": [0.5, 1.5, 3.5], "abuse": [0.001, 0.003, 0.01], "stems": [0.5, 1.5, 3.5],
}


#: Leading characters of a word that are looked up as its stem.
STEM_LENGTHS = (4, 5)


def stems_of(words) -> set[str]:
    """The stems of distinct lower-cased words longer than them."""
    return {w[:n] for w in (w.strip(_STRIP) for w in words) for n in STEM_LENGTHS if len(w) >= n}


def statistics(text: str, stems: frozenset[str] = frozenset()) -> list[float]:
    """The numbers of ``STATS`` for one text; shares are 0 for an empty one."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATS)
    lower = text.lower().split()
    seen = Counter(lower)
    hist = np.bincount(np.frombuffer(text.encode("utf-8"), np.uint8), minlength=256)
    part = {k: int(hist[m].sum()) for k, m in _CLASS.items()}
    solid = max(1, int(hist.sum()) - part["space"])
    letters = part["upper"] + part["lower"]
    lines = [x for x in text.split("\n") if x.strip()]
    insults = contempt = stops = learned = 0
    for w, k in seen.items():
        bare = w.strip(_STRIP)
        if stems and (bare[:4] in stems or bare[:5] in stems):
            learned += 1
        if bare in STOP_WORDS:
            stops += k
        elif bare in INSULTS:
            insults += k
        elif bare in CONTEMPT:
            contempt += k
    return [
        part["symbol"] / solid, part["upper"] / max(1, letters), int(hist[33]) / n, int(hist[124]) / n,
        sum(map(operator.eq, lower, lower[1:])) / n, len(seen) / n, stops / n, part["mark"] / n,
        1 - len(set(lines)) / len(lines), letters / solid, float(n), float(insults), float(contempt), (insults + contempt) / n, float(learned),
    ]


def quality_votes(s: list[float]) -> str:
    """One letter a labeller: b(ad), g(ood) or - (no vote)."""
    symbols, upper, shouts, bars, echo, distinct, stops, marks, twins, letters, words, *_ = s

    def vote(bad: bool, good: bool = False) -> str:
        return "b" if bad else "g" if good else "-"

    return "".join((
        vote(symbols > 0.05), vote(upper > 0.45 and words >= 5), vote(shouts > 0.15), vote(bars > 0.15 and words >= 5), vote(echo > 0.15 and words >= 8),
        vote(distinct < 0.12 and words >= 60), vote(stops < 0.01 and words >= 40, stops > 0.06 or words < 20), vote(marks < 0.005 and words >= 60, (marks > 0.01 or words < 20) and shouts < 0.05),
        vote(twins > 0.5), vote(letters < 0.5, upper < 0.4 and (letters > 0.88 or symbols < 0.03)), vote(words == 0, (echo < 0.06 or words < 30) and bars < 0.05),
    ))


def abuse_votes(s: list[float]) -> str:
    """The labellers of abuse: b is abusive."""
    words, insults, contempt, share, stems = s[-5:]
    return "".join((
        "b" if insults else "g", "b" if contempt else "g", "b" if share > 0.002 else "-" if share else "g",
        "b" if insults + contempt >= 2 else "-" if share else "g", "b" if stems >= 2 else "-" if stems else "g",
        "b" if stems >= 2 and stems > 0.005 * words else "-" if stems else "g",
    ))


# -- label model -----------------------------------------------------------------


def fit_label_model(patterns: dict[str, int], rounds: int = 60, start: int = 2) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of the bad class for every pattern, and the vote rates
    [class, labeller, vote] (class 1 is bad). Starts from patterns with
    ``start`` bad votes or more, or more bad than good ones."""
    keys = sorted(patterns)
    if not keys:
        return {}, np.zeros((2, 0, 3))
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([["-gb".index(c) for c in k] for k in keys])
    hot = np.eye(3)[votes]  # pattern, labeller, vote
    bad, good = (votes == 2).sum(axis=1), (votes == 1).sum(axis=1)
    post = np.where((bad >= start) | (bad > good), 0.95, 0.05)
    for _ in range(rounds):
        rates = np.empty((2, hot.shape[1], 3))
        share = np.empty(2)
        for c, p in enumerate((1 - post, post)):
            mass = n * p
            prior = np.array([0.5, 0.5, 5.0] if c else [0.5, 5.0, 0.05])  # a few rows that vote as they should
            rates[c] = (np.einsum("p,plv->lv", mass, hot) + prior) / (mass.sum() + prior.sum())
            share[c] = (mass.sum() + 1) / (n.sum() + 2)
        logs = np.log(share)[:, None] + np.einsum("plv,clv->cp", hot, np.log(rates))
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return dict(zip(keys, post.tolist())), rates


# -- hashed linear scorer --------------------------------------------------------


def _named(name: str) -> int:
    return int(word_hashes(*string_views(pa.array([name.replace(" ", "_")])))[0][0] >> np.uint64(64 - BITS))


_BIN_PLACE = {(k, i): _named(f"{k}:{i}") for k, e in _EDGES.items() for i in range(len(e) + 1)}
_VOTE_PLACE: dict[tuple[str, int, str], int] = {(m, i, v): _named(f"{m}{i}{v}") for m in ("quality", "abuse") for i in range(16) for v in "-gb"}


def featured(column: pa.Array, stems: frozenset[str] = frozenset()) -> Iterator[tuple[list[float], str, str, np.ndarray, np.ndarray]]:
    """(statistics, quality votes, abuse votes, places, values) of each text."""
    raw, bounds = string_views(column)
    hashes, at = word_hashes(raw, bounds)
    places = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    for i, text in enumerate(column.to_pylist()):
        s = statistics(text or "", stems)
        q, a = quality_votes(s), abuse_votes(s)
        words = np.unique(places[at[i] : at[i + 1]])
        own = [_BIN_PLACE[k, int(np.searchsorted(_EDGES[k], x))] for k, x in zip(STATS, s)]
        own += [_VOTE_PLACE["quality", j, v] for j, v in enumerate(q)] + [_VOTE_PLACE["abuse", j, v] for j, v in enumerate(a)]
        yield s, q, a, np.concatenate([np.array(own), words]), np.concatenate([np.ones(len(own)), np.full(len(words), 1 / np.sqrt(max(1, len(words))))])


class LinearScorer:
    """Logistic regression on hashed sparse rows, by Adam over the whole sample."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 150, ridge: float = 1e-4, rate: float = 0.1):
        self.weights, self.bias = np.zeros(BINS), 0.0
        if not rows or target.max() < 0.5:
            self.bias = -5.0
            return
        if target.min() >= 0.5:
            self.bias = 5.0
            return
        idx, val = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        weight = np.where(target >= 0.5, 0.5 / (target >= 0.5).sum(), 0.5 / (target < 0.5).sum())
        m, v = np.zeros(BINS + 1), np.zeros(BINS + 1)
        w = np.zeros(BINS + 1)
        for t in range(1, rounds + 1):
            z = np.bincount(owner, weights=val * w[idx], minlength=len(rows)) + w[-1]
            err = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target)
            g = np.append(np.bincount(idx, weights=val * err[owner], minlength=BINS) + ridge * w[:-1], err.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.weights, self.bias = w[:-1], float(w[-1])

    def probability(self, places: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[places] @ values + self.bias, -40, 40))))


class QualityModel:
    def __init__(self, patterns: list[tuple[str, str, int]], texts: list[str], stems: frozenset[str] = frozenset()):
        self.stems = stems
        qs, as_ = Counter(), Counter()
        for q, a, n in patterns:
            qs[q] += n
            as_[a] += n
        self.bad_of, self.quality_rates = fit_label_model(qs, start=2)
        self.abuse_of, self.abuse_rates = fit_label_model(as_, start=1)
        found = list(featured(pa.array(texts, pa.string()), stems))
        rows = [(p, v) for _, _, _, p, v in found]
        self.bad = LinearScorer(rows, np.array([self.bad_of.get(q, 0.5) for _, q, _, _, _ in found]))
        self.abuse = LinearScorer(rows, np.array([self.abuse_of.get(a, 0.5) for _, _, a, _, _ in found]))


def _voter(stems: frozenset[str], some: int):
    """Counts of vote patterns, and the ``some`` lowest hashed texts of a task
    that a labeller calls abusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        found: list[tuple[int, str]] = []
        for batch in by_bytes(batches, 0, BATCH_BYTES):
            for text in batch.column(0).to_pylist():
                s = statistics(text or "", stems)
                q, a = quality_votes(s), abuse_votes(s)
                counts[q, a] += 1
                if "b" in a and len(text) <= 1 << 15:
                    found.append((zlib.crc32(text.encode("utf-8")), text))
            found = sorted(set(found))[:some]
        keys = [*counts, *(("", "") for _ in found)]
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([*counts.values(), *(0 for _ in found)], pa.int64()), pa.array([*(None for _ in counts), *(t for _, t in found)], pa.string())],
                names=["q", "a", "n", "t"],
            )

    return run


def _stem_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, 0, BATCH_BYTES):
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for text, flag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[bool(flag)].update(stems_of(set(text.lower().split())))
        keys = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], names=["stem", "toxic", "clean"])


def learn_stems(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = 4000, share: float = 0.03, purity: float = 0.97, most: int = 2000) -> frozenset[str]:
    """Stems in at least ``share`` of the distinct flagged texts, ``purity`` of
    whose texts are flagged; from at most ``sample`` texts of either kind."""
    flags = labels.select(F.col(id_col).alias("id"), (F.col("toxic") > 0).alias("flag")).where("id IS NOT NULL AND flag IS NOT NULL").distinct()
    picked = [flags.where(c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (F.col("flag"), ~F.col("flag"))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * sample ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where(F.length("t").between(1, 1 << 15))
    some = saved(rows.join(ids, "id").select("t", "flag").distinct(), "flagged")
    counts = saved(some.mapInArrow(_stem_counter, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "stems")
    flagged = some.where("flag").count()
    found = counts.where((F.col("toxic") >= max(5, share * flagged)) & (F.col("toxic") >= purity * (F.col("toxic") + F.col("clean"))))
    return frozenset(r[0] for r in found.orderBy(F.desc("toxic"), "stem").limit(most).select("stem").collect())


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", sample: int = 3000) -> QualityModel:
    """Vote patterns of all texts, then the scorer on a bounded sample of
    ``sample`` texts: two thirds of any kind, a third with abusive words."""
    texts = docs.select(F.col(text_col).alias("t"))
    stems = learn_stems(docs, labels, id_col, text_col) if labels is not None else frozenset()
    seen = saved(texts.mapInArrow(_voter(stems, 32), "q string, a string, n long, t string"), "votes")
    votes = seen.where("t IS NULL").groupBy("q", "a").agg(F.sum("n")).collect()
    plain = lowest_hashed(texts.where(F.length("t").between(1, 1 << 15)), "t", sample * 2 // 3)
    abusive = lowest_hashed(seen.select("t"), "t", sample // 3)
    some = plain.unionByName(abusive).distinct()
    return QualityModel([tuple(r) for r in votes], sorted({r[0] for r in some.collect()}), stems)


def _judge(shared, at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: QualityModel = shared.value
        for batch in by_bytes(batches, at, BATCH_BYTES):
            good, toxic = [], []
            for s, _, _, places, values in featured(batch.column(at), model.stems):
                good.append(1 - model.bad.probability(places, values) if s[STATS.index("words")] else 0.0)
                toxic.append(model.abuse.probability(places, values) if s[STATS.index("words")] else 0.0)
            kept = [g >= 0.5 and t < 0.5 for g, t in zip(good, toxic)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good, pa.float64()), pa.array(toxic, pa.float64()), pa.array(kept, pa.bool_())], schema=schema)

    return run


def classify(docs: DataFrame, model: QualityModel, text_col: str = "text", names: tuple[str, str, str] = ("quality", "toxic", "kept")) -> DataFrame:
    """All columns of ``docs`` and the three named ones, which replace columns of
    the same names; no shuffle."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop(*names)
    kinds = (T.DoubleType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds))])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_judge(shared, docs.columns.index(text_col), to_arrow_schema(schema)), schema)
