"""Scoring: channel probabilities -> scores, tiers, next best channel, reasons.

The operators only need four probability columns (``p_email``, ``p_web``,
``p_webinar``, ``p_rep``) next to snapshot rows, whatever produced them: the
MLlib models of ``pulsegrid.operators.models`` or the deterministic
rate-based propensities below (used where a model-free, SQL-checkable
scorer is wanted). Fitted quantities (grid winners, cut points, base rates,
4 weights) are a handful of scalars; all row work stays in Spark.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators import metrics as M

PROBS = ("p_email", "p_web", "p_webinar", "p_rep")
TARGETS = ("email_target", "web_target", "webinar_target", "veeva_target")

# Candidate weights searched by the reference.
HYBRID_CANDIDATES = [(0.2, 0.8), (0.3, 0.7), (0.4, 0.6), (0.5, 0.5), (0.6, 0.4), (0.7, 0.3), (0.8, 0.2)]
CHANNEL_WEIGHT_CANDIDATES = [
    (0.25, 0.25, 0.25, 0.25),
    (0.30, 0.30, 0.20, 0.20),
    (0.35, 0.25, 0.20, 0.20),
    (0.20, 0.35, 0.25, 0.20),
    (0.25, 0.35, 0.20, 0.20),
]


def channel_labels(rep_label: str = "Sales Rep") -> list[str]:
    return ["Email", "Website", "Webinar", rep_label]


def rate_propensities(snap: DataFrame) -> DataFrame:
    """Deterministic per-channel propensities from profile-A history rates (in [0, 1])."""
    web_eng = F.col("web_content_views") + F.col("web_downloads") + F.col("web_video_completes")
    return snap.select(
        "*",
        F.least(F.col("email_open_rate"), F.lit(1.0)).alias("p_email"),
        F.least(web_eng.cast("double") / F.greatest(F.col("web_total_events").cast("double"), F.lit(1.0)), F.lit(1.0)).alias("p_web"),
        F.least(F.col("event_attendance_rate"), F.lit(1.0)).alias("p_webinar"),
        F.col("veeva_completion_rate").alias("p_rep"),
    )


#: Snapshot columns that a rate propensity is made of, by channel label.
RATE_DRIVERS = {
    "Email": ("email_open_rate",),
    "Website": ("web_content_views", "web_downloads", "web_video_completes"),
    "Webinar": ("event_attendance_rate",),
    "Sales Rep": ("veeva_completion_rate",),
}
RATE_PARTS = RATE_DRIVERS["Website"]


def rate_reason(gold: DataFrame) -> DataFrame:
    """Gold rows with ``recommended_reason`` (profile A's sentences) for rate
    propensities: the driver is the rate itself, for the website the largest of
    the counts in it (ties: the first). Needs the columns ``RATE_PARTS``."""
    from pulsegrid.functions.reasons import phrase_a, reason_a

    channel, most = F.col("next_best_channel"), F.greatest(*RATE_PARTS)
    probs = ("email_probability", "website_probability", "webinar_probability", "sales_rep_probability")
    exact = F.coalesce(*[F.when(channel == c, F.col(p)) for c, p in zip(RATE_DRIVERS, probs)]).cast("decimal(9,4)")
    prob = F.round(exact * 100, 1).cast("double") / 100  # rounded as a decimal: the sentence prints one digit
    driver = F.coalesce(*[
        F.when((channel == c) & (F.lit(len(parts) == 1) | (F.col(part) == most if len(parts) > 1 else F.lit(True))), part)
        for c, parts in RATE_DRIVERS.items() for part in parts
    ])
    return gold.withColumn("recommended_reason", reason_a(channel, prob, F.col("engagement_level"), F.array(phrase_a(driver))))


def minmax_0_100(col: str, lo: float, hi: float) -> Column:
    """M5: (x - lo) / (hi - lo) * 100 clipped to [0, 100] (lo/hi fitted on train)."""
    if hi == lo:
        return F.lit(0.0)
    s = (F.col(col) - F.lit(lo)) / F.lit(hi - lo) * 100.0
    return F.least(F.greatest(s, F.lit(0.0)), F.lit(100.0))


def fit_range(df: DataFrame, col: str) -> tuple[float, float]:
    r = df.agg(F.min(col), F.max(col)).first()
    return float(r[0]), float(r[1])


def predicted_score(weights: Sequence[float], clip: bool = False) -> Column:
    """100 * sum_c w_c p_c (clipped to [0, 100] in profile B)."""
    s = sum(F.col(p) * F.lit(float(w)) for p, w in zip(PROBS, weights)) * 100.0
    return F.least(F.greatest(s, F.lit(0.0)), F.lit(100.0)) if clip else s


def hybrid_score(hist: str, pred: str, w_hist: float, w_pred: float, clip: bool = False) -> Column:
    """w_h * hist + w_p * pred."""
    s = F.col(hist) * F.lit(w_hist) + F.col(pred) * F.lit(w_pred)
    return F.least(F.greatest(s, F.lit(0.0)), F.lit(100.0)) if clip else s


def future_intensity(mean: bool = False) -> Column:
    """Sum of the four labels (or their mean)."""
    s = sum(F.col(t) for t in TARGETS)
    return s / 4.0 if mean else s


def _candidates_frame(df: DataFrame, exprs: list[Column]) -> DataFrame:
    """Rows x candidates: one row per (row, candidate index) with its score (bounded explode)."""
    arr = F.array(*[F.struct(F.lit(i).alias("cand"), e.alias("score")) for i, e in enumerate(exprs)])
    return df.select(future_intensity().alias("fut"), F.explode(arr).alias("c")).select("c.cand", "c.score", "fut")


def grid_by_spearman(df: DataFrame, exprs: list[Column], n_buckets: int | None = None) -> DataFrame:
    """Spearman(score_c, future intensity) for every candidate c, on rows
    folded to distinct (candidate, score, intensity)."""
    return M.spearman(_candidates_frame(df, exprs), "score", "fut", ["cand"], n_buckets)


def pick_best(grid: DataFrame, default: int = 0) -> int:
    """Strict '>' over candidates in order (starting from -1): the first of equal maxima wins."""
    rows = sorted(grid.collect(), key=lambda r: r["cand"])
    best, best_c = default, -1.0
    for r in rows:
        c = r["spearman"]
        if c is not None and not np.isnan(c) and c > best_c:
            best, best_c = r["cand"], c
    return best


def hybrid_grid(val: DataFrame, hist: str = "hist_score", pred: str = "pred_score") -> DataFrame:
    exprs = [F.col(hist) * F.lit(h) + F.col(pred) * F.lit(w) for h, w in HYBRID_CANDIDATES]
    return grid_by_spearman(val, exprs)


def weight_grid(val: DataFrame) -> DataFrame:
    exprs = [predicted_score(w) for w in CHANNEL_WEIGHT_CANDIDATES]
    return grid_by_spearman(val, exprs)


def tiers(score: str, q33: float, q66: float, inclusive: bool = True) -> Column:
    """Low / Medium / High against the two cut points."""
    s = F.col(score)
    if inclusive:
        return F.when(s <= q33, "Low").when(s <= q66, "Medium").otherwise("High")
    return F.when(s < q33, "Low").when(s < q66, "Medium").otherwise("High")


def base_rates(val: DataFrame) -> DataFrame:
    """Mean validation probability per channel (one row)."""
    return val.agg(*[F.avg(p).alias(f"base_{p}") for p in PROBS])


def next_best_channel(values: Sequence[Column], labels: Sequence[str]) -> Column:
    """Label of the arg-max; the first channel wins ties."""
    arr = F.array(*values)
    idx = F.array_position(arr, F.array_max(arr))
    return F.element_at(F.array(*[F.lit(x) for x in labels]), idx.cast("int"))


def lift_columns(base: dict[str, float]) -> list[Column]:
    return [F.col(p) / F.lit(max(float(base[f"base_{p}"]), 1e-6)) for p in PROBS]


# --- M16: constrained least squares for channel weights ---------------------------
def weight_gram(df: DataFrame) -> DataFrame:
    """Sufficient statistics of mean((P w - y)^2), y = mean of the 4 labels: one agg
    with exact decimal sums, so the result does not depend on the row order.

    G[i][j] = sum p_i p_j, b[i] = sum p_i y, plus n and sum y^2."""
    y = future_intensity(mean=True)

    def total(c: Column) -> Column:
        return F.sum(c.cast("decimal(38,12)")).cast("double")

    aggs = [F.count(F.lit(1)).alias("n"), total(y * y).alias("yy")]
    for i, j in itertools.combinations_with_replacement(range(4), 2):
        aggs.append(total(F.col(PROBS[i]) * F.col(PROBS[j])).alias(f"g{i}{j}"))
    for i in range(4):
        aggs.append(total(F.col(PROBS[i]) * y).alias(f"b{i}"))
    return df.agg(*aggs)


def solve_simplex_qp(G: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min w'Gw - 2b'w  s.t.  sum w = 1, w >= 0 (exact: enumerate the 15 supports)."""
    k = len(b)
    best_w, best_v = None, np.inf
    for r in range(1, k + 1):
        for S in itertools.combinations(range(k), r):
            S = list(S)
            A = np.zeros((r + 1, r + 1))
            A[:r, :r] = 2 * G[np.ix_(S, S)]
            A[:r, r] = 1.0
            A[r, :r] = 1.0
            rhs = np.concatenate([2 * b[S], [1.0]])
            try:
                sol = np.linalg.lstsq(A, rhs, rcond=None)[0]
            except np.linalg.LinAlgError:
                continue
            w = np.zeros(k)
            w[S] = sol[:r]
            if np.any(w < -1e-12) or abs(w.sum() - 1) > 1e-9:
                continue
            w = np.clip(w, 0, 1)
            v = w @ G @ w - 2 * b @ w
            if v < best_v - 1e-15:
                best_w, best_v = w, v
    return best_w


def fit_channel_weights(df: DataFrame) -> list[float]:
    r = weight_gram(df).first().asDict()
    G = np.zeros((4, 4))
    for i, j in itertools.combinations_with_replacement(range(4), 2):
        G[i, j] = G[j, i] = r[f"g{i}{j}"] or 0.0
    b = np.array([r[f"b{i}"] or 0.0 for i in range(4)])
    return [float(x) for x in solve_simplex_qp(G, b)]


# --- reasons (T5, M27, M28) --------------------------------------------------------
def top_drivers(attr: str, names: Sequence[str], k: int = 2) -> Column:
    """T5: names of the ``k`` largest positive attributions (else the single largest).

    ``attr`` is an array<double> aligned with ``names``; done with
    higher-order array functions (no UDF)."""
    pairs = F.arrays_zip(F.col(attr).alias("v"), F.array(*[F.lit(n) for n in names]).alias("n"))
    ordered = F.array_sort(pairs, lambda a, b: F.when(a["v"] > b["v"], -1).when(a["v"] < b["v"], 1).otherwise(0))
    pos = F.filter(ordered, lambda e: e["v"] > 0)
    chosen = F.when(F.size(pos) > 0, F.slice(pos, 1, k)).otherwise(F.slice(ordered, 1, 1))
    return F.transform(chosen, lambda e: e["n"])
