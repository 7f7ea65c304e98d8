"""Model operators on MLlib: standardise, PC1 history score, boosted trees,
Platt calibration and per-row tree attributions (M2-M8, M25, M26).

Only fitted parameters reach the driver: 2 x n_features scaler statistics,
one principal component, the tree ensembles (a few thousand nodes), two
calibration coefficients. Row work is Spark jobs; the attribution step is a
``mapInPandas`` over Arrow batches that evaluates the (broadcast) trees with
numpy, vectorised over the rows of each batch.

Attributions are exact path-dependent TreeSHAP values: for one tree, the
expected output given a feature subset S is a sum over leaves of
``v_leaf * prod_{j in S} o_j(x) * prod_{j in P\\S} z_j`` (P = distinct features
on the leaf's path, o_j = x satisfies every split on j along the path, z_j =
product of the cover fractions of those splits), so each leaf's Shapley
contribution is a short sum over subsets of P (depth 4 -> at most 8 terms).
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache, reduce
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.config import Profile
from pulsegrid.functions.cleaning import coerce_numeric
from pulsegrid.operators import boosting
from pulsegrid.operators.comoments import Moments, comoments
from pulsegrid.session import at_once, ensure_checkpoint_dir

NON_FEATURES = {"hcp_id", "snapshot_date", "split", "email_target", "web_target", "webinar_target", "veeva_target"}


def feature_columns(df: DataFrame) -> list[str]:
    """Every column except keys, split and targets (88 in profile A)."""
    return [c for c in df.columns if c not in NON_FEATURES]


def coerce_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every feature to double, non-numeric / NULL -> 0 (e.g. NULL completion rates)."""
    keep = [c for c in df.columns if c not in set(cols)]
    return df.select(*keep, *[coerce_numeric(c).alias(c) for c in cols])


def fit_standardizer(train: DataFrame, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    """M2: mean and population std per feature from the train rows (std 0 -> 1)."""
    m = comoments(train, cols)
    return m.mean.tolist(), m.deviations().tolist()


def standardized_vector(cols: Sequence[str], means: Sequence[float], stds: Sequence[float]) -> Column:
    return array_to_vector(F.array(*[(F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(cols, means, stds)]))


def history_score(train: DataFrame, frames: DataFrame, cols: Sequence[str], touch_col: str = "total_touchpoints") -> DataFrame:
    """M2-M5: standardise (train stats), PC1 (train fit), orient by correlation with
    total touchpoints, scale to 0-100 by the train range and clip.

    Standardisation, PC1 and its sign come from one pass over the train rows
    (``comoments``), the range of PC1 from a second."""
    every = [*cols, *([] if touch_col in cols else [touch_col])]
    fitted = fit_history(train, cols, every, touch_col)
    pc1 = reduce(lambda a, b: a + b, [(F.col(c) - F.lit(float(m))) * F.lit(float(w)) for c, m, w in zip(cols, fitted["means"], fitted["weights"])])
    rng = train.agg(F.min(pc1).alias("lo"), F.max(pc1).alias("hi")).first()
    lo, hi = float(rng["lo"] or 0.0), float(rng["hi"] or 0.0)
    scaled = (pc1 - F.lit(lo)) / F.lit(hi - lo if hi != lo else 1.0) * 100.0
    return frames.withColumn("hist_score", F.least(F.greatest(scaled, F.lit(0.0)), F.lit(100.0)))


def fit_history(train: DataFrame, cols: Sequence[str], every: Sequence[str], touch_col: str) -> dict:
    """Means, weights (signed loading by deviation) and explained variance ratio of PC1."""
    m = comoments(train, every)
    d = len(cols)
    inner = Moments(m.n, m.mean[:d], m.products[:d, :d], m.low[:d], m.high[:d])
    loadings, share = inner.first_component()
    sign = -1.0 if float(loadings @ m.correlations()[:d, list(every).index(touch_col)]) < 0 else 1.0
    return {"means": inner.mean, "weights": sign * loadings / inner.deviations(), "explained": share, "rows": m.n, "varying": int((inner.low < inner.high).sum())}


def with_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` and its feature columns as one vector."""
    return df.withColumn("features", array_to_vector(F.array(*[F.col(c) for c in cols])))


def raw_probabilities(models: dict, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uncalibrated P(y=1) of every ensemble as ``_raw_<target>`` (kept next to every
    input column); the vector is built once a row, not once a model."""
    x = with_features(df, cols)
    for t, model in models.items():
        x = model.transform(x).withColumn(f"_raw_{t}", vector_to_array(F.col("probability"))[1])
        x = x.drop("rawPrediction", "probability", "prediction")
    return x.drop("features")


def fit_platt(val_scored: DataFrame, prob: str, label: str) -> tuple[float, float]:
    """M8: sigmoid calibration on validation rows with Platt's smoothed targets
    (pos -> (P+1)/(P+2), neg -> 1/(N+2)); soft targets become two weighted rows."""
    cnt = val_scored.agg(F.sum(F.col(label)).alias("P"), F.count(F.lit(1)).alias("n")).first()
    P = float(cnt["P"] or 0)
    N = float(cnt["n"]) - P
    hi, lo = (P + 1.0) / (P + 2.0), 1.0 / (N + 2.0)
    t = F.when(F.col(label) == 1, F.lit(hi)).otherwise(F.lit(lo))
    base = val_scored.select(array_to_vector(F.array(F.col(prob))).alias("fv"), t.alias("t"))
    rows = base.select("fv", F.lit(1.0).alias("y"), F.col("t").alias("wt")).unionByName(
        base.select("fv", F.lit(0.0).alias("y"), (1.0 - F.col("t")).alias("wt"))
    )
    lr = LogisticRegression(featuresCol="fv", labelCol="y", weightCol="wt", regParam=0.0, standardization=False, maxIter=200).fit(rows)
    return float(lr.coefficients[0]), float(lr.intercept)


def calibrated(prob: str, a: float, b: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col(prob) + F.lit(b))))


def fit_channel_models(frames: DataFrame, cols: Sequence[str], p: Profile, targets: Sequence[str], n_trees: int = 100, seed: int = 42):
    """M6/M7: boosted trees per target, class-weighted in profile A
    ((n - pos) / max(pos, 1)); the trees of all targets are grown together.

    The rows are read three times (class counts, split candidates, bins), so they
    stay on the executors' disks until they are binned."""
    train = frames.where(F.col("split") == "train").select(*cols, *targets)
    train.persist(StorageLevel.DISK_ONLY)
    try:
        return boosting.fit(train, cols, targets, p.learning_rate, p.class_weighted, n_trees, seed)
    finally:
        train.unpersist()


def fit_channel_platt(scored: DataFrame, targets: Sequence[str]) -> dict[str, tuple[float, float]]:
    """The calibrations of all targets on the validation rows, fitted concurrently."""
    val = scored.where(F.col("split") == "val")
    return at_once(lambda t: fit_platt(val, f"_raw_{t}", t), targets)


# --- tree attributions (M25) ---------------------------------------------------------
def extract_trees(model) -> list[tuple[float, dict]]:
    """(tree weight, nodes) per tree, from the model's saved node table (bounded size)."""
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(s).rstrip('/')}/trees-{model.uid}"
    model.write().overwrite().save(path)
    nodes = s.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", F.get(F.col("nodeData.impurityStats"), 0).alias("cover"),
        "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold"),
    ).collect()
    by_tree: dict[int, dict] = {}
    for r in nodes:
        by_tree.setdefault(r["treeID"], {})[r["id"]] = r.asDict()
    return [(float(w), by_tree[i]) for i, w in enumerate(model.treeWeights)]


def leaf_paths(trees: list[tuple[float, dict]]) -> list[tuple[float, float, list]]:
    """Flatten trees to (tree weight, leaf value, [(feature, threshold, go_left, cover fraction)])."""
    out = []
    for w, nodes in trees:
        stack = [(0, [])]
        while stack:
            nid, path = stack.pop()
            n = nodes[nid]
            if n["leftChild"] is None or n["leftChild"] < 0:
                out.append((w, float(n["prediction"]), path))
                continue
            for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
                frac = (nodes[child]["cover"] / n["cover"]) if n["cover"] else 0.0
                stack.append((child, path + [(int(n["feature"]), float(n["threshold"]), left, frac)]))
    return out


def _shap_weights(k: int) -> list[float]:
    return [math.factorial(s) * math.factorial(k - s - 1) / math.factorial(k) for s in range(k)]


@lru_cache(maxsize=1 << 14)
def _leaf_shares(w: float, v: float, z: tuple[float, ...]) -> np.ndarray:
    """A leaf's Shapley shares (pattern x path feature): bit i of the pattern
    says whether a row satisfies every split on feature i of the path. Kept
    between batches, 512 bytes a leaf of depth 4."""
    k = len(z)
    o = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(float)
    wts, shares = _shap_weights(k), np.zeros((1 << k, k))
    for i in range(k):
        others = [j for j in range(k) if j != i]
        acc = np.zeros(1 << k)
        for r in range(k):
            for S in itertools.combinations(others, r):
                term = np.full(1 << k, wts[r])
                for j in others:
                    term = term * (o[:, j] if j in S else z[j])
                acc += term
        shares[:, i] = w * v * acc * (o[:, i] - z[i])
    return shares


def tree_shap(X: np.ndarray, leaves: list[tuple[float, float, list]], n_features: int) -> tuple[np.ndarray, float]:
    """Exact path-dependent TreeSHAP of sum_m w_m tree_m(x) for every row of X.

    The subsets are summed once per leaf and pattern of satisfied features (at
    most 16 at depth 4), not once per row; a row only finds its pattern."""
    n = X.shape[0]
    columns = np.ascontiguousarray(X.T)
    phi = np.zeros((n_features, n))
    base = 0.0
    for w, v, path in leaves:
        feats: dict[int, list] = {}
        for f, thr, left, frac in path:
            feats.setdefault(f, []).append((thr, left, frac))
        P = list(feats)
        z = tuple(float(np.prod([c[2] for c in feats[j]])) for j in P)
        base += w * v * float(np.prod(z)) if P else w * v
        if not P:
            continue
        pattern = np.zeros(n, dtype=np.intp)
        for i, j in enumerate(P):
            ok = np.ones(n, dtype=bool)
            for thr, left, _ in feats[j]:
                ok &= (columns[j] <= thr) if left else (columns[j] > thr)
            pattern |= ok.astype(np.intp) << i
        shares = _leaf_shares(w, v, z)
        for i, j in enumerate(P):
            phi[j] += shares[:, i].take(pattern)
    return np.ascontiguousarray(phi.T), base


def attributions(df: DataFrame, cols: Sequence[str], models: dict, key: str = "hcp_id") -> DataFrame:
    """Per row and model, attributions (log-odds units) + base value.

    Output: key, target, attr array<double> (aligned with ``cols``), base, logit.
    The trees travel inside the task closure (a few thousand nodes, bounded by
    the ensemble size, not by the data)."""
    packs = {t: leaf_paths(extract_trees(m)) for t, m in models.items()}
    nf = len(cols)
    schema = T.StructType([
        T.StructField(key, T.StringType()), T.StructField("target", T.StringType()),
        T.StructField("attr", T.ArrayType(T.DoubleType())), T.StructField("base", T.DoubleType()),
        T.StructField("logit", T.DoubleType()),
    ])

    def run(batches):
        import pandas as pd

        for pdf in batches:
            X = pdf[list(cols)].to_numpy(dtype=float)
            for t, leaves in packs.items():
                phi, base = tree_shap(X, leaves, nf)
                # Spark's GBT probability is sigmoid(2 * margin): report log-odds units
                phi, base = 2.0 * phi, 2.0 * base
                yield pd.DataFrame({
                    key: pdf[key].astype(str).values, "target": t, "attr": list(phi),
                    "base": base, "logit": phi.sum(axis=1) + base,
                })

    return df.select(key, *cols).mapInPandas(run, schema)


def chosen_drivers(df: DataFrame, cols: Sequence[str], models: dict, key: str = "hcp_id") -> DataFrame:
    """M25/T5 for one model per row (column ``target``): the names of the features
    with a positive attribution, largest first, and of the largest one.

    Output: key, positive array<string>, largest string. The ensembles go to the
    tasks as one broadcast of a few thousand nodes."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast({t: leaf_paths(extract_trees(m)) for t, m in models.items()})
    schema = f"{key} string, positive array<string>, largest string"

    def run(batches):
        import pandas as pd

        names = np.array(list(cols))
        for pdf in batches:
            X = pdf[list(cols)].to_numpy(dtype=float)
            positive: list = [[] for _ in range(len(pdf))]
            largest: list = [None] * len(pdf)
            for t, leaves in shared.value.items():
                at = np.flatnonzero((pdf["target"] == t).to_numpy())
                if not len(at):
                    continue
                phi, _ = tree_shap(X[at], leaves, len(cols))
                order = np.argsort(-phi, axis=1, kind="stable")
                for i, row in enumerate(at):
                    ranked = order[i]
                    positive[row] = names[ranked[phi[i, ranked] > 0]].tolist()
                    largest[row] = str(names[ranked[0]])
            yield pd.DataFrame({key: pdf[key].astype(str).values, "positive": positive, "largest": largest})

    return df.select(key, "target", *cols).mapInPandas(run, schema)


def feature_importance(attr: DataFrame, cols: Sequence[str], top: int = 20) -> DataFrame:
    """Mean |attribution| per feature, largest first."""
    names = F.array(*[F.lit(c) for c in cols])
    x = attr.select(F.posexplode("attr").alias("pos", "v"))
    g = x.groupBy("pos").agg(F.avg(F.abs("v")).alias("mean_abs_attribution"))
    return g.select(F.element_at(names, F.col("pos") + 1).alias("feature"), "mean_abs_attribution").orderBy(
        F.col("mean_abs_attribution").desc(), "feature").limit(top)
