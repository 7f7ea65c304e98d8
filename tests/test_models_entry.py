import itertools
import math

import numpy as np

from pulsegrid.operators import models as ML


def _brute_shap(x, leaves, nf):
    """Shapley values by enumerating all feature subsets (path-dependent expectation)."""
    def expect(S):
        tot = 0.0
        for w, v, path in leaves:
            pr = 1.0
            for f, thr, left, frac in path:
                if f in S:
                    pr *= float((x[f] <= thr) if left else (x[f] > thr))
                else:
                    pr *= frac
            tot += w * v * pr
        return tot
    phi = np.zeros(nf)
    feats = list(range(nf))
    for i in feats:
        rest = [j for j in feats if j != i]
        for r in range(len(rest) + 1):
            for S in itertools.combinations(rest, r):
                wt = math.factorial(r) * math.factorial(nf - r - 1) / math.factorial(nf)
                phi[i] += wt * (expect(set(S) | {i}) - expect(set(S)))
    return phi, expect(set())


def test_tree_shap_exact_on_repeated_feature_tree():
    # tree: split f0<=1 (cover 10 -> 6/4); left: split f1<=0 (6 -> 2/4); right: split f0<=3 (4 -> 1/3)
    nodes = {
        0: dict(prediction=0, cover=10, leftChild=1, rightChild=2, feature=0, threshold=1.0),
        1: dict(prediction=0, cover=6, leftChild=3, rightChild=4, feature=1, threshold=0.0),
        2: dict(prediction=0, cover=4, leftChild=5, rightChild=6, feature=0, threshold=3.0),
        3: dict(prediction=1.0, cover=2, leftChild=-1, rightChild=-1, feature=None, threshold=None),
        4: dict(prediction=-2.0, cover=4, leftChild=-1, rightChild=-1, feature=None, threshold=None),
        5: dict(prediction=0.5, cover=1, leftChild=-1, rightChild=-1, feature=None, threshold=None),
        6: dict(prediction=3.0, cover=3, leftChild=-1, rightChild=-1, feature=None, threshold=None),
    }
    leaves = ML.leaf_paths([(0.7, nodes)])
    X = np.array([[0.5, -1.0, 9.0], [2.0, 1.0, 0.0], [5.0, 0.0, 1.0]])
    phi, base = ML.tree_shap(X, leaves, 3)
    for k in range(len(X)):
        want, wbase = _brute_shap(X[k], leaves, 3)
        assert np.allclose(phi[k], want, atol=1e-12) and abs(base - wbase) < 1e-12
        f = sum(w * v for w, v, path in leaves if all((X[k][f] <= t) if l else (X[k][f] > t) for f, t, l, _ in path))
        assert abs(phi[k].sum() + base - f) < 1e-12


def test_tree_shap_sums_subsets_per_leaf_not_per_row(monkeypatch):
    """The arrays that subsets are summed over do not grow with the rows."""
    rng = np.random.default_rng(0)
    leaves = [(1.0, 2.0, [(f, 0.0, bool(f % 2), 0.5) for f in range(4)]), (0.3, -1.0, [(4, 0.2, True, 0.25)])]
    sizes, full = [], np.full
    monkeypatch.setattr(ML.np, "full", lambda n, v: sizes.append(n) or full(n, v))
    X = rng.normal(size=(3000, 5))
    phi, base = ML.tree_shap(X, leaves, 5)
    assert max(sizes) <= 16
    for k in range(0, 3000, 300):
        want, wbase = _brute_shap(X[k], leaves, 5)
        assert np.allclose(phi[k], want, atol=1e-12) and abs(base - wbase) < 1e-12


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() >= 0 and "email_open_rate" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 140


def test_clean_stream_memory_sink(spark, tmp_path):
    from pulsegrid.sources.adapters import bronze_email
    from pulsegrid.streaming.clean_stream import clean_stream

    src = str(tmp_path / "bronze")
    bronze_email(spark, "/root/testdata/sf0.001").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = clean_stream(stream, "email").writeStream.format("memory").queryName("clean_email_t").start()
    q.processAllAvailable()
    q.stop()
    n = spark.sql("SELECT count(*) FROM clean_email_t").collect()[0][0]
    assert n == spark.read.parquet(src).count()
