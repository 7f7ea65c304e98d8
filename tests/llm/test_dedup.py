import random
import re

import numpy as np
import pytest

from pulsegrid.llm.embedding_dedup import near_vectors, quantise, tile_links
from pulsegrid.llm.graph import components
from pulsegrid.llm.minhash import near_duplicates

from .conftest import prose


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    if len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def closure(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def brute(rows, k, part, whole):
    sets = {i: shingle_set(t, k) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            inter = len(sets[a] & sets[b])
            if inter and whole * inter >= part * len(sets[a] | sets[b]):
                links.append((a, b))
    low = closure(ids, links)
    return {i: (len(sets[i]), low[i]) for i in ids}


def edited(text, seed, n):
    r = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("k,part,rounds,small", [(3, 85, 2, 32), (5, 80, 0, 1000), (3, 85, 0, 2)])
def test_minhash_matches_brute_force(spark, make_docs, k, part, rounds, small):
    base, other = prose(1, 150), prose(2, 120)
    rows = [(i, prose(100 + i, 60)) for i in range(20)]
    rows += [(100 + i, base) for i in range(15)]  # copies
    rows += [(200 + i, edited(base, i, i % 9)) for i in range(60)]  # near copies, some not linked to all
    rows += [(300 + i, edited(other, i, 3)) for i in range(12)]
    rows += [(400, None), (401, ""), (402, " \t\n "), (403, "One two"), (404, "one TWO"), (405, "one"), (406, "x" * 50_000), (407, " ".join(["again"] * 5000))]
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(make_docs(rows), k=k, at_least=(part, 100), rounds=rounds, small=small, block=8).collect()}
    want = brute(rows, k, part, 100)
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_minhash_repeated_null_and_empty(spark, make_docs):
    same = prose(5, 40)
    found = near_duplicates(make_docs([(7, same), (7, same), (3, same), (None, same), (None, None)])).collect()
    assert sorted((r.id is None, r.id or 0, r.component_id or 0, r.kept) for r in found) == [(False, 3, 3, True), (False, 7, 3, False), (False, 7, 3, False), (True, 0, 0, True), (True, 0, 0, True)]
    assert near_duplicates(make_docs([])).collect() == []


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(50, 51), (51, 50)]
    found = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 30)}, 50: 50, 51: 50}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_quantisation_bound_holds():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 40))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, length, rest = quantise(x)
    near = (q.astype(float) @ q.astype(float).T) / (s[:, None] * s[None, :])
    assert (np.abs(near - x @ x.T) <= length[:, None] * rest[None, :] + rest[:, None] + 1e-12).all()


def test_tile_links_are_exact_and_redo_few():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(20, 32)), 15, axis=0) + 0.3 * rng.random((300, 1)) * rng.normal(size=(300, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    i, j, redone = tile_links(x[:170], x[170:], 0.93)
    want = x[:170] @ x[170:].T >= 0.93
    assert set(zip(i, j)) == set(zip(*np.nonzero(want)))
    assert redone < want.size / 10


def test_near_vectors_match_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(8, 12))
    rows = []
    for i in range(160):
        v = base[i % 8] + 0.25 * rng.random() * rng.normal(size=12)
        rows.append((i, [float(np.float32(z)) for z in v], i % 3))
    rows += [(500 + i, rows[0][1], 0) for i in range(6)]  # copies
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 12, 0), (603, [float("nan")] + [1.0] * 11, 0), (604, [float("inf")] + [1.0] * 11, 0), (605, rows[0][1], None), (606, rows[0][1][:5], 0), (607, [None] + rows[0][1][1:], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, rep string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, block=16).collect()}

    def fine(v, lab):
        return lab is not None and v and all(z is not None and np.isfinite(z) for z in v) and any(v)

    good = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows if fine(v, lab)]
    links = []
    for x, (a, u, la) in enumerate(good):
        for b, v, lb in good[x + 1 :]:
            if la == lb and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                links.append((a, b))
    low = closure([r[0] for r in rows], links)
    assert links
    assert got == {i: (sum(i in p for p in links), low[i], low[i] == i) for i, *_ in rows}
    assert near_vectors(df.limit(0)).collect() == []
