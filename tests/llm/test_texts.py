import random
import re

import numpy as np
import pytest

from pulsegrid.llm.decontaminate import ItemIndex, find_leaks, neighbours
from pulsegrid.llm.language_id import KernelRidge, identify, spectra, train
from pulsegrid.llm.quality import classify, fit, fit_label_model

from .conftest import prose

LANGS = {
    "aa": "the an er on th re in ed nd ha at en".split(), "bb": "der sch ein ung ich zu ver lich keit ß ü ä".split(),
    "cc": "que les eau oi ment tion é è ç tre vi ou".split(),
}


def language_rows(n, seed=0):
    r = random.Random(seed)
    return [(i, prose(seed * 1000 + i, r.randint(3, 200), LANGS[x]), x) for i in range(n) for x in [sorted(LANGS)[i % 3]]]


def test_language_accuracy_and_edge_rows(spark, make_docs):
    from pyspark.sql import functions as F

    rows = language_rows(150)
    rows[::10] = [(i, t, None) for i, t, _ in rows[::10]]
    model = train(make_docs(rows), F.lit(True), sample=60)
    assert model.langs == ["aa", "bb", "cc"]
    held = language_rows(90, seed=3)
    extra = [(900, None), (901, ""), (902, " 12 ²³ !? "), (903, held[1][1] * 800), (904, held[0][1]), (904, held[0][1]), (None, held[2][1])]
    found = identify(make_docs(held + extra), model).collect()
    by = {r.doc_id: r for r in found}
    assert sum(by[i].lang_pred == x for i, _, x in held) >= 0.97 * len(held)
    assert [(by[i].lang_pred, by[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by[903].lang_pred == "bb" and len(found) == len(held) + len(extra) and all(0 <= r.score <= 1 for r in found)
    none = train(make_docs([]), F.lit(True))
    assert {(r.lang_pred, r.score) for r in identify(make_docs(held[:3]), none).collect()} == {("und", 0.0)}
    assert identify(make_docs([]), model).collect() == []


def test_presence_rows_hold_each_ngram_once():
    rows, owner = spectra(["abab", "", "ab"])
    assert owner.tolist() == [0, 2] and rows.max() == 1
    assert rows[1].sum() == 3 and (rows[1] <= rows[0]).all()  # a, b, ab
    assert rows[0].sum() == 7  # a, b, ab, ba, aba, bab, abab


def test_kernel_ridge_is_deterministic():
    rows = language_rows(60)
    a, b = (KernelRidge([r[1] for r in rows], [r[2] for r in rows]) for _ in range(2))
    assert np.array_equal(a.weights, b.weights)


ITEMS = [(1, prose(1, 20)), (2, prose(2, 33)), (3, prose(3, 33)), (4, None), (5, "too short"), (6, prose(6, 51))]


def test_leaks(spark, make_docs):
    text = dict(ITEMS)
    r = random.Random(4)

    def inside(t):
        return prose(r.random(), 60) + "\n" + t + " " + prose(r.random(), 60)

    words = text[6].split()
    near = " ".join(words[:-1] + ["changed"])
    rows = [
        (10, inside(text[1])), (11, inside(text[2].upper().replace(" ", ", "))), (12, inside(text[3]) + " " + text[1]), (13, text[6]), (14, inside(near)),
        (15, inside(" ".join(words[:20]))), (16, prose(77, 400)), (17, None), (18, ""), (19, "too short"), (20, inside(text[1])), (20, prose(5, 9)),
        (21, " ".join(sorted(words))), (22, prose(78, 20_000) + " " + text[2] + " " + prose(79, 20_000)),
    ]
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    want = {10: [1], 11: [2], 12: [1, 3], 13: [6], 14: [6], 15: [], 16: [], 17: [], 18: [], 19: [], 21: [], 22: [2]}
    for chunk in (10_000, 2):
        found = find_leaks(make_docs(rows), items, chunk=chunk).collect()
        assert {x.doc_id: x.leaked_items for x in found if x.doc_id != 20} == want
        assert sorted(x.leaked_items for x in found if x.doc_id == 20) == [[], [1]]
    assert [x.leaked_items for x in find_leaks(make_docs(rows[:1]), items.limit(0)).collect()] == [[]]
    assert find_leaks(make_docs([]), items).collect() == []


def test_leaks_match_brute_force_windows():
    items = [(i, prose(100 + i, 12 + i)) for i in range(12)]
    index = ItemIndex([i for i, _ in items], [t for _, t in items], 5, 0.8, 23, 8)
    from pulsegrid.llm.common import shingle_hashes
    from pulsegrid.llm.decontaminate import words_of
    import pyarrow as pa

    r = random.Random(9)
    for trial in range(40):
        i, t = r.choice(items)
        w = t.split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = f"z{r.randrange(99)}"
        text = prose(trial, 30) + " " + " ".join(w) + " " + prose(trial + 999, 30)
        words, _ = words_of(pa.array([text]))
        s = shingle_hashes(words, 5)
        got = index.leaks(s, index.find_known(s)) if index.find_known(s).any() else set()
        brute = {j for j in range(len(items)) for n in [index.sizes[j] - 4] for at in range(len(s) - n + 1) if index.similarity(s[at : at + n], j) >= 0.8}
        assert got == brute, trial


def test_long_items_with_an_inner_word_changed_match_brute_force():
    import pyarrow as pa

    from pulsegrid.llm.common import shingle_hashes
    from pulsegrid.llm.decontaminate import words_of

    items = [(i, prose(500 + i, 45 + i)) for i in range(16)]
    index = ItemIndex([i for i, _ in items], [t for _, t in items], 5, 0.8, 23, 8)
    r, leaked = random.Random(3), 0
    for trial in range(120):
        w = items[trial % 16][1].split()
        w[r.randrange(5, len(w) - 5)] = "changed"
        s = shingle_hashes(words_of(pa.array([prose(trial, 30) + " " + " ".join(w) + " " + prose(trial + 999, 30)]))[0], 5)
        got = index.leaks(s, index.find_known(s))
        assert got == {j for j in range(16) for n in [index.sizes[j] - 4] for at in range(len(s) - n + 1) if index.similarity(s[at : at + n], j) >= 0.8}, trial
        leaked += len(got)
    assert leaked >= 80


def test_texts_shorter_than_an_item(spark, make_docs):
    words = prose(6, 59).split()
    items = spark.createDataFrame([(1, " ".join(words)), (2, prose(7, 30))], "item_id long, text string")
    rows = [(1, " ".join(words[:-1])), (2, " ".join(words[1:-2])), (3, " ".join(words[:30])), (4, prose(7, 29)), (5, " ".join(words[:-6]))]
    index = ItemIndex([1, 2], [" ".join(words), prose(7, 30)], 5, 0.8, 23, 8)
    from pulsegrid.llm.common import shingle_hashes
    from pulsegrid.llm.decontaminate import words_of
    import pyarrow as pa

    sets = [shingle_hashes(words_of(pa.array([t]))[0], 5) for _, t in rows]
    brute = {i: [j + 1 for j in range(2) if len(s) < index.sizes[j] - 4 and index.similarity(s, j) >= 0.8] for (i, _), s in zip(rows, sets)}
    assert brute == {1: [1], 2: [1], 3: [], 4: [2], 5: [1]}
    assert {x.doc_id: x.leaked_items for x in find_leaks(make_docs(rows), items).collect()} == brute


def test_short_items(spark, make_docs):
    texts = {n: prose(n, n) for n in range(2, 9)}
    items = spark.createDataFrame([*texts.items(), (30, texts[3])], "item_id long, text string")
    rows = [(n, prose(50 + n, 30) + " " + t + " " + prose(70 + n, 30)) for n, t in texts.items()] + [(20, texts[3].split()[0]), (21, texts[4].upper()), (22, None), (23, " ".join(texts[3].split()[1:])), (24, texts[3].split()[0])]
    found = {x.doc_id: x.leaked_items for x in find_leaks(make_docs(rows), items).collect()}
    assert found == {n: [n] if n >= 5 else [] for n in texts} | {20: [], 21: [], 22: [], 23: [], 24: []}
    found = {x.doc_id: x.leaked_items for x in find_leaks(make_docs(rows), items, min_words=3).collect()}
    assert found == {n: [n] for n in texts} | {2: [], 3: [3, 30], 20: [], 21: [4], 22: [], 23: [], 24: []}


def test_every_fingerprint_within_the_radius_is_found():
    masks = set(neighbours(8, 23 // 8).tolist())
    assert len(masks) == 1 + 8 + 28
    r = random.Random(1)
    for _ in range(300):
        bits = r.sample(range(64), r.randint(0, 23))
        flips = [sum(1 << (b % 8) for b in bits if b // 8 == block) for block in range(8)]
        assert any(f in masks for f in flips)


def test_recall_of_fingerprints_at_the_similarity_bound():
    """Items share most of their shingles with other items, so the changed ones weigh most."""
    from pulsegrid.llm.common import shingle_hashes
    from pulsegrid.llm.decontaminate import words_of
    import pyarrow as pa

    stock = [prose(i, 30) for i in range(6)]
    items = [stock[i % 6] + " " + prose(700 + i, 25 + i) for i in range(18)]
    index = ItemIndex(list(range(18)), items, 5, 0.8, 23, 5)
    r, true, hits = random.Random(8), 0, 0
    for trial in range(400):
        w = items[trial % 18].split()
        for _ in range(r.choice([1, 1, 1, 2])):
            at = r.randrange(len(w))
            w[at : at + r.randint(0, 1)] = [f"z{r.randrange(99)}"]
        text = " ".join(w) if trial % 3 else " ".join(w[: len(w) - trial % 7])
        if trial % 2:
            text = prose(trial, 30) + " " + text + " " + prose(trial + 999, 30)
        s = shingle_hashes(words_of(pa.array([text]))[0], 5)
        brute = {
            j for j in range(18) for n in [index.sizes[j] - 4]
            for at in range(max(1, len(s) - n + 1)) if index.similarity(s[at : at + n], j) >= 0.8
        }
        got = index.leaks(s, index.find_known(s))
        assert got <= brute, trial
        true, hits = true + len(brute), hits + len(got)
    assert true >= 200 and hits >= 0.99 * true, (hits, true)


def test_long_texts_are_searched_in_slices(monkeypatch):
    from pulsegrid.llm import decontaminate as D
    from pulsegrid.llm.common import shingle_hashes
    import pyarrow as pa

    items = [prose(800 + i, 20 + i) for i in range(6)]
    index = ItemIndex(list(range(6)), items, 5, 0.8, 23, 5)
    text = " ".join(x for i in range(60) for x in (items[i % 6], prose(i, i % 9)))
    s = shingle_hashes(D.words_of(pa.array([text]))[0], 5)
    for size in (1, 64, 1 << 14):
        monkeypatch.setattr(D, "SLICE", size)
        assert index.leaks(s, index.find_known(s)) == set(range(6))


def junk(i):
    r = random.Random(i)
    w = prose(i, 80).split()
    kind = i % 4
    if kind == 0:
        return " ".join(x + r.choice(["###", "$$$", "%%%", "&&&"]) for x in w)
    if kind == 1:
        return " | ".join(w)
    if kind == 2:
        return " ".join(x.upper() + "!!" for x in w)
    return " ".join(x for x in w[:10] for _ in range(9))


def clean(i):
    r = random.Random(i)
    words = prose(i, r.randint(2, 200)).split()
    for j in range(0, len(words), 4):
        words[j] = r.choice(["the", "of", "and", "to", "in"])
    return " ".join(words).capitalize() + "."


def test_quality_and_abuse(spark, make_docs):
    rows = [(i, clean(i)) for i in range(160)] + [(1000 + i, junk(i)) for i in range(48)]
    rows += [(2000 + i, " ".join(x if j % 9 else ["idiot", "scum", "pathetic"][(i + j) % 3] for j, x in enumerate(clean(i + 500).split() + ["the"] * 9))) for i in range(20)]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, clean(7) * 3000), (3004, "Hello there."), (3004, "Hello there.")]
    docs = make_docs(rows)
    model = fit(docs)
    found = classify(docs, model, names=("q", "x", "ok")).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    assert sum(by[i].ok for i in range(160)) >= 158
    assert sum(by[1000 + i].q < 0.5 for i in range(48)) >= 47
    assert all(by[2000 + i].x >= 0.5 and not by[2000 + i].ok for i in range(20))
    assert [(by[i].q, by[i].ok) for i in (3000, 3001, 3002)] == [(0.0, False)] * 3
    assert by[3003].ok and by[3004].ok
    assert classify(make_docs([]), fit(make_docs([]))).collect() == []


def test_stems_are_learned_from_flags(spark, make_docs):
    rows = [(i, clean(i) + (" loweifoo loweibar" + str(i) if i % 5 == 0 else "")) for i in range(100)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    model = fit(docs, labels)
    assert "lowei" in model.stems
    by = {r.doc_id: r.toxic for r in classify(docs.select("doc_id", "text"), model).collect()}
    assert all((by[i] >= 0.5) == (i % 5 == 0) for i in range(100))


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    rates = [(0.9, 0.02), (0.6, 0.05), (0.5, 0.01), (0.8, 0.1)]
    votes = ["".join("b" if rng.random() < (h if y else f) else "g" for h, f in rates) for y in truth]
    from collections import Counter

    posterior, fitted = fit_label_model(Counter(votes))
    wrong = np.mean([(posterior[v] >= 0.5) != y for v, y in zip(votes, truth)])
    assert wrong < 0.06
    for j, (h, f) in enumerate(rates):
        assert abs(fitted[1, j, 2] - h) < 0.06 and abs(fitted[0, j, 2] - f) < 0.04
    assert fit_label_model({}) [0] == {}


def test_pipeline_stages(spark, make_docs, tmp_path):
    import corpus_pipeline as P

    item = prose(50, 30)
    good = [(i, clean(i) + " " + clean(i + 300)) for i in range(60)]
    rows = good + [(100, None), (101, "12 34"), (102, junk(1)), (103, good[3][1]), (104, good[4][1] + " end"), (105, clean(9) + " " + item + " " + clean(8)), (5, good[5][1])]
    docs = make_docs(rows)
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    left, seen = docs, []
    for name, stage in P.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns
        seen.append(sorted(r.doc_id for r in left.collect()))
    assert not {100, 101} & set(seen[0]) and 102 not in seen[1]
    assert seen[2].count(5) == 1 and not {103} & set(seen[2]) and 105 in seen[2]
    assert 105 not in seen[3] and set(seen[3]) <= set(seen[2])
    kept = set(seen[3])
    assert len(kept & set(range(60))) >= 58
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == kept
    empty = make_docs([])
    for _, stage in P.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_repeated_items_count_once_in_any_number_of_passes(spark, make_docs):
    from pyspark.sql import functions as F

    items = spark.createDataFrame([(1, prose(41, 20)), (1, prose(41, 20)), (2, prose(42, 20)), (2, prose(43, 20)), (3, prose(44, 20))], "item_id long, text string")
    docs = make_docs([(1, prose(41, 20) + " " + prose(43, 20) + " " + prose(42, 20)), (2, prose(9, 60)), (1, prose(44, 20))]).withColumn("_more", F.lit("kept"))
    for chunk in (10_000, 2, 1):
        found = find_leaks(docs, items, chunk=chunk).collect()
        assert sorted((x.doc_id, x.leaked_items, x["_more"]) for x in found) == [(1, [1, 2], "kept"), (1, [3], "kept"), (2, [], "kept")], chunk
