"""Collocations, tokenizer alignment and nearest neighbours against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import alignment, ann, phrases
from pulsegrid.llm.perfect_hash import PerfectHash, bucket_of, build
from pulsegrid.llm.tokens import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


# -- op11 ----------------------------------------------------------------------


def plain_collocations(rows, top, max_words, min_count):
    words, counts = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            words[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, min(max_words, len(w) - i) + 1):
                    counts[lang, tuple(w[i : i + m])] += 1
    often = {k: f for k, f in counts.items() if f >= min_count}
    out = collections.defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) < 2:
            continue
        if any(
            g == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and f >= a for (g, q), f in often.items()
        ):
            continue
        n = words[lang]
        score, k = min((1000 * a * n // (often[lang, p[:k]] * often[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), often[lang, p[:k]], often[lang, p[k:]], n))
    return {
        (lang, i + 1, p.decode(), -a, l, r, n, -s)
        for lang, found in out.items()
        for i, (s, a, p, l, r, n) in enumerate(sorted(found)[:top])
    }


def phrase_rows(seed=3):
    r = random.Random(seed)
    vocab = ["the", "of", "Éa", "new", "york", "x", "city", "日本", "a-b", "q"]
    rows = [(i, " ".join(r.choices(vocab, [9, 8, 2, 2, 2, 1, 1, 1, 1, 1], k=r.randint(0, 40))) + r.choice([".", "!\n", "", "\t\t"]), r.choice(["en", "de", None])) for i in range(60)]
    rows += [(100 + i, "To be, or not to be: that is the Question\x0bthat is", "en") for i in range(9)]  # copies
    rows += [(200 + i, "same same same same same same same", "de") for i in range(5)]  # overlaps, one word only
    return rows + [(300, None, "en"), (301, "", None), (302, "  \t. ,", "fr"), (302, "word", "xx"), (303, "und lang", "und")]


@pytest.mark.parametrize("budget,top,max_words,least", [(1 << 20, 2000, 5, 4), (3, 7, 4, 3)])
def test_collocations_match_plain_version(spark, make_docs, budget, top, max_words, least):
    rows = phrase_rows()
    got = phrases.collocations(make_docs(rows), top=top, max_words=max_words, min_count=least, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, top, max_words, least)


def test_collocations_of_empty_tables(spark, make_docs):
    assert phrases.collocations(make_docs([]), min_count=1).count() == 0
    assert phrases.collocations(make_docs([(1, None, None), (2, " ", "en")]), min_count=1).count() == 0


def test_words_of_long_texts_are_cut_between_pieces_only(monkeypatch):
    monkeypatch.setattr(phrases, "_SLICE", 16)
    texts = [b"one two three four five six. seven", b"", b"eight,nine ten eleven twelve thirteen fourteen"]
    raw, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = list(phrases.words_of(raw, bounds, np.arange(3, dtype=np.uint64), phrases._byte_values(0)))
    words = [raw[s : s + n].tobytes().decode() for w in found for s, n in zip(w.starts, w.lengths)]
    assert words == re.findall(r"[^ .,]+", "one two three four five six. seven eight,nine ten eleven twelve thirteen fourteen")
    assert [len(w.hashes) for w in found] == [6, 2, 6]
    assert [w.rows.tolist() for w in found] == [[0] * 6, [0, 2], [2] * 6]


def test_subtree_counts_come_from_leaf_totals():
    paths = np.array([[1, 2, 0], [1, 2, 3], [1, 2, 4], [1, 5, 3], [1, 2, 3]], np.uint64)
    nodes = {(d, tuple(int(x) for x in p)): int(c) for d, ps, cs in phrases.subtree(paths, np.array([4, 2, 1, 7, 1]), 2) for p, c in zip(ps, cs)}
    assert nodes == {(2, (1, 2)): 8, (2, (1, 5)): 7, (3, (1, 2, 3)): 3, (3, (1, 5, 3)): 7}


def test_heavy_prefixes_are_dealt_over_groups(spark):
    pairs = spark.createDataFrame([(5, 1000), (-9, 30), (1 << 60, 25)], "p long, c long")
    part = phrases.partition(pairs, 1055, 100)
    assert part.heavy.tolist() == [5] and part.heavy_n.tolist() == [10]
    prefix = np.full(1000, 5, np.uint64)
    groups = part.groups(prefix, np.arange(1000, dtype=np.uint64))
    assert sorted(set(groups.tolist())) == list(range(part.light, part.light + 10))


# -- op12 ----------------------------------------------------------------------


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 50_000).astype(np.uint64))
    buckets = bucket_of(keys)
    mph = PerfectHash.of({int(b): ([x.tobytes() for x in built[0]], built[1]) for b in np.unique(buckets) for built in [build(keys[buckets == b])]})
    assert len(mph) == len(keys)
    assert sorted(mph.index(keys).tolist()) == list(range(len(keys)))
    assert len(PerfectHash.of({})) == 0


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(tokenizer_path(A)), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    a.encode_special_tokens = True
    letters = alignment._byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in a.get_vocab().items()}
    b_bytes = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())}
    return a, b, a_bytes, b_bytes


def plain_alignment(texts, encoders):
    """Whole texts, two pointers over byte ranges."""
    a_tk, b_sp, a_bytes, b_bytes = encoders
    links, groups, tokens = [], [], []
    for t in texts:
        a = a_tk.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_sp.encode(t) if t else []
        raw = (" " + t).encode() if t else b""
        if b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
            a, b = [], []
        spans = []
        for ids, table in ((a, a_bytes), (b, b_bytes)):
            ends = np.cumsum([len(table[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends, ids)))
        links.append([(i, j) for s, e, i in spans[0] for x, y, j in spans[1] if s < y and x < e])
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups.append(";".join("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans) for lo, hi in zip([0, *cuts], cuts)))
        tokens.append((len(a), len(b), len(cuts)))
    count = collections.Counter(x for doc in links for x in doc)
    best = collections.Counter()
    for (_, j), c in count.items():
        best[j] = max(best[j], c)
    return [
        (*n, len(doc), sum(count[x] == best[x[1]] for x in doc), sum(count[x] for x in doc), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for n, doc, g in zip(tokens, links, groups)
    ]


ODD_TEXTS = [
    "Hello, world's  end.\nNew line\n\nand\ttabs   and 日本語 text 😀 x", "<|endoftext|> is <s> plain </s> text", "a ▁ b", "  leading", "trailing  ", "\n", " ",
    "one\n two \nthree\x00four \x1cfive\x85six", "don't we'll it's", "x" * 300, "ﬁ ｆｕｌｌ", "é é 12345 1,234.5", "a▁b a b", "tab\there a b", "", None,
]


@pytest.mark.parametrize("lookup_bytes,table_bytes", [(1 << 28, 96 << 20), (0, 2000)])
def test_alignment_matches_whole_texts(spark, make_docs, encoders, monkeypatch, lookup_bytes, table_bytes):
    from .conftest import prose

    monkeypatch.setattr(alignment, "TABLE_BYTES", table_bytes)
    texts = ODD_TEXTS + [prose(i, 80) for i in range(6)] + [prose(1, 80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "repeated id"), (None, "null id")]
    want = plain_alignment([t or "" for _, t in rows], encoders)
    got = alignment.align(make_docs(rows), tokenizer_path(A), tokenizer_path(B), lookup_bytes=lookup_bytes).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted((str(i), *w) for (i, _), w in zip(rows, want))


def test_alignment_tables_rotate(encoders, monkeypatch):
    monkeypatch.setattr(alignment, "TABLE_BYTES", 3000)
    al = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    texts = [f"word{i % 40} of line{i}\nand word{i % 7}." for i in range(200)]
    got = []
    for at in range(0, 200, 10):
        for p in al.places(texts[at : at + 10]):
            got.append(";".join(al.now.groups[w] for w in p))
        if al.full():
            al.turn()
    assert [hashlib.sha256(g.encode()).hexdigest() for g in got] == [w[-1] for w in plain_alignment(texts, encoders)]


def test_token_groups_cover_both_sides(spark, make_docs, encoders):
    docs = make_docs([(1, "Hello brave new world"), (2, None)])
    got = {r.doc_id: r.groups for r in alignment.token_groups(docs, tokenizer_path(A), tokenizer_path(B)).collect()}
    assert got[2] == []
    assert [i for g in got[1] for i in g.a] == encoders[0].encode(" Hello brave new world", add_special_tokens=False).ids
    assert [i for g in got[1] for i in g.b] == encoders[1].encode("Hello brave new world")


def test_alignment_of_an_empty_table(spark, make_docs):
    assert alignment.align(make_docs([]), tokenizer_path(A), tokenizer_path(B)).count() == 0


# -- op13 ----------------------------------------------------------------------


def exact(rows, k):
    """Every query against all rows."""
    out = {}
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8]
    for i, q in fine:
        if i % 20 == 0:
            best = {}
            for j, x in fine:
                if j != i:
                    best[j] = max(best.get(j, -np.inf), float((q * x).sum()))
            for j, s in sorted(best.items(), key=lambda b: (-b[1], b[0]))[:k]:
                out.setdefault(i, []).append((j, s))
    return out


def vectors(n, seed=5, clusters=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, 8)) * 3
    x = centres[r.integers(0, clusters, n)] + r.normal(size=(n, 8))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


SCHEMA = "vec_id long, embedding array<float>, label int, rep string, q string, lists string, rank string"


def test_nearest_matches_exact_search_on_all_lists(spark):
    rows = vectors(300)
    rows += [(1000 + i, rows[40][1]) for i in range(90)]  # copies of a query, ties by id; some of them ask too
    rows += [(2000, [0.0] * 8), (2001, None), (2020, [1.0, None] + [0.0] * 6), (2040, [float("nan")] * 8), (None, rows[0][1]), (2060, [1.0, 2.0]), (2061, []), (2080, [])]
    table = spark.createDataFrame([(i, v, 1, "x", "x", "x", "x") for i, v in rows], SCHEMA)
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, k=5, recall=1.0, list_size=16).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = exact(rows, 5)
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    assert got[40] == want[40] and got[1000] == want[1000]


def test_nearest_recall_and_small_groups(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 50)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 4)
    rows = vectors(1500, seed=9, clusters=60)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, k=10, list_size=12).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact(rows, 10)
    assert all(len(got[i]) == 10 for i in want)
    assert sum(len(got[i] & {j for j, _ in want[i]}) for i in want) / (10 * len(want)) >= 0.9


def test_nearest_of_few_and_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(alone, F.col("vec_id") % 20 == 0).count() == 0
    three = spark.createDataFrame([(1, [1.0, 0.0]), (3, [2.0, 0.0]), (40, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(three, F.col("vec_id") % 20 == 0).orderBy("rank").collect()] == [(40, 1, 3, 2.0), (40, 2, 1, 1.0)]
    assert ann.nearest(three, F.lit(None).cast("boolean")).count() == 0


def test_graph_reaches_every_centroid():
    c = np.concatenate([np.random.default_rng(2).normal(size=(40, 4)), 1000 + np.random.default_rng(3).normal(size=(40, 4))])
    index = ann.Index(np.hstack([c, np.zeros((80, 1))]), ann.linked(np.hstack([c, np.zeros((80, 1))])), 1.0)
    row, which = index.probes(c[:3] + 0.01, 1e9)
    assert [np.sort(which[row == i]).tolist() for i in range(3)] == [list(range(80))] * 3
    row, which = index.probes(c[:3] + 0.01, 0.0)
    assert which.tolist() == [0, 1, 2]
