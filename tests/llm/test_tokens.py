import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsegrid.llm.elias_fano import EliasFano
from pulsegrid.llm.packing import pack, plan_bins, solve_configurations
from pulsegrid.llm.token_counts import count_tokens, safe_pieces
from pulsegrid.llm.token_store import open_store, read_documents, write_store
from pulsegrid.llm.tokens import ByteBpeCounter, WordBpe, loaded, tokenizer_path

from .conftest import prose

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
TEXTS = [
    (4, prose(1, 3000)), (2, None), (9, ""), (1, " "), (7, "a<|endoftext|>b  c\n\n d"), (3, prose(2, 30)), (3, prose(3, 30)),
    (None, "no id"), (12, "Σας é ́x\x1cq\x85 1234 it's"), (11, "w" * 30_000), (10, "same text"), (8, "same text"),
]
ODD = st.text(alphabet=" \n\t.,'abé́Σ\x1c\x85\xa01$中<|>", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=4))
def test_cuts_keep_ids(texts):
    w, b = loaded(WordBpe, WORD), loaded(ByteBpeCounter, BYTE)
    assert [x.tolist() for x in w.ids(texts)] == [e.ids for e in w.tk.encode_batch(texts, add_special_tokens=False)]
    assert b.counts(texts) == [len(e.ids) for e in b.tk.encode_batch(texts, add_special_tokens=False)]


LATIN = st.text(alphabet=" \n'!?$aZst1éÉñßçÜıİſΣжЖй́²½中", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(LATIN, min_size=1, max_size=4))
def test_letters_beside_ascii_keep_ids(texts):
    w = WordBpe(WORD)
    for again in range(2):  # learnt, then known
        assert [x.tolist() for x in w.ids(texts)] == [e.ids for e in w.tk.encode_batch(texts, add_special_tokens=False)]


def test_latin_words_are_cut_by_the_pattern(monkeypatch):
    """They were sent through the library's steps like any odd text."""
    w = loaded(WordBpe, WORD)
    monkeypatch.setattr(w, "_plain", lambda chunks: pytest.fail("not cut here"))
    text = "Größe unweit, élan ÑANDÚ façade's жук"
    assert w.ids([text])[0].tolist() == w.tk.encode(text, add_special_tokens=False).ids
    assert not {"İ", "Σ", "中", "\u0301", "½"} & w.known


@settings(max_examples=100, deadline=None)
@given(ODD)
def test_safe_pieces_add_up(text):
    b = loaded(ByteBpeCounter, BYTE)
    pieces = list(safe_pieces(text * 3, 7))
    assert "".join(pieces) == text * 3
    assert sum(len(e) for e in b.tk.encode_batch(pieces, add_special_tokens=False)) == len(b.tk.encode(text * 3, add_special_tokens=False))


def test_counts(spark, make_docs):
    tk = Tokenizer.from_file(BYTE)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(make_docs(TEXTS), BYTE, limit=20, batch_bytes=1000).collect())
    want = []
    for i, t in TEXTS:
        n = len(tk.encode(t or "", add_special_tokens=False))
        want.append((i or -1, len((t or "").encode()), n, n > 20))
    assert got == sorted(want)
    assert count_tokens(make_docs([]), BYTE).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300), st.booleans())
def test_elias_fano_round_trip(values, dense):
    v = np.sort(np.array([x % 50 if dense else x for x in values], np.int64))
    e = EliasFano.encode(v)
    again = EliasFano(e.n, e.low_bits, e.lower, e.upper, e.samples)
    at = np.arange(len(v))[::-1]
    assert again.select(at).tolist() == v[at].tolist()


def test_elias_fano_is_small():
    v = np.cumsum(np.random.default_rng(0).integers(1, 1000, 20_000))
    assert EliasFano.encode(v).size() * 8 < len(v) * (2.5 + np.log2(v[-1] / len(v)))


def test_store_round_trip(spark, make_docs, tmp_path, monkeypatch):
    tk = Tokenizer.from_file(WORD)
    write_store(make_docs(TEXTS), str(tmp_path / "store"), WORD)
    got = read_documents(open_store(spark, str(tmp_path / "store"))).collect()
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 4, 7, 8, 9, 10, 11, 12]
    at = 0
    by_id = defaultdict(list)
    for i, t in TEXTS:
        by_id[i].append(np.array([*tk.encode(t or "", add_special_tokens=False).ids, 2], "<u4"))
    for r in got:
        assert r.start == at
        at += r.n_tokens
        assert (r.n_tokens, r.ids_crc32) in [(len(x), zlib.crc32(x.tobytes())) for x in by_id[r.doc_id]]
    assert sorted((r.doc_id or 0, r.ids_crc32) for r in got) == sorted((i or 0, zlib.crc32(x.tobytes())) for i, xs in by_id.items() for x in xs)
    write_store(make_docs([]), str(tmp_path / "none"), WORD)
    assert read_documents(open_store(spark, str(tmp_path / "none"))).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_the_histogram(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(5, 1.2, 3000).astype(int) + 1, 1024)
    histogram = {int(k): int(v) for k, v in Counter(lengths.tolist()).items()}
    plan = plan_bins(histogram, 1024, steps=100)
    got = Counter()
    for conf, copies in plan:
        assert copies > 0 and sum(k * n for k, n in conf.items()) <= 1024
        for k, n in conf.items():
            got[k] += n * copies
    assert got == histogram
    bound = -(-sum(k * n for k, n in histogram.items()) // 1024)
    assert sum(c for _, c in plan) <= bound * 1.02 + 1
    assert plan_bins({}, 1024) == [] and plan_bins({1024: 3}, 1024) == [({1024: 1}, 3)]


def test_configurations_reach_the_optimum():
    # 60 % and 40 % pieces: the program pairs them
    found = solve_configurations(np.array([100.0, 100.0]), np.array([40, 60]), 100, 200)
    assert sum(a for _, a in found) <= 100 / 0.99 and min(sum(a * c.get(i, 0) for c, a in found) for i in (0, 1)) > 90


def test_pack(spark, make_docs):
    tk = Tokenizer.from_file(WORD)
    rows = TEXTS + [(1000 + i, "short one") for i in range(300)]
    found = pack(make_docs(rows), WORD, capacity=256).collect()
    whole = Counter()
    for i, t in rows:
        x = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for p, at in enumerate(range(0, len(x), 256)):
            part = x[at : at + 256]
            whole[i, p, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == whole
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert len(by) <= -(-sum(r.length for r in found) // 256) + 2
    assert pack(make_docs([]), WORD).collect() == []


def test_ids_of_one_word_and_of_marks_among_other_words():
    """Texts of no, one and many words, and chunks with a special string beside plain ones."""
    path = tokenizer_path("word_bpe_49k.json")
    library, tk = Tokenizer.from_file(path), WordBpe(path)
    mark = next(iter(library.get_added_tokens_decoder().values())).content
    texts = ["", "   ", "one", f"{mark}", f"plain words {mark} and a{mark}b", "x" * 200, "äö ß-word, it's 12", "no mark here"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in tk.ids(texts)] == want
    assert [x.tolist() for x in tk.ids(texts[::-1])] == want[::-1]
