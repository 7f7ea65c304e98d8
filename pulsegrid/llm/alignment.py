"""Alignment of two tokenizers over a corpus.

Each text is encoded, after one space, by a byte-level BPE file (A) and a
sentencepiece model (B). Byte offsets where tokens of both end cut a text into
groups; an A and a B token occurrence are linked if their bytes overlap. Between
two neighbouring ends of either side lies exactly one link.

1. The first pass aligns all texts and counts the linked id pairs of each task.
2. The distinct pairs get a minimal perfect hash (``perfect_hash``), built in
   buckets, each in its own task.
3. Every task's counts become dense vectors indexed by the hash, in blocks, and
   are summed as a tree: in parts first, then over the parts. The keys stand
   beside the counts, so every lookup is verified.
4. The second pass aligns the documents again and looks their links up.

Both files cut words apart before one space or line feed between two characters
that are not white space (checked on the files; otherwise texts are encoded
whole), so a word is encoded and aligned once and a document is put together
from its words. Words come from two bounded generations of a table in each
Python worker; what is used moves from the old one to the new.

The hash, keys and counts are sent to all tasks only up to ``LOOKUP_BYTES``;
beyond, the second pass writes each document's pairs, and a join by pair looks
them up.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, saved
from pulsegrid.llm.perfect_hash import BUCKETS, PerfectHash, bucket_of, build

#: Estimated bytes of words in one generation of a worker's table.
TABLE_BYTES = 96 << 20
#: Most bytes of the lookup (16 a pair) that are sent to every task.
LOOKUP_BYTES = 256 << 20
#: Numbers in a block of the count vectors; parts of the first level of the sum.
BLOCK, PARTS = 1 << 16, 16
BATCH_BYTES = 1 << 22
#: New words encoded by one call.
RUN = 4096

_WORDS = re.compile(r"[ \n]\S+")
_CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)")
PACK = "g int, n long, blob binary"


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in own}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}


class Aligner:
    """Words with their tokens, groups and links, learnt once each; the groups'
    text only where it is read."""

    def __init__(self, a_path: str, b_path: str, look_up=None, with_text: bool = True):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.mark = self.b.piece_to_id("▁")
        self.n_b = len(pieces)
        self.a_text, self.b_text = (np.array([str(i) for i in range(n)], object) for n in (len(self.a_bytes), self.n_b))
        self.a_width, self.b_width = (np.array([len(x) for x in t], np.int64) for t in (self.a_text, self.b_text))
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        with open(a_path, encoding="utf-8") as f:
            steps = json.load(f)
        pre = steps["pre_tokenizer"] or {}
        plain = steps["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.cuts = bool(plain) and not any("▁" in p.lstrip("▁") or ("\n" in p and len(p) > 1) for p in pieces)
        self.look_up, self.with_text = look_up, with_text
        self.old = self.now = Generation()

    def split(self, text: str) -> list[str]:
        text = " " + text
        if not self.cuts:
            return [text]
        words = _WORDS.findall(text)
        return words if sum(map(len, words)) == len(text) else _CUTS.split(text)

    def _encoded(self, words: list[str], raw: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides of words that follow each other in a text; None where
        the tokens' bytes differ from theirs."""
        text = "".join(words)
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:] if text[0] == " " else text)
        if text[0] != " ":
            if b[:1] != [self.mark]:
                return None
            b = b[1:]
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def learn(self, words: list[str]) -> None:
        """Tokens of both sides, groups and links of new words. Words are encoded many
        at a time: put one after the other they are a text that is cut between them."""
        odd = [w for w in words if w[-1].isspace() or w[1:2].isspace()]  # not cut from their neighbours
        if odd:
            words = list(set(words).difference(odd))
        kept, ends_kept, a, b = [], [], [], []
        for run in [*(words[at : at + RUN] for at in range(0, len(words), RUN)), *([w] for w in odd)]:
            self._learn_run(run, kept, ends_kept, a, b)
        if not kept:
            return
        ai, bi, word_len = np.concatenate(a), np.concatenate(b), np.concatenate(ends_kept)
        a_end, b_end, word_end = np.cumsum(self.a_len[ai]), np.cumsum(self.b_len[bi]), np.cumsum(word_len)
        ends = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        again = np.concatenate([ends[1:] == ends[:-1], [False]])
        both, ends = ends[again], ends[~again]
        keys = ai[np.searchsorted(a_end, ends)].astype(np.uint64) * np.uint64(self.n_b) + bi[np.searchsorted(b_end, ends)].astype(np.uint64)
        a_cut, b_cut = np.searchsorted(a_end, both, side="right"), np.searchsorted(b_end, both, side="right")
        a_last, b_last, links, groups = (np.searchsorted(x, word_end, side="right") for x in (a_end, b_end, ends, both))
        total = best = np.zeros(len(kept), np.int64)
        if self.look_up is not None:
            counts, top = self.look_up(keys)
            total, best = (np.diff(np.concatenate([[0], np.cumsum(x)])[links], prepend=0) for x in (counts, top.astype(np.int64)))
        sizes = np.stack([*(np.diff(x, prepend=0) for x in (a_last, b_last, groups, links)), best, total], 1)
        texts = self._texts(ai, bi, a_cut, b_cut, groups) if self.with_text else [""] * len(kept)
        self.now.add(kept, texts, keys, links, sizes)

    def _learn_run(self, words: list[str], kept: list, lengths: list, a: list, b: list) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        found = self._encoded(words, b"".join(raw))
        if found is not None and len(words) > 1:
            for ids, lens in zip(found, (self.a_len, self.b_len)):
                marks = np.cumsum(lens[ids])
                at = np.minimum(np.searchsorted(marks, ends), len(marks) - 1)
                if (marks[at] != ends).any():
                    found = None
                    break
        if found is None:
            if len(words) > 1:
                for at in range(0, len(words), max(1, len(words) // 16)):
                    self._learn_run(words[at : at + max(1, len(words) // 16)], kept, lengths, a, b)
            else:
                self.now.add(words, [None], np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros((1, 6), np.int64))
            return
        kept.extend(words)
        lengths.append(sizes)
        a.append(found[0])
        b.append(found[1])

    def _texts(self, ai: np.ndarray, bi: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, groups: np.ndarray) -> list[str]:
        """The words' groups as text: ids of a group side by side, each followed by
        its separator, joined once and cut at the words' ends."""
        n, g = len(ai) + len(bi), len(a_cut)
        a_of, b_of = (np.repeat(np.arange(g), np.diff(c, prepend=0)) for c in (a_cut, b_cut))
        b_before, a_upto = np.concatenate([[0], b_cut[:-1]]), a_cut
        a_at, b_at = np.arange(len(ai)) + b_before[a_of], np.arange(len(bi)) + a_upto[b_of]
        out = np.empty(2 * n, object)
        out[2 * a_at], out[2 * b_at] = self.a_text[ai], self.b_text[bi]
        out[1::2] = ","
        out[2 * a_at[a_cut - 1] + 1], out[2 * b_at[b_cut - 1] + 1] = "|", ";"
        width = np.empty(n, np.int64)
        width[a_at], width[b_at] = self.a_width[ai], self.b_width[bi]
        text = "".join(out.tolist())
        ends = np.cumsum(width + 1)[(a_cut + b_cut - 1)[groups - 1]].tolist()
        return [text[s : e - 1] for s, e in zip([0, *ends], ends)]

    def places(self, texts: list[str]) -> list[np.ndarray | None]:
        """Numbers of the words of each text in the current generation, new ones
        learnt; None where some word's bytes differ."""
        split = [self.split(t) for t in texts]
        found = list(chain.from_iterable(split))
        at = self.now.find(found)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = list({found[i] for i in missing.tolist()})
            left = self.now.move(new, self.old)
            if left:
                self.learn(left)
            at[missing] = self.now.find([found[i] for i in missing.tolist()])
        cuts = np.cumsum([len(x) for x in split])[:-1] if split else []
        bad = self.now.bad
        return [None if bad and not bad.isdisjoint(p.tolist()) else p for p in np.split(at, cuts)] if split else []

    def full(self) -> bool:
        return self.now.bytes > TABLE_BYTES

    def turn(self) -> None:
        """The table becomes the old generation."""
        self.old, self.now = self.now, Generation()


class Generation:
    """A table of words: groups as text, links (ragged), and the sizes (tokens of A
    and B, groups, links, best links, sum of counts)."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.groups: list[str | None] = []  # None where the bytes differ
        self.bad: set[int] = set()  # places of those
        self.keys, self.ends, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, 6), np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, words: list[str], groups: list, keys: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.groups)
        self.number.update(zip(words, range(n, n + len(words))))
        self.bad.update(n + i for i, g in enumerate(groups) if g is None)
        self.groups.extend(groups)
        self.parts.append((keys, ends, sizes))
        self.bytes += 320 * len(words) + 2 * sum(map(len, words)) + sum(len(g or "") for g in groups) + keys.nbytes

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, ends, sizes) of all words."""
        if self.parts:
            at, ends = len(self.keys), [self.ends]
            for keys, end, _ in self.parts:
                ends.append(end + at)
                at += len(keys)
            self.keys = np.concatenate([self.keys, *(p[0] for p in self.parts)])
            self.ends = np.concatenate(ends)
            self.sizes = np.concatenate([self.sizes, *(p[2] for p in self.parts)])
            self.parts = []
        return self.keys, self.ends, self.sizes

    def links(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, number of keys of each) of the words ``at``."""
        keys, ends, _ = self.arrays()
        n = ends[at] - np.where(at > 0, ends[at - 1], 0) if len(at) else np.zeros(0, np.int64)
        last = np.cumsum(n)
        return keys[np.repeat(ends[at] - last, n) + np.arange(int(last[-1]) if len(last) else 0)], n

    def find(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))

    def move(self, words: list[str], old: Generation) -> list[str]:
        """Copy what ``old`` knows; the words it does not know."""
        if old is self or not old.groups:
            return words
        at = old.find(words)
        have = np.flatnonzero(at >= 0)
        if len(have):
            keys, n = old.links(at[have])
            self.add([words[i] for i in have.tolist()], [old.groups[i] for i in at[have].tolist()], keys, np.cumsum(n), old.arrays()[2][at[have]])
        return [words[i] for i in np.flatnonzero(at < 0).tolist()]


_HELD: dict[str, Aligner] = {}


def aligner(run: str, a_path: str, b_path: str, look_up=None, with_text: bool = True) -> Aligner:
    """One aligner a worker, for the run at hand only."""
    if run not in _HELD:
        _HELD.clear()
        _HELD[run] = Aligner(a_path, b_path, look_up, with_text)
    return _HELD[run]


def _texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _pair_counts(run_id: str, a_path: str, b_path: str):
    """Counts of a task's linked pairs, packed by bucket of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(run_id, a_path, b_path, with_text=False)
        used = np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch | None:
            at = np.flatnonzero(used)
            keys, n = al.now.links(at)
            counts = np.repeat(used[at], n)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            if not len(first):
                return None
            keys, counts = keys[first], np.add.reduceat(counts, first)
            g = bucket_of(keys)
            order = np.argsort(g, kind="stable")
            keys, counts, g = keys[order], counts[order], g[order]
            cuts = np.searchsorted(g, np.arange(BUCKETS + 1)).tolist()
            rows = [(b, e - s, keys[s:e].tobytes() + counts[s:e].tobytes()) for b, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], names=["g", "n", "blob"])

        for batch in by_bytes(batches, 0, BATCH_BYTES):
            good = [p for p in al.places([t for t in _texts_of(batch.column(0)) if t]) if p is not None]
            n = len(al.now.groups)
            if len(used) < n:
                used = np.concatenate([used, np.zeros(n + n // 2 - len(used), np.int64)])
            if good:
                used[:n] += np.bincount(np.concatenate(good), minlength=n)
            if al.full():
                out = flush()
                if out is not None:
                    yield out
                al.turn()
                used = np.zeros(0, np.int64)
        out = flush()
        if out is not None:
            yield out

    return run


def _packed(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for n, blob in zip(group.column("n").to_pylist(), group.column("blob")):
        data = memoryview(blob.as_buffer())
        keys.append(np.frombuffer(data[: 8 * n], np.uint64))
        counts.append(np.frombuffer(data[8 * n :], np.int64))
    return np.concatenate(keys), np.concatenate(counts)


def _hash_bucket(group: pa.Table) -> pa.Table:
    keys = np.unique(_packed(group)[0])
    levels, left = build(keys)
    blobs = [x.tobytes() for x in levels] + [left.tobytes()]
    return pa.table({"g": pa.array([group.column("g")[0].as_py()] * len(blobs), pa.int32()), "level": pa.array([*range(len(levels)), -1], pa.int32()), "bits": pa.array(blobs, pa.binary())})


def perfect_hash(pairs: DataFrame) -> PerfectHash:
    """The hash over all distinct keys of packed pair counts (about 4 bits a key reach the driver)."""
    buckets: dict[int, tuple[list[bytes], np.ndarray]] = {}
    for r in pairs.groupBy("g").applyInArrow(_hash_bucket, "g int, level int, bits binary").orderBy("g", "level").toLocalIterator():
        levels, left = buckets.get(r.g, ([], np.zeros(0, np.uint64)))
        if r.level < 0:
            left = np.frombuffer(bytes(r.bits), np.uint64)
        else:
            levels = [*levels, bytes(r.bits)]
        buckets[r.g] = (levels, left)
    return PerfectHash.of(buckets)


VECTORS = "block int, part int, counts binary, keys binary"


def _dense(shared):
    """Packed counts of a task as dense vectors, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mph, salt = shared.value, uuid.uuid4().int % PARTS
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, counts = _packed(pa.Table.from_batches([batch]))
            at = mph.index(keys)
            block = at // BLOCK
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order], prepend=-1, append=-2))
            for s, e in zip(cuts, cuts[1:]):
                rows = order[s:e]
                b = int(block[rows[0]])
                if b not in held:
                    held[b] = (np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.uint64))
                np.add.at(held[b][0], at[rows] % BLOCK, counts[rows])
                held[b][1][at[rows] % BLOCK] = keys[rows] + np.uint64(1)
        for b, (c, k) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([salt], pa.int32()), pa.array([c.tobytes()]), pa.array([k.tobytes()])], names=["block", "part", "counts", "keys"])

    return run


def _summed(group: pa.Table) -> pa.Table:
    counts, keys = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.uint64)
    for c, k in zip(group.column("counts"), group.column("keys")):
        counts += np.frombuffer(c.as_buffer(), np.int64)
        k = np.frombuffer(k.as_buffer(), np.uint64)
        if ((keys != k) & (keys > 0) & (k > 0)).any():
            raise ValueError("two pairs share a number of the perfect hash")
        keys = np.maximum(keys, k)
    part = group.column("part")[0].as_py()
    return pa.table({"block": group.column("block")[:1], "part": pa.array([part], pa.int32()), "counts": [counts.tobytes()], "keys": [keys.tobytes()]})


def count_vectors(pairs: DataFrame, mph: PerfectHash) -> DataFrame:
    """Dense count and key vectors (key + 1; 0 is empty), one row a block."""
    sent = pairs.sparkSession.sparkContext.broadcast(mph)
    parts = pairs.mapInArrow(_dense(sent), VECTORS)
    out = saved(parts.groupBy("block", "part").applyInArrow(_summed, VECTORS).groupBy("block").applyInArrow(_summed, VECTORS), "vectors")
    sent.destroy()
    return out


def _tops(n_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(n_b, np.int64)
        for batch in batches:
            for c, k in zip(batch.column(0), batch.column(1)):
                k, c = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.int64)
                np.maximum.at(best, ((k[k > 0] - np.uint64(1)) % np.uint64(n_b)).astype(np.int64), c[k > 0])
        at = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(best[at])], names=["b", "c"])

    return run


def best_counts(vectors: DataFrame, n_b: int) -> np.ndarray:
    """The highest pair count of every B id (the size of B's vocabulary)."""
    best = np.zeros(n_b, np.int64)
    for r in vectors.select("counts", "keys").mapInArrow(_tops(n_b), "b long, c long").groupBy("b").agg(F.max("c").alias("c")).collect():
        best[r.b] = r.c
    return best


class Lookup:
    """Counts of pairs and whether they are the best of their B id."""

    def __init__(self, mph: PerfectHash, counts: np.ndarray, keys: np.ndarray, best: np.ndarray):
        self.mph, self.counts, self.keys, self.best = mph, counts, keys, best

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.mph.index(keys)
        if len(keys) and (self.keys[at] != keys + np.uint64(1)).any():
            raise ValueError("a pair of the second pass was not counted in the first")
        c = self.counts[at]
        return c, c == self.best[(keys % np.uint64(len(self.best))).astype(np.int64)]


def _digests(shared, run_id: str, a_path: str, b_path: str, with_pairs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(run_id, a_path, b_path, shared.value if shared is not None else None)
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            texts = _texts_of(batch.column(1))
            some = [i for i, t in enumerate(texts) if t]
            numbers = np.zeros((len(texts), 6), np.int64)
            sha = [""] * len(texts)
            keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
            places = al.places([texts[i] for i in some])
            sizes = al.now.arrays()[2]
            for i, p in zip(some, places):
                if p is None:
                    continue
                numbers[i] = sizes[p].sum(axis=0)
                sha[i] = hashlib.sha256(";".join(map(al.now.groups.__getitem__, p.tolist())).encode()).hexdigest()
                if with_pairs:
                    keys[i] = al.now.links(p)[0]
            columns = [batch.column(0), *[pa.array(numbers[:, j]) for j in (0, 1, 2, 3, 4, 5)], pa.array(sha)]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            if with_pairs:
                pairs = [np.unique(k, return_counts=True) for k in keys]
                columns += [pa.array([k.astype(np.int64) for k, _ in pairs], pa.list_(pa.int64())), pa.array([c for _, c in pairs], pa.list_(pa.int64()))]
                names += ["keys", "times"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            if al.full():
                al.turn()

    return run


def _pair_rows(n_b: int, best):
    """Vectors as (key, c, top) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, k in zip(batch.column(0), batch.column(1)):
                k, c = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.int64)
                k, c = k[k > 0] - np.uint64(1), c[k > 0]
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(c), pa.array((c == best[(k % np.uint64(n_b)).astype(np.int64)]).astype(np.int64))], names=["key", "c", "top"])

    return run


def _groups(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(f"groups {a_path} {b_path}", a_path, b_path)
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            texts = _texts_of(batch.column(1))
            out = []
            found = iter(al.places([t for t in texts if t]))
            for t in texts:
                p = next(found) if t else None
                out.append([] if p is None else ";".join(al.now.groups[w] for w in p).split(";"))
            pairs = [[dict(zip("ab", ([int(x) for x in side.split(",")] for side in g.split("|")))) for g in doc] for doc in out]
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pairs, kind)], names=["doc_id", "groups"])
            if al.full():
                al.turn()

    return run


def token_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, groups): the aligned groups of each text as lists of A and B ids."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return texts.mapInArrow(_groups(a_path, b_path), "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    Null and empty texts and texts whose bytes either side does not give back
    (literal U+2581) have no tokens: zeros and an empty digest, and they add
    nothing to the counts. Every row counts, repeated ids and texts included;
    null ids stay null. An empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    pairs = saved(texts.select("t").mapInArrow(_pair_counts(uuid.uuid4().hex, a_path, b_path), PACK), "pairs")
    mph = perfect_hash(pairs)
    vectors = count_vectors(pairs, mph)
    n_b = len(Aligner(a_path, b_path).b_bytes)
    best = best_counts(vectors, n_b)
    digest = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    if 16 * len(mph) <= lookup_bytes:
        counts, keys = np.zeros(len(mph), np.int64), np.zeros(len(mph), np.uint64)
        for r in vectors.toLocalIterator():
            at = slice(r.block * BLOCK, min(len(mph), (r.block + 1) * BLOCK))
            counts[at], keys[at] = (np.frombuffer(bytes(x), t)[: at.stop - at.start] for x, t in ((r.counts, np.int64), (r.keys, np.uint64)))
        sent = spark.sparkContext.broadcast(Lookup(mph, counts, keys, best))
        out = saved(texts.mapInArrow(_digests(sent, uuid.uuid4().hex, a_path, b_path, False), digest), "aligned")
        sent.destroy()
        return out
    found = saved(
        texts.mapInArrow(_digests(None, uuid.uuid4().hex, a_path, b_path, True), digest + ", keys array<long>, times array<long>")
        .withColumn("row", F.monotonically_increasing_id()),
        "aligned",
    )
    table = vectors.select("counts", "keys").mapInArrow(_pair_rows(n_b, best), "key long, c long, top long")
    # a frequent pair stands on most rows: both sides are dealt over salts
    table = table.withColumn("salt", F.explode(F.expr("sequence(0, 15)")))
    links = found.select("row", F.explode(F.arrays_zip("keys", "times")).alias("p")).select("row", F.col("p.keys").alias("key"), F.col("p.times").alias("n"), F.expr("cast(pmod(row, 16) AS int)").alias("salt"))
    sums = links.join(table, ["key", "salt"]).groupBy("row").agg(F.sum(F.col("n") * F.col("top")).alias("n_best"), F.sum(F.col("n") * F.col("c")).alias("count_sum"))
    rest = found.drop("n_best", "count_sum", "keys", "times").join(sums, "row", "left")
    return rest.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
