"""Token ids of whole texts, with each distinct chunk of a text encoded once.

A text is cut only where the tokenizer itself always starts a new piece, so
the concatenated ids equal those of the whole text:

* word BPE (white space dropped, word ends marked): at ASCII white space;
* byte-level BPE: before one space between two characters that are not white
  space (the space opens the next piece).

New chunks go through the library's own normalizer and pre-tokenizer, many at
a time, and its model encodes each distinct piece. Special strings hold no
white space, so a cut never splits one; a chunk that may hold one is encoded
by the library as a whole. Chunks and pieces seen before come from bounded
per-process tables.
"""

from __future__ import annotations

import json
import os
import re
import struct
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

#: Estimated bytes of one generation of chunks, and of pieces, in a Python worker.
CACHE_BYTES = 64 << 20
#: Bytes of an entry besides its characters and ids.
ENTRY_BYTES = 180

#: What str.split parts words at besides ASCII white space; where the tokenizer's
#: normalizer may join chunks, they are encoded one by one.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

#: Letters beside ASCII that may be cut by the file's pattern here (Latin, Cyrillic).
LETTERS = [chr(i) for i in (*range(0xC0, 0x250), *range(0x400, 0x530))]

_LOADED: dict[tuple[str, str], object] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def loaded(kind, path: str):
    """One encoder per worker process and file."""
    key = (kind.__name__, path)
    if key not in _LOADED:
        _LOADED[key] = kind(path)
    return _LOADED[key]


class _Chunked:
    lead = ""  # what stands before a chunk in its text

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tk = Tokenizer.from_file(path)
        self.model, self.pre, self.norm = self.tk.model, self.tk.pre_tokenizer, self.tk.normalizer
        self.marks = [t.content[:2] for t in self.tk.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        self.known = {chr(i) for i in range(32, 127)}  # what a chunk may hold to be cut here
        self.cut = self._cutter(steps["normalizer"], steps["pre_tokenizer"])
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.bytes = 0

    def _cutter(self, normalizer, pre_tokenizer):
        """A function from a chunk of ``known`` characters to its pieces, if the file
        has the steps known here; else None, and the library cuts all chunks."""
        return None

    def _whole(self, chunk: str) -> bytes:
        return _packed(self.tk.encode(self.lead + chunk, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.old_pieces.get(piece)
            if ids is None:
                ids = _packed([t.id for t in self.model.tokenize(piece)])
            self.pieces[piece] = ids
        return ids

    def _plain(self, chunks: list[str]) -> dict[str, bytes]:
        """Chunks without special strings; each alone where joining would blur
        their ends."""
        text = " ".join(chunks)
        if self.norm is not None:
            text = self.norm.normalize_str(text)
            clean = text.split(" ")
        else:
            clean = chunks
        if len(clean) != len(chunks):
            return {c: self._whole(c) for c in chunks}
        found, done = [[] for _ in chunks], -1
        lens = np.fromiter(map(len, clean), np.int64, len(clean))
        ends = np.cumsum(lens + 1).tolist()  # the end of chunk i with the space after it
        if self.lead:
            text = self.lead + text
        at, get, learn = 0, self.pieces.get, self._piece
        for piece, (start, _) in self.pre.pre_tokenize_str(text):
            while start >= ends[at]:
                at += 1
            found[at].append(get(piece) or learn(piece))
        return {c: b"".join(f) for c, f in zip(chunks, found)}

    def _printable(self, chunks: list[str]) -> dict[str, bytes]:
        """Chunks of known characters: the file's pattern, on their letters."""
        cut, get, piece = self.cut, self.pieces.get, self._piece
        out = {}
        for c in chunks:
            found = cut(c)
            if len(found) == 1:  # most are one piece
                p = found[0]
                out[c] = get(p) or piece(p)
            else:
                out[c] = b"".join([get(p) or piece(p) for p in found])
        return out

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        if len(self.pieces) * (ENTRY_BYTES + 16) > CACHE_BYTES:
            self.pieces, self.old_pieces = {}, self.pieces
        out, plain, odd = {}, [], []
        every = "\n".join(chunks)  # a mark in none of them is looked for once, not in each
        marks = [m for m in sorted(set(self.marks)) if m in every]
        unknown = set("".join(chunks)) - self.known
        for c in chunks:
            if marks and any([m in c for m in marks]):
                out[c] = self._whole(c)
            elif self.cut and (not unknown or unknown.isdisjoint(c)):
                plain.append(c)
            elif self.norm is not None and _ODD_SPACE.search(c):
                out[c] = self._whole(c)
            else:
                odd.append(c)
        if plain:
            out |= self._printable(plain)
        if odd:
            out |= self._plain(odd)
        return out

    def values(self, split: list[list[str]]) -> list[bytes]:
        """The ids (little-endian, 4 bytes each) of every chunk of ``split``, in order."""
        if self.bytes > CACHE_BYTES:
            self.kept, self.old, self.bytes = {}, self.kept, 0
        kept, old, chunks = self.kept, self.old, list(chain.from_iterable(split))
        out = list(map(kept.get, chunks))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if missing:
            new = {chunks[i] for i in missing}
            found = {c: old[c] for c in new if c in old}
            if len(found) < len(new):
                found |= self._learn([c for c in new if c not in found])
            kept |= found
            self.bytes += ENTRY_BYTES * len(found) + sum(map(len, found)) + sum(map(len, found.values()))
            for i in missing:
                out[i] = found[chunks[i]]
        return out


#: Packers of up to 15 ids: words have few, and a format is not built for each.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


def _packed(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACK[n](*ids) if n < 16 else struct.pack(f"<{n}I", *ids)


#: Words parted by ASCII white space (the tokenizer does not take 1C to 1F for it).
_WORDS = re.compile(r"[^ \t-\r]+")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class WordBpe(_Chunked):
    """Ids of texts for a word-level BPE file."""

    def _cutter(self, normalizer, pre_tokenizer):
        kinds = [n["type"] for n in (normalizer or {}).get("normalizers", [])]
        rule, *steps = (pre_tokenizer or {}).get("pretokenizers", [{}])
        rule = rule.get("pattern", {}).get("Regex")
        if kinds != ["NFC", "Replace", "Lowercase"] or rule != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
            return None
        spelt = {ord(c): s for c in LETTERS if (s := self._spelling(c))}
        self.known |= {c for c in LETTERS if ord(c) in spelt and ord(c.lower()) in spelt}
        small = "a-z" + "".join(sorted({c.lower() for c in self.known if not c.isascii()}))
        find = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{small}]+|[0-9]|[^\s{small}0-9]+").findall

        def cut(chunk: str) -> list[str]:
            low = chunk.lower()
            found = [low] if low.isalpha() else find(low)
            return found if low.isascii() else [p.translate(spelt) for p in found]

        return cut

    def _spelling(self, letter: str) -> str | None:
        """What the file's steps write for the small form of a letter; None where
        they do not take it for one letter with the small form Python gives."""
        low = letter.lower()
        if len(low) != 1 or self.norm.normalize_str(f"a{letter}a") != f"a{low}a":
            return None
        found = self.pre.pre_tokenize_str(f"a{low}a")
        return found[0][0][1:-1] if len(found) == 1 else None

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        split = [_WORDS.findall(t) if _ODD_SPACE.search(t) else t.split() for t in texts]
        found, at, out = self.values(split), 0, []
        for words in split:
            out.append(np.frombuffer(b"".join(found[at : at + len(words)]), "<u4"))
            at += len(words)
        return out


class ByteBpeCounter(_Chunked):
    """Token counts of texts for a byte-level BPE file."""

    lead = " "

    def _cutter(self, normalizer, pre_tokenizer):
        step = pre_tokenizer or {}
        if normalizer is not None or step.get("type") != "ByteLevel" or step.get("add_prefix_space") or not step.get("use_regex"):
            return None
        find = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+").findall
        return lambda chunk: [p.replace(" ", "Ġ") for p in find(" " + chunk)]

    def counts(self, texts: list[str]) -> list[int]:
        split = [_CUT.split(t) for t in texts]
        heads = [len(e) for e in self.tk.encode_batch_fast([s.pop(0) for s in split], add_special_tokens=False)]
        sizes, at, out = list(map(len, self.values(split))), 0, []
        for head, chunks in zip(heads, split):
            out.append(head + sum(sizes[at : at + len(chunks)]) // 4)
            at += len(chunks)
        return out
