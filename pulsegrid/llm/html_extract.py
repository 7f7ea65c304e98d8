"""Main-text extraction with a recurrent block labeller.

A page is read into leaf blocks. Each block is a vector: learned vectors of
the tags, classes and ids on its path, learned vectors of its hashed words,
and a few numbers (length, link share, place). A bidirectional LSTM in numpy
reads all blocks of a page in order and labels every block with the whole
page as context; the text of a page is its content blocks joined by a space.

The labeller is trained on the driver with weak labels: at most ``sample``
pages of the input (a documented bound, lowest hashes first), labelled by the
elements and class names around a block, and ``made`` pages put together from
layouts with known labels, in which class names are often replaced, so that
context and words count too.

A null page is an empty text. Cut-off pages are read as far as they go.
Repeated rows give one output row each. No page is shortened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, lowest_hashed, string_views, word_hashes
from pulsegrid.llm.html_blocks import Block, blocks_of

PATH_BINS, WORD_BINS = 1024, 1024
PATH_DIM, WORD_DIM, NUMBERS, HIDDEN = 16, 6, 6, 16
BATCH_BYTES = 1 << 20

#: Names of page furniture in classes, ids and roles; fixed values.
FURNITURE = frozenset(
    "ad ads adv advert advertisement adverts banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
    "overlay dialog nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer copyright legal sidebar side "
    "widget widgets aside related recommended share sharing social newsletter subscribe signup login search form comment comments commentlist reply "
    "replies discussion disqus respond thread toolbar skip".split()
)
_FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset legend label".split())
_CONTENT_TAGS = frozenset("article main".split())


def weak_label(path: tuple[str, ...]) -> float:
    """1 for content by the elements around a block, 0 for page furniture."""
    inside = 0.5
    for mark in path:
        kind, _, name = mark.partition(":")
        if kind == "t" and name in _FURNITURE_TAGS or kind == "c" and name in FURNITURE:
            return 0.0
        if kind == "t" and name == "header" and inside < 1:
            return 0.0
        if kind == "t" and name in _CONTENT_TAGS or kind == "c" and name in ("article", "content", "entry", "post", "story", "main"):
            inside = 1.0
    return inside


# -- made pages --------------------------------------------------------------

_MENU = "home about contact login news shop blog help products services team careers press archive startseite kontakt accueil inicio".split()
_NOTICE = "we use cookies accept all privacy policy settings consent agree decline utilisons acceptez akzeptieren aceptar".split()
_FOOT = "copyright all rights reserved terms imprint privacy contact sitemap powered by".split()
_TALK = "says reply posted ago thanks great first agree comment like report".split()
_FORM = "email name password subscribe sign up search submit send your address".split()
_SYLLABLES = "an er on th re in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve che ent un qu la ic ber ung lich zu el os ad ci ue".split()


class _Maker:
    """Pages with known labels."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)
        self.odd = 0.1  # share of furniture with a class name that says nothing

    def pick(self, some):
        return some[int(self.rng.integers(len(some)))]

    def prose(self, lo: int, hi: int) -> str:
        n = int(self.rng.integers(lo, hi + 1))
        words = ["".join(self.pick(_SYLLABLES) for _ in range(int(self.rng.integers(1, 5)))) for _ in range(n)]
        return " ".join(words).capitalize() + "."

    def words(self, pool, lo: int, hi: int) -> str:
        if self.rng.random() < 0.5:
            return self.prose(lo, hi)
        return " ".join(self.pick(pool) for _ in range(int(self.rng.integers(lo, hi + 1)))).capitalize()

    def name(self, *known: str) -> str:
        if self.rng.random() < self.odd:
            return "x" + self.pick(_SYLLABLES) + self.pick(_SYLLABLES)
        return self.pick(known)

    def furniture(self) -> tuple[tuple[str, ...], list[tuple[tuple[str, ...], str, bool]]]:
        """(path, leaf blocks as (path, text, linked)) of one piece."""
        kind = int(self.rng.integers(9))
        many = int(self.rng.integers(2, 8))
        if kind == 0:
            outer = self.pick([("t:nav",), ("t:div", "c:" + self.name("menu", "nav", "navbar", "navigation")), ("t:ul", "c:" + self.name("menu", "nav"))])
            return outer, [(("t:ul", "t:li"), self.words(_MENU, 1, 3), True) for _ in range(many)]
        if kind == 1:
            outer = self.pick([("t:div", "c:" + self.name("ad", "ads", "advert", "banner", "sponsored", "promo")), ("t:aside", "c:" + self.name("ad", "promo")), ("t:section", "c:" + self.name("advertisement", "sponsor"))])
            return outer, [(self.pick([(), ("t:p",)]), self.prose(3, 30), self.rng.random() < 0.3) for _ in range(int(self.rng.integers(1, 3)))]
        if kind == 2:
            outer = self.pick([("t:footer",), ("t:div", "c:" + self.name("footer", "copyright", "legal"))])
            return outer, [(self.pick([(), ("t:p",), ("t:ul", "t:li")]), self.words(_FOOT, 2, 14), self.rng.random() < 0.4) for _ in range(int(self.rng.integers(1, 4)))]
        if kind == 3:
            outer = self.pick([("t:div", "c:" + self.name("cookie", "consent", "notice", "gdpr", "popup")), ("t:section", "c:" + self.name("cookie", "notice"), "c:" + self.name("banner", "bar")), ("t:dialog",), ("t:div", "c:dialog")])
            return outer, [(("t:p",), self.words(_NOTICE, 4, 25), False) for _ in range(int(self.rng.integers(1, 3)))]
        if kind == 4:
            outer = self.pick([("t:aside",), ("t:div", "c:" + self.name("sidebar", "widget", "related")), ("t:section", "c:" + self.name("related", "recommended"))])
            return outer, [(self.pick([("t:ul", "t:li"), ("t:p",), ("t:h3",), ("t:div",)]), self.prose(2, 25), self.rng.random() < 0.6) for _ in range(many)]
        if kind == 5:
            outer = self.pick([("t:form",), ("t:div", "c:" + self.name("newsletter", "subscribe", "login", "search"), "t:form"), ("t:form", "c:" + self.name("signup", "search"))])
            return outer, [(self.pick([("t:label",), ("t:p",), (), ("t:div",)]), self.words(_FORM, 1, 10), False) for _ in range(int(self.rng.integers(1, 4)))]
        if kind == 6:
            outer = self.pick([("t:section", "c:" + self.name("comments", "discussion")), ("t:div", "c:" + self.name("comments", "comment", "replies", "disqus")), ("t:ol", "c:" + self.name("commentlist", "comments"), "t:li", "c:comment")])
            return outer, [(self.pick([("t:p",), ("t:div", "c:" + self.name("comment", "reply")), ("t:div", "c:comment", "t:p")]), self.words(_TALK, 2, 40), False) for _ in range(many)]
        if kind == 7:
            outer = self.pick([("t:header",), ("t:div", "c:" + self.name("header", "masthead", "topbar")), ("t:header", "c:" + self.name("site", "page"), "c:header")])
            return outer, [(self.pick([("t:h1",), ("t:p",), ("t:div", "c:logo"), ()]), self.words(_MENU, 1, 6), self.rng.random() < 0.5) for _ in range(int(self.rng.integers(1, 4)))]
        outer = self.pick([("t:div", "c:" + self.name("share", "social")), ("t:div", "c:" + self.name("breadcrumb", "breadcrumbs")), ("t:ul", "c:" + self.name("pagination", "breadcrumb"))])
        return outer, [(self.pick([(), ("t:li",)]), self.words(_MENU, 1, 3), True) for _ in range(many)]

    def page(self) -> tuple[list[Block], list[float]]:
        top = ("t:html", "t:body")
        if self.rng.random() < 0.4:
            top += ("t:div", "c:" + self.pick(("page", "wrapper", "container", "site")))
        self.odd = 0.1
        hold = top + self.pick([
            ("t:article",), ("t:article",), ("t:main",), ("t:main", "t:article"), ("t:div", "c:" + self.name("content", "post", "entry", "article", "story")),
            ("t:section", "c:" + self.name("content", "article")), ("t:div", "c:main", "t:div"), ("t:div",), (), ("t:table", "t:tr", "t:td"),
        ])
        pieces: list[tuple[tuple[str, ...], str, bool, float]] = []

        def furniture(base: tuple[str, ...], n: int) -> None:
            self.odd = 0.1 if base == top else 0.0
            for _ in range(n):
                outer, leaves = self.furniture()
                if base != top and outer[0] in ("t:header", "t:footer") or (base != top and outer[0] == "t:div" and "c:header" in outer):
                    continue
                pieces.extend((base + outer + p, t, a, 0.0) for p, t, a in leaves)

        furniture(top, int(self.rng.integers(0, 5)))
        if self.rng.random() < 0.8:
            pieces.append((hold + self.pick([("t:h1",), ("t:h1",), ("t:header", "t:h1"), ("t:h2",)]), self.prose(2, 12), False, 1.0))
        for _ in range(int(self.rng.integers(1, 14))):
            tail = self.pick([("t:p",)] * 8 + [("t:p", "t:b"), ("t:h2",), ("t:h3",), ("t:ul", "t:li"), ("t:ol", "t:li"), ("t:blockquote", "t:p"), ("t:pre",), ("t:div", "t:p"), ("t:section", "t:p"), ("t:figure", "t:figcaption"), ()])
            listed = "t:li" in tail
            for _ in range(int(self.rng.integers(2, 8)) if listed else 1):
                pieces.append((hold + tail, self.prose(1, 12 if listed else 60), self.rng.random() < 0.05, 1.0))
            if self.rng.random() < 0.06:
                furniture(hold, 1)
        if self.rng.random() < 0.3:
            furniture(hold, 1)
        furniture(top, int(self.rng.integers(0, 5)))
        return [Block(t, p, len(t) if a else 0) for p, t, a, _ in pieces], [y for *_, y in pieces]


# -- vectors -----------------------------------------------------------------

_PATH_KEPT: dict[str, int] = {}


def _path_bin(mark: str) -> int:
    at = _PATH_KEPT.get(mark)
    if at is None:
        if len(_PATH_KEPT) > 100_000:
            _PATH_KEPT.clear()
        at = _PATH_KEPT[mark] = int(word_hashes(*string_views(pa.array([mark])))[0][0] % np.uint64(PATH_BINS))
    return at


class Batch:
    """Blocks of several pages as index arrays: path and word bins with their
    block, numbers, and each page's blocks."""

    def __init__(self, pages: list[list[Block]]):
        self.lengths = np.array([len(p) for p in pages], np.int64)
        blocks = [b for p in pages for b in p]
        n = len(blocks)
        marks = [set(b.path) for b in blocks]
        self.path_of = np.repeat(np.arange(n), [len(m) for m in marks])
        self.path = np.fromiter((_path_bin(x) for m in marks for x in m), np.int64, len(self.path_of))
        words, at = word_hashes(*string_views(pa.array([b.text for b in blocks], pa.string())), punctuation=True)
        count = np.diff(at) if n else np.zeros(0, np.int64)
        self.word_of = np.repeat(np.arange(n), count)
        self.word = (words % np.uint64(WORD_BINS)).astype(np.int64)
        self.word_share = 1 / np.maximum(count, 1)[self.word_of] if n else np.zeros(0)
        chars = np.array([len(b.text) for b in blocks], float)
        place = np.concatenate([(np.arange(k) + 0.5) / k for k in self.lengths if k]) if n else np.zeros(0)
        size = np.repeat(self.lengths, self.lengths)
        self.numbers = np.stack([
            np.log1p(chars) / 6, np.minimum(np.array([b.linked for b in blocks], float) / np.maximum(chars, 1), 1), place, np.log1p(count) / 5,
            np.array([b.text.count(".") + b.text.count(",") for b in blocks], float) / np.maximum(count, 1), np.log1p(size) / 5,
        ], axis=1) if n else np.zeros((0, NUMBERS))

    def __len__(self) -> int:
        return len(self.numbers)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM over the blocks of a page."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        size = PATH_DIM + WORD_DIM + NUMBERS
        self.p = {"path": rng.normal(0, 0.3, (PATH_BINS, PATH_DIM)), "word": rng.normal(0, 0.1, (WORD_BINS, WORD_DIM)), "out": rng.normal(0, 0.2, 2 * HIDDEN + size), "bias": np.zeros(1)}
        for d in "fb":
            self.p |= {f"x{d}": rng.normal(0, size**-0.5, (size, 4 * HIDDEN)), f"h{d}": rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)), f"c{d}": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])}

    def vectors(self, b: Batch) -> np.ndarray:
        out = np.zeros((len(b), PATH_DIM + WORD_DIM + NUMBERS))
        for j in range(PATH_DIM):
            out[:, j] = np.bincount(b.path_of, weights=self.p["path"][b.path, j], minlength=len(b))
        for j in range(WORD_DIM):
            out[:, PATH_DIM + j] = np.bincount(b.word_of, weights=self.p["word"][b.word, j] * b.word_share, minlength=len(b))
        out[:, PATH_DIM + WORD_DIM :] = b.numbers
        return out

    @staticmethod
    def _grid(lengths: np.ndarray, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """[step, page] -> block, and which are real."""
        steps = int(lengths.max())
        at = np.arange(steps)[:, None]
        real = at < lengths[None, :]
        first = np.cumsum(lengths) - lengths
        place = (lengths[None, :] - 1 - at) if reverse else at
        return np.where(real, first[None, :] + place, 0), real

    def _run(self, x: np.ndarray, lengths: np.ndarray, d: str, keep: bool):
        grid, real = self._grid(lengths, d == "b")
        steps, pages = grid.shape
        zx = x @ self.p[f"x{d}"] + self.p[f"c{d}"]
        h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
        out = np.zeros((len(x), HIDDEN))
        tape = []
        for t in range(steps):
            z = zx[grid[t]] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            c2 = f * c + i * g
            th = np.tanh(c2)
            if keep:
                tape.append((i, f, o, g, c, th, h))
            h, c = o * th, c2
            r = real[t]
            out[grid[t][r]] = h[r]
        return out, (grid, real, tape)

    def probabilities(self, b: Batch) -> np.ndarray:
        """Probability of content of every block."""
        if not len(b):
            return np.zeros(0)
        x, lengths = self.vectors(b), b.lengths[b.lengths > 0]
        out = np.zeros(len(b))
        # pages of like length together, so that few steps are padding
        first = np.cumsum(lengths) - lengths
        order = np.argsort(lengths, kind="stable")
        for at in range(0, len(order), 32):
            some = order[at : at + 32]
            rows = np.concatenate([np.arange(first[i], first[i] + lengths[i]) for i in some])
            hf, _ = self._run(x[rows], lengths[some], "f", False)
            hb, _ = self._run(x[rows], lengths[some], "b", False)
            out[rows] = _sigmoid(np.hstack([hf, hb, x[rows]]) @ self.p["out"] + self.p["bias"])
        return out

    def gradients(self, b: Batch, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss and its gradients (back-propagation through time)."""
        x, lengths = self.vectors(b), b.lengths[b.lengths > 0]
        runs = {d: self._run(x, lengths, d, True) for d in "fb"}
        wide = np.hstack([runs["f"][0], runs["b"][0], x])
        p = _sigmoid(wide @ self.p["out"] + self.p["bias"])
        err = (p - y) / len(y)
        grads = {"out": wide.T @ err, "bias": np.array([err.sum()])}
        dwide = err[:, None] * self.p["out"][None, :]
        dx = dwide[:, 2 * HIDDEN :].copy()
        for n, d in enumerate("fb"):
            grid, real, tape = runs[d][1]
            dout = dwide[:, n * HIDDEN : (n + 1) * HIDDEN]
            dz_all = np.zeros((len(x), 4 * HIDDEN))
            dwh = np.zeros_like(self.p[f"h{d}"])
            dh, dc = np.zeros((grid.shape[1], HIDDEN)), np.zeros((grid.shape[1], HIDDEN))
            for t in range(len(tape) - 1, -1, -1):
                i, f, o, g, c, th, h = tape[t]
                r = real[t][:, None]
                dh = np.where(r, dh + dout[grid[t]], 0)
                dc = np.where(r, dc, 0) + dh * o * (1 - th * th)
                dz = np.hstack([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)])
                dwh += h.T @ dz
                dz_all[grid[t][real[t]]] = dz[real[t]]
                dh, dc = dz @ self.p[f"h{d}"].T, dc * f
            grads[f"x{d}"], grads[f"h{d}"], grads[f"c{d}"] = x.T @ dz_all, dwh, dz_all.sum(axis=0)
            dx += dz_all @ self.p[f"x{d}"].T
        path, word = np.zeros_like(self.p["path"]), np.zeros_like(self.p["word"])
        np.add.at(path, b.path, dx[b.path_of, :PATH_DIM])
        np.add.at(word, b.word, dx[b.word_of, PATH_DIM : PATH_DIM + WORD_DIM] * b.word_share[:, None])
        grads["path"], grads["word"] = path, word
        return float(-np.mean(np.log(np.maximum(np.where(y > 0.5, p, 1 - p), 1e-12)))), grads

    def fit(self, pages: list[list[Block]], labels: list[list[float]], rounds: int = 8, size: int = 24, rate: float = 0.02, seed: int = 0) -> None:
        """Adam over shuffled groups of pages."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        t = 0
        for _ in range(rounds):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), size):
                some = order[at : at + size]
                y = np.array([z for i in some for z in labels[i]])
                if not len(y):
                    continue
                t += 1
                _, grads = self.gradients(Batch([pages[i] for i in some]), y)
                for k, g in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)


def train(pages: DataFrame, html_col: str = "html", sample: int = 120, made: int = 480, most_chars: int = 1 << 16) -> BlockLabeller:
    """A labeller from ``sample`` pages of the table and ``made`` made ones."""
    rows = pages.select(F.col(html_col).alias("h")).where(F.length("h").between(1, most_chars))
    real = sorted(r[0] for r in lowest_hashed(rows, "h", sample).distinct().collect())
    blocks = [blocks_of(h) for h in real]
    labels = [[weak_label(b.path) for b in p] for p in blocks]
    kept = [(p, y) for p, y in zip(blocks, labels) if p and 0.5 not in y and len(p) <= 200]
    maker = _Maker(1)
    kept += [maker.page() for _ in range(made)]
    kept = [(p, y) for p, y in kept if p]
    model = BlockLabeller()
    model.fit([p for p, _ in kept], [y for _, y in kept])
    return model


def _extractor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: BlockLabeller = shared.value
        for batch in by_bytes(batches, 2, BATCH_BYTES):
            pages = [blocks_of(h or "") for h in batch.column(2).to_pylist()]
            p = model.probabilities(Batch(pages))
            texts, at = [], 0
            for page in pages:
                texts.append(" ".join(b.text for b, q in zip(page, p[at : at + len(page)]) if q >= 0.5))
                at += len(page)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    return run


def extract(pages: DataFrame, model: BlockLabeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row; no shuffle."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("h"))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_extractor(shared), "page_id long, url string, text string, n_chars long")
