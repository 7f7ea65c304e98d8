"""Token counts: batches of Arrow rows balanced by bytes, lengths only.

Null text counts as empty (0 bytes, 0 tokens). A null id is passed through;
repeated rows are counted each. Long texts are cut at safe boundaries (see
``tokens``) and summed, so no text is truncated and a batch holds about
``batch_bytes`` bytes, or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes, string_views
from pulsegrid.llm.tokens import ByteBpeCounter, loaded

#: A text longer than this is counted in pieces cut at a space between letters.
PIECE_CHARS = 1 << 20


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters whose token counts add
    up: each later piece starts with a single space between two characters that
    are not white space. A stretch without such a place stays whole."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                yield text[at:]
                return
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _counter(path: str, limit: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(ByteBpeCounter, path)
        for batch in by_bytes(batches, 1, batch_bytes):
            raw, bounds = string_views(batch.column(1))
            n_bytes = np.diff(bounds)
            if len(raw) <= PIECE_CHARS:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                counts = counter.counts(texts)
            else:
                counts = [sum(counter.counts([p])[0] for p in safe_pieces(t or "")) for t in batch.column(1).to_pylist()]
            counts = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n_bytes), pa.array(counts), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, batch_bytes: int = PIECE_CHARS
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row; over_limit: more than
    ``limit`` tokens. One scan, no shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(_counter(path, limit, batch_bytes), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
