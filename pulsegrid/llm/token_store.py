"""Token-id store: one concatenated id array in ascending document order, with
Elias-Fano coded document bounds.

The store is a Parquet table (so any file system Spark writes to holds it and
lost tasks are simply run again) whose rows are blocks of whole documents:

  part, seq      place of the block: ascending (part, seq) is ascending doc_id
  n_docs, n_ids  documents and ids in the block
  wide           ids are 4 bytes (else 2), little-endian
  ids            the ids
  first_doc, n_null, doc_ids   Elias-Fano code of doc_id - first_doc; documents
                 with a null id come first
  bounds         Elias-Fano code of the n_docs + 1 places where documents begin

A block ends after ``BLOCK_IDS`` ids; one longer document makes one longer
block. Null text is an empty document (the end id alone). Repeated rows are
stored each.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_bytes
from pulsegrid.llm.elias_fano import EliasFano
from pulsegrid.llm.tokens import WordBpe, loaded
from pulsegrid.session import ensure_checkpoint_dir

BLOCK_IDS = 1 << 21
BATCH_BYTES = 1 << 20

_EF = "struct<n:long,low_bits:int,lower:binary,upper:binary,samples:binary>"
SCHEMA = f"part int, seq int, n_docs long, n_ids long, wide boolean, ids binary, first_doc long, n_null long, doc_ids {_EF}, bounds {_EF}"


def _coded(values) -> dict:
    e = EliasFano.encode(np.asarray(values, np.int64))
    return {"n": e.n, "low_bits": e.low_bits, "lower": e.lower, "upper": e.upper, "samples": e.samples}


def _decoded(x: dict) -> EliasFano:
    return EliasFano(x["n"], x["low_bits"], x["lower"], x["upper"], x["samples"])


def _block(part: int, seq: int, names: list, ids: list[np.ndarray]) -> dict:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    wide = bool(len(flat) and flat.max() > 0xFFFF)
    known = np.array([n for n in names if n is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    return {
        "part": part, "seq": seq, "n_docs": len(names), "n_ids": len(flat), "wide": wide,
        "ids": flat.astype("<u4" if wide else "<u2").tobytes(), "first_doc": first, "n_null": len(names) - len(known),
        "doc_ids": _coded(known - first), "bounds": _coded(np.concatenate([[0], np.cumsum([len(i) for i in ids])])),
    }


def _writer(path: str, end_id: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk, part = loaded(WordBpe, path), TaskContext.get().partitionId()
        tail = np.array([end_id], np.uint32)
        names, ids, size, seq = [], [], 0, 0
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            found = tk.ids([t or "" for t in batch.column(1).to_pylist()])
            for name, x in zip(batch.column(0).to_pylist(), found):
                names.append(name)
                ids.append(np.concatenate([x, tail]))
                size += len(x) + 1
                if size >= BLOCK_IDS:
                    yield pa.RecordBatch.from_pylist([_block(part, seq, names, ids)], schema=schema)
                    names, ids, size, seq = [], [], 0, seq + 1
        if names:
            yield pa.RecordBatch.from_pylist([_block(part, seq, names, ids)], schema=schema)

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write the store to ``path``; one range shuffle of the
    texts on the id gives the global order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    # ties on the id stay together and in any order: they are told apart by nothing but their text
    ordered = rows.repartitionByRange(parts, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "t")
    arrow = to_arrow_schema(spark.createDataFrame([], SCHEMA).schema)
    ordered.mapInArrow(_writer(tokenizer, end_id, arrow), SCHEMA).write.parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a store."""
    return spark.read.schema(SCHEMA).parquet(path)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n_docs"]
            bounds = _decoded(row["bounds"]).select(np.arange(n + 1))
            names = _decoded(row["doc_ids"]).select(np.arange(n - row["n_null"])) + row["first_doc"]
            ids = np.frombuffer(row["ids"], "<u4" if row["wide"] else "<u2")
            crcs = np.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:])], np.int64)
            known = pa.concat_arrays([pa.nulls(row["n_null"], pa.int64()), pa.array(names, pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["seq"], np.int32)), known, pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crcs)],
                names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, decoded
    from the blocks; start counts the ids of all documents before it."""
    heads = blocks.select("part", "seq", "n_ids")
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("m"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part: as many as shuffle partitions
    parts = parts.select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = heads.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_base")).join(parts, "part")
    found = blocks.mapInArrow(_reader, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(bases, ["part", "seq"]).select("doc_id", (F.col("part_base") + F.col("block_base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def store_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a new store in the shared folder and read it back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-store-{uuid.uuid4().hex}"
    write_store(docs, path, tokenizer)
    return read_documents(open_store(spark, path))
