"""Corpus pipeline: documents -> packed training sequences.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last
return the columns of ``documents``. Every stage works on all rows that its
predecessor kept; extra columns pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import table
from pulsegrid.llm.decontaminate import find_leaks
from pulsegrid.llm.language_id import identify, train
from pulsegrid.llm.minhash import near_duplicates
from pulsegrid.llm.packing import pack
from pulsegrid.llm.quality import classify, fit
from pulsegrid.llm.tokens import tokenizer_path
from pulsegrid.session import ensure_checkpoint_dir

#: A text whose best language scores less (0.25 is a coin toss among four) is rejected.
LEAST_LANGUAGE_SCORE = 0.3


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until ``docs`` has no such column."""
    while name in docs.columns:
        name += "_"
    return name


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay: those with a letter whose language
    is told with a score of at least ``LEAST_LANGUAGE_SCORE``. Null and
    letterless texts go."""
    lang, score = fresh(docs, "_lang"), fresh(docs, "_lang_score")
    found = identify(docs, train(docs, F.lit(True)), lang_name=lang, score_name=score)
    return found.where((F.col(lang) != "und") & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality that are not abusive stay."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    names = tuple(fresh(docs, n) for n in ("_quality", "_toxic", "_kept"))
    return classify(docs, model, names=names).where(F.col(names[2])).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles,
    Jaccard 0.8 or more): the one with the smallest id. Rows that repeat an id
    leave one row; documents without an id stay."""
    found = near_duplicates(docs, k=5, at_least=(80, 100))
    gone = found.where("NOT kept").select(F.col("id").alias("doc_id")).distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    return left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id IS NULL"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    leaks = fresh(docs, "_leaks")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), name=leaks)
    return found.where(F.size(leaks) == 0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the surviving documents in sequences of 4096 tokens."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("language ID", language_stage),
    ("quality classifier", quality_stage),
    ("minhash near-dedup", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Learned stages have no SQL form; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each is written as
    Parquet to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{i}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{i}")
    return docs
