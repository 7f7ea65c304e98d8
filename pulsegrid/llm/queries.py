"""The registered queries of this subpackage: each operator over its whole
table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.alignment import align
from pulsegrid.llm.ann import nearest
from pulsegrid.llm.common import table
from pulsegrid.llm.decontaminate import find_leaks
from pulsegrid.llm.embedding_dedup import near_vectors
from pulsegrid.llm.html_extract import extract
from pulsegrid.llm.html_extract import train as train_labeller
from pulsegrid.llm.language_id import identify, train
from pulsegrid.llm.minhash import near_duplicates
from pulsegrid.llm.packing import pack
from pulsegrid.llm.phrases import collocations
from pulsegrid.llm.quality import classify, fit
from pulsegrid.llm.token_counts import count_tokens
from pulsegrid.llm.token_store import store_round_trip
from pulsegrid.llm.tokens import tokenizer_path
from pulsegrid.llm.url_filter import filter_urls

#: Rules of the URL query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train_labeller(pages))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = identify(docs.select("doc_id", "text"), train(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=3, at_least=(85, 100))
    return found.withColumnRenamed("id", "doc_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "leaked_items", (F.size("leaked_items") > 0).alias("contaminated"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels"))).drop("text")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), top=2000, max_words=5, min_count=100)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_url_filter": op2_url_filter,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_minhash": op5_minhash,
    "op6_decontamination": op6_decontamination,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_token_store": op9_token_store,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_alignment": op12_alignment,
    "op13_ann": op13_ann,
}

#: Set links by a self-join on shingles, components by recursion.
OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d JOIN comp c ON c.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

#: All pairs of a label, components by recursion.
OP7_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x), degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN comp c ON c.x = e.vec_id LEFT JOIN degree d ON d.x = e.vec_id
"""

#: All phrases of every piece, counted whole.
OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase FROM places, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)
), counts AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100),
cuts AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a, unnest(range(1, m)) AS k FROM counts WHERE m >= 2),
cut_scores AS (
  SELECT c.lang, c.phrase, c.m, c.a, c.k, p.f AS l, q.f AS r, s.n, (1000::HUGEINT * c.a * s.n) // (p.f::HUGEINT * q.f) AS score
  FROM cuts c JOIN sizes s ON s.lang = c.lang
  JOIN counts p ON p.lang = c.lang AND p.m = c.k AND p.phrase = array_to_string(list_slice(c.w, 1, c.k), ' ')
  JOIN counts q ON q.lang = c.lang AND q.m = c.m - c.k AND q.phrase = array_to_string(list_slice(c.w, c.k + 1, c.m), ' ')
), best AS (SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, array_to_string(list_slice(string_split(phrase, ' '), s, s + d - 1), ' ') AS phrase, f
  FROM counts, (SELECT unnest(range(2, 5)) AS d), (SELECT unnest(range(1, 5)) AS s) WHERE d < m AND s + d - 1 <= m
), inside AS (SELECT lang, phrase, max(f) AS longer FROM parts GROUP BY lang, phrase),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank, b.phrase, b.a, b.l, b.r, b.n, b.score::BIGINT AS score
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {"op5_minhash": OP5_SQL, "op7_embedding_dedup": OP7_SQL, "op11_collocations": OP11_SQL}
