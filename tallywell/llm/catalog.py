"""The numbered operators as queries over the test tables."""

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywell.llm import bpe, collocations, html_text, katz, packing, periodic_runs, pii, quality, simhash, superminhash, topk, toxicity, training_order

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def make_importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies beside the entry file and isn't installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def _query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        make_importable(spark)
        return make(spark, sf_dir)

    QUERIES[make.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_bpe_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(_table(spark, sf_dir, "documents")))


@_query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_query
def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op7_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


@_query
def op6_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_personal_data(_table(spark, sf_dir, "documents")))


@_query
def op5_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(_table(spark, sf_dir, "documents"))


@_query
def op1_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_embeddings(_table(spark, sf_dir, "embeddings"))


ORACLES["op1_kd_tree_top_k"] = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS p
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.p, c.p) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


@_query
def op9_html_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


@_query
def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.digests(training_order.materialise(_table(spark, sf_dir, "documents"), "order-1"))


@_query
def op13_suffix_tree_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), planted=True))


@_query
def op12_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op11_de_bruijn_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLES["op11_de_bruijn_collocations"] = """
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), sized AS (
  SELECT lang, w, i, unnest(range(1, 5)) AS size FROM places
), grams AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS a
  FROM sized WHERE i + size - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 30
), inner_phrases AS (
  SELECT lang, phrase AS longer, a AS longer_a, string_split(phrase, ' ') AS w, size, unnest(range(1, size + 1)) AS i
  FROM grams WHERE size > 2
), within AS (
  SELECT lang, longer_a, array_to_string(w[i : i + part - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(2, size)) AS part FROM inner_phrases) WHERE i + part - 1 <= size
), covers AS (
  SELECT lang, phrase, max(longer_a) AS cover FROM within GROUP BY ALL
), left_over AS (
  SELECT g.lang, g.size, g.phrase, g.a, string_split(g.phrase, ' ') AS w
  FROM grams g LEFT JOIN covers c ON c.lang = g.lang AND c.phrase = g.phrase
  WHERE g.size > 1 AND (c.cover IS NULL OR 100 * CAST(c.cover AS HUGEINT) < 80 * CAST(g.a AS HUGEINT))
), cuts AS (
  SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM left_over
), cut_scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
         CAST(2000000 * CAST(c.a AS HUGEINT) // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
  FROM cuts c
  JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1 : c.size], ' ')
), worst AS (
  SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
