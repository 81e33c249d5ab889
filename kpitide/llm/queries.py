"""The registered queries of this package, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.llm import (
    bpe,
    hard_negatives,
    html_text,
    languages,
    lexical,
    licences,
    near_duplicates,
    near_vectors,
    neighbours,
    packing,
    passages,
    sharding,
    toxicity,
)
from kpitide.llm.common import table


def fold(folds: int) -> Column:
    """Fold of a document: the remainder of the checksum of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = languages.learn(docs.where(fold(4) != 2))
    held_out = (fold(4) == 2).alias("held_out")
    return languages.predict(docs, prototypes).select("doc_id", held_out, "lang_pred", "score")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.group(table(spark, sf_dir, "documents"), near_duplicates.Rule(words=4, num=85, den=100))
    return found.toDF("doc_id", "n_shingles", "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(3) != 1))
    predicted = F.when(F.col("score") >= toxicity.PREDICT_FROM, 1).otherwise(0).alias("predicted")
    return toxicity.score(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", predicted)


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors.links(table(spark, sf_dir, "embeddings"), least=0.93)
    kept = (F.col("id") == F.col("component")).alias("kept")
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept)


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.remove(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_sentences", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
    return found.withColumnRenamed("id", "doc_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        table(spark, sf_dir, "embeddings"),
        is_anchor=F.col("id") % 50 == 0,
        positives=5,
        negatives=3,
        window=(50, 95),
        label=label,
        scaled=lambda x: F.floor(256 * x),
    )


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=40)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", law, "shard", "slot", grown)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_html": op2_html,
    "op3_bpe": op3_bpe,
    "op4_jaccard": op4_jaccard,
    "op5_toxicity": op5_toxicity,
    "op6_neighbours": op6_neighbours,
    "op7_near_vectors": op7_near_vectors,
    "op8_passages": op8_passages,
    "op9_licences": op9_licences,
    "op10_packing": op10_packing,
    "op11_ranked": op11_ranked,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_shards": op13_shards,
}

# Terms of a text, A-Z lower-cased; the pattern is fixed by the query's definition.
TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
RANKED_SQL = f"""
WITH
docs AS (SELECT doc_id, row_number() OVER () AS doc, {TERMS} AS terms FROM documents WHERE doc_id IS NOT NULL),
sized AS (SELECT doc_id, doc, len(terms) AS n, terms FROM docs WHERE len(terms) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
tf AS (
  SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM sized) AS t GROUP BY ALL
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
worth AS (
  SELECT doc, doc_id, term,
         CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))) AS worth
  FROM tf JOIN df USING (term) CROSS JOIN whole
),
scored AS (
  SELECT item_id, doc, doc_id, CAST(sum(worth) AS BIGINT) AS score FROM items JOIN worth USING (term) GROUP BY item_id, doc, doc_id
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

NEGATIVES_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
  FROM rows AS a JOIN rows AS r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives AS p JOIN scores AS s USING (anchor_id)
  WHERE NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""

SQL: dict[str, str] = {"op11_ranked": RANKED_SQL, "op12_hard_negatives": NEGATIVES_SQL}
