"""Word-count queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.operators import words as W
from kpitide.operators.parse import drop_empty
from kpitide.plans.fixture_sql import LINES, tokens
from kpitide.plans.registry import Query
from kpitide.schemas import SEED_WORDS, seed_words
from kpitide.sources import tables

LINE_KEYS = ["conv_id", "turn", "line"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.word_lines(tables.table(spark, sf_dir, "conversations"))


def spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.tokenize(lines(spark, sf_dir), *LINE_KEYS)


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts to start from: the fixed seed words, and the words of an earlier text collection."""
    texts = W.text_lines(tables.table(spark, sf_dir, "benchmark"), "text")
    earlier = W.word_counts(W.tokenize(texts)).withColumnRenamed("n", "n0")
    return earlier.unionByName(seed_words(spark)).groupBy("word").agg(F.sum("n0").alias("n0"))


def drop_empty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_empty(lines(spark, sf_dir))


def tokenize_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.tokenize(lines(spark, sf_dir), *LINE_KEYS, delimiter=",")


def word_count_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_counts(spaced(spark, sf_dir))


def seeded_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.seeded(W.word_counts(spaced(spark, sf_dir)), seed(spark, sf_dir))


def running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.running_count(spaced(spark, sf_dir), "word", [*LINE_KEYS, "pos"])


def top10_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top_words(W.word_counts(spaced(spark, sf_dir)))


RUNNING_SQL = f"""WITH {tokens()}
    SELECT conv_id, turn, line, pos, word,
           count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, line, pos
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
    FROM tokens"""
_SEEDS = ", ".join(f"('{w}', {n})" for w, n in SEED_WORDS)
SEED_SQL = f"""
seed_lines AS (
  SELECT unnest(string_split(text, chr(10))) AS value FROM benchmark
),
seed_tokens AS (
  SELECT unnest(CASE WHEN value = '' THEN [''] WHEN rtrim(value, ' ') = '' THEN []
                     ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM seed_lines
),
seed AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n0
  FROM (SELECT word, 1 AS n FROM seed_tokens UNION ALL SELECT * FROM (VALUES {_SEEDS}) AS t(word, n)) AS joined
  GROUP BY word
)"""

QUERIES = {
    "drop_empty": Query(drop_empty_lines, f"WITH {LINES} SELECT * FROM lines WHERE length(value) > 0"),
    "tokenize": Query(spaced, f"WITH {tokens()} SELECT * FROM tokens"),
    "tokenize_commas": Query(tokenize_commas, f"WITH {tokens(',')} SELECT * FROM tokens"),
    "word_count": Query(word_count_per_run, f"WITH {tokens()} SELECT word, count(*) AS n FROM tokens GROUP BY word"),
    "seeded_word_count": Query(
        seeded_word_count,
        f"""WITH {tokens()}, {SEED_SQL}
            SELECT c.word, c.n + coalesce(n0, 0) AS n
            FROM (SELECT word, count(*) AS n FROM tokens GROUP BY word) c LEFT JOIN seed ON seed.word = c.word""",
    ),
    "running_word_count": Query(running_word_count, RUNNING_SQL),
    "top10_words": Query(
        top10_words,
        f"WITH {tokens()} SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word LIMIT 10",
    ),
}
