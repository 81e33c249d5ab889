"""Array queries over the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpitide.functions.arrays import add_short, zip_short
from kpitide.operators.vectors import vector_sum
from kpitide.plans.registry import Query
from kpitide.sources import tables


def _whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in millionths, as whole numbers, so that sums do not depend on the order."""
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000000).cast("bigint"))
    return tables.table(spark, sf_dir, "embeddings").select("vec_id", "label", whole.alias("v"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector, and its own front part backwards: all but the last 0 to 15 slots."""
    kept = F.greatest(F.size("v") - F.pmod("vec_id", F.lit(16)).cast("int"), F.lit(0))
    front = F.slice("v", F.lit(1), kept)
    return _whole_numbers(spark, sf_dir).select("vec_id", F.col("v").alias("a"), F.reverse(front).alias("b"))


def array_zip_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir).select("vec_id", F.posexplode(zip_short(F.col("a"), F.col("b"))).alias("pos", "pair"))
    return pairs.select("vec_id", "pos", F.col("pair.left").alias("left"), F.col("pair.right").alias("right"))


def array_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(
        "vec_id", F.array_join(add_short(F.col("a"), F.col("b")).cast("array<string>"), ",").alias("sums")
    )


def vector_sum_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = vector_sum(_whole_numbers(spark, sf_dir), "label", "v")
    return sums.select("label", F.posexplode("sums").alias("pos", "total"))


_WHOLE = """whole AS (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)) AS v
  FROM embeddings
)"""
_PAIRS = f"""{_WHOLE},
pairs AS (
  SELECT vec_id, v AS a, list_reverse(v[1 : greatest(len(v) - vec_id % 16, 0)]) AS b FROM whole
),
zipped AS (
  SELECT vec_id, i - 1 AS pos, a[i] AS "left", b[i] AS "right"
  FROM (SELECT vec_id, a, b, unnest(range(1, least(len(a), len(b)) + 1)) AS i FROM pairs) AS numbered
)"""

QUERIES = {
    "array_zip_truncate": Query(
        array_zip_truncate, f'WITH {_PAIRS} SELECT vec_id, CAST(pos AS INTEGER) AS pos, "left", "right" FROM zipped'
    ),
    "array_add": Query(
        array_add,
        f"""WITH {_PAIRS}
            SELECT p.vec_id, coalesce(string_agg(CAST("left" + "right" AS VARCHAR), ',' ORDER BY pos), '') AS sums
            FROM pairs p LEFT JOIN zipped z ON z.vec_id = p.vec_id GROUP BY p.vec_id""",
    ),
    "vector_sum": Query(
        vector_sum_by_label,
        f"""WITH {_WHOLE}
            SELECT label, CAST(i - 1 AS INTEGER) AS pos, CAST(sum(v[i]) AS BIGINT) AS total
            FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM whole) AS slots GROUP BY label, i""",
    ),
}
