"""The most frequent words of a stream from summaries that merge: per micro-batch one sketch of frequent items, and exact partial counts.

No word is kept as state. The sketches of all micro-batches, merged, name the words that may be the most frequent; only these are counted exactly, from the
partial sums. A sketch's estimate is never below the true count, so words it does not name have at most the smallest estimate it gave, or its error.
If the k-th exact count is above that, the answer is proven; else more words are named, and at last all are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kpitide.operators import words
from kpitide.streaming import jobs
from kpitide.streaming.partials import PartialSums
from kpitide.streaming.store import BatchStore

TRACKED = 4096  # words a sketch keeps
ERROR = 3.5  # a sketch's estimate is at most this many times the number of tokens, by the words it keeps, too high
FIRST = 4  # times k words are named at first
ALL = "all"


class Sketches(BatchStore):
    """One sketch per micro-batch, merged by compaction."""

    def __init__(self, spark: SparkSession, path: str, tracked: int = TRACKED):
        kind = spark.range(0).select(_sketch(F.lit("")).alias("s")).schema["s"].dataType
        fields = [T.StructField("key", T.StringType()), T.StructField("sketch", kind), T.StructField("tokens", T.LongType())]
        super().__init__(spark, path, T.StructType(fields), ["key"])
        self.tracked = tracked

    def _merged(self, entries: DataFrame) -> DataFrame:
        merged = F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(self.tracked)).alias("sketch")
        return entries.groupBy("key").agg(merged, F.sum("tokens").alias("tokens"), F.max("write_time").alias("write_time"))

    def add(self, tokens: DataFrame, batch_id: int) -> None:
        sketch = _sketch(F.col("word"), self.tracked).alias("sketch")
        self.put(tokens.groupBy(F.lit(ALL).alias("key")).agg(sketch, F.count(F.lit(1)).alias("tokens")), batch_id)

    def named(self, k: int) -> tuple[list[tuple[str, int]], int]:
        """At most ``k`` words that may be the most frequent, with estimates, and the number of tokens."""
        best = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(k)).alias("best")
        found = self._merged(self.entries()).select(best, "tokens").first()
        return ([(r["item"], r["count"]) for r in found["best"]], found["tokens"]) if found else ([], 0)


def _sketch(word: Column, tracked: int = TRACKED) -> Column:
    return F.call_function("approx_top_k_accumulate", word, F.lit(tracked))


def top_store(spark: SparkSession, path: str, tracked: int = TRACKED) -> tuple[Sketches, PartialSums]:
    return Sketches(spark, f"{path}/sketches", tracked).create(), jobs.word_sums(spark, f"{path}/words")


def top_sketch_stream(
    lines: DataFrame,
    store: tuple[Sketches, PartialSums],
    checkpoint: str,
    delimiter: str = " ",
    every: str | None = None,
    compact_every: int | None = 50,
) -> StreamingQuery:
    """A sketch and partial counts of the words of each micro-batch."""
    sketches, sums = store
    sums.begin(checkpoint)
    sketches.begin(checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        tokens = words.tokenize(batch, delimiter=delimiter).where(F.col("word").isNotNull())
        sketches.add(tokens, batch_id)
        sums.put(words.word_counts(tokens), batch_id)
        for part in store:
            part.after_batch(batch_id, compact_every)

    return jobs.start(lines.writeStream.foreachBatch(put), checkpoint, every)


def top_words(store: tuple[Sketches, PartialSums], k: int = 10) -> DataFrame:
    """The ``k`` most frequent words so far with exact counts; of equal counts the first in order."""
    sketches, sums = store
    wanted = min(FIRST * k, sketches.tracked)
    while True:
        named, tokens = sketches.named(wanted)
        error = int(tokens * ERROR / sketches.tracked)
        others = max(error, named[-1][1]) if len(named) == wanted else error
        exact = words.top_words(sums.of_keys("word", [w for w, _ in named]), k)
        counts = [r["n"] for r in exact.collect()]
        if len(counts) == k and counts[-1] > others:
            return exact
        if len(named) < wanted or wanted == sketches.tracked:
            return words.top_words(sums.totals(), k)  # too even: the sketch cannot tell
        wanted = min(4 * wanted, sketches.tracked)
