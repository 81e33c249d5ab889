"""Ranked lexical search for many queries at once, with the sums that queries share worked out once.

Each item (a query) is a set of terms, and a document's score for it is the sum of what its terms are worth in the document. So sets of
terms that several items have in common need one sum per document:

- Terms that the same items have are one set from the start.
- Within an item the sets are ordered by the number of items that have them. Neighbours in that order which several items have in common
  become a set of their own, again and again, until no two neighbours recur: a directed graph of sets that queries share.
- Per block of documents the sum of each set is made once, from the two sets it consists of, and items add up the sets that are left to them.

All sums are of integers, so any order of adding gives the same score. Documents are read once: the occurrences of item terms in each document are written to
the shared folder, with counts by task for the weights. Then blocks of documents are scored in arrays, each task keeps the best of each
item, and the best of all tasks are chosen by item and salt first, by item last.

Items go in blocks by the hash of their id, of about ``ITEM_BYTES`` of text each, and only the terms of one block are known to a task at a
time. Rows with the same item id are one item, with the terms of all of them. Items without a term, and null ids, have no results.

Documents that are null or have no term match nothing and count for nothing. Rows with a null id are left out everywhere. Rows with the
same id are documents of their own. Ties go to the smaller id. Other columns are not touched. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpitide.llm.common import written

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # of UTF-8: letters and digits, and all beyond ASCII
ITEM_BYTES = 4_000_000
SALTS = 16
CELLS = 4_000_000  # sums held at a time by a task
HELD = 200_000  # candidates held before the worst go
ROWS_AT_ONCE = 1000


def terms(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())


@dataclass(frozen=True)
class Sharing:
    """Sets of terms: the first are given by their terms, each other one by two sets before it; items by the sets they add up."""

    of_term: np.ndarray  # set of each term
    pairs: list[tuple[int, int]]  # sets after the first ones
    first: int  # number of sets given by terms
    items: list[np.ndarray]

    @property
    def additions(self) -> int:
        return len(self.pairs) + sum(max(0, len(i) - 1) for i in self.items)


def share(items: list[list[int]], n_terms: int) -> Sharing:
    """The sets that items, lists of term numbers, have in common."""
    having = defaultdict(list)
    for n, own in enumerate(items):
        for t in own:
            having[t].append(n)
    numbers: dict[tuple[int, ...], int] = {}
    of_term = np.zeros(n_terms, np.int64)
    for t, among in having.items():
        of_term[t] = numbers.setdefault(tuple(among), len(numbers))
    frequency = {n: len(among) for among, n in numbers.items()}
    lists = [sorted({int(of_term[t]) for t in own}, key=lambda n: (-frequency[n], n)) for own in items]
    pairs: list[tuple[int, int]] = []
    while True:
        seen = Counter(pair for own in lists for pair in zip(own, own[1:]))
        common = {pair: n for pair, n in seen.items() if n > 1}
        if not common:
            return Sharing(of_term, pairs, len(numbers), [np.array(own, np.int64) for own in lists])
        # The most frequent pair at each place wins; a pair that wins only once is not worth a set, but may yet be later.
        chosen = []
        for own in lists:
            places = sorted((-common[pair], pair, i) for i, pair in enumerate(zip(own, own[1:])) if pair in common)
            taken: set[int] = set()
            for _, _, i in places:
                if i not in taken and i + 1 not in taken:
                    taken |= {i, i + 1}
                    chosen.append((own[i], own[i + 1]))
        won = Counter(chosen)
        best = max(common.items(), key=lambda p: (p[1], [-x for x in p[0]]))[0]
        worth = sorted({pair for pair, n in won.items() if n > 1} or {best})
        new = {pair: len(numbers) + len(pairs) + i for i, pair in enumerate(worth)}
        pairs += worth
        lists = [_replaced(own, new, common) for own in lists]


def _replaced(own: list[int], new: dict[tuple[int, int], int], common: dict[tuple[int, int], int]) -> list[int]:
    places = sorted((-common[pair], pair, i) for i, pair in enumerate(zip(own, own[1:])) if pair in new)
    starts: set[int] = set()
    for _, _, i in places:
        if not starts & {i - 1, i + 1}:
            starts.add(i)
    return [new[own[i], own[i + 1]] if i in starts else n for i, n in enumerate(own) if i - 1 not in starts]


def occurrences(docs: DataFrame, vocabulary: list[bytes], key: str, text: str) -> DataFrame:
    """``id, n, term, tf`` of each document with a term: its number of terms, and the numbers and counts of those in the vocabulary.

    One more row per task has no id: the terms of all its documents together, the vocabulary's numbers and how many documents have each; and
    ``docs``, the number of documents with a term.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary)}
        known = number.keys()
        names = ["id", "docs", "n", "term", "tf"]
        having, total, n_docs, id_type = np.zeros(len(vocabulary), np.int64), 0, 0, None
        lists = pa.list_(pa.int32()), pa.list_(pa.int64())
        for batch in batches:
            id_type = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(lo, ROWS_AT_ONCE)
                rows, sizes, ends, found, counts = [], [], [0], [], []
                for i, t in enumerate(some.column(1)):
                    words = terms(t.as_buffer().to_pybytes()) if t.is_valid else ()
                    if not words:
                        continue
                    count = Counter(words)
                    for word in count.keys() & known:
                        found.append(number[word])
                        counts.append(count[word])
                    rows.append(i)
                    sizes.append(len(words))
                    ends.append(len(found))
                numbers = np.array(found, np.int32)
                having += np.bincount(numbers, minlength=len(vocabulary))
                total += sum(sizes)
                n_docs += len(rows)
                offsets = pa.array(ends, pa.int32())
                columns = [
                    some.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(np.ones(len(rows), np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers), type=lists[0]),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()), type=lists[1]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if id_type is not None:
            at = np.flatnonzero(having)
            columns = [
                pa.nulls(1, id_type),
                pa.array([n_docs], pa.int64()),
                pa.array([total], pa.int64()),
                pa.array([at.astype(np.int32)], lists[0]),
                pa.array([having[at]], lists[1]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    there = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    return there.mapInArrow(run, f"id {kind}, docs bigint, n bigint, term array<int>, tf array<bigint>")


def weights(rows: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """Weight of each term, number of documents and number of all their terms."""
    sums = rows.where("id is null")
    n_docs, total = sums.agg(F.sum("docs"), F.sum("n")).first()
    n_docs, total = n_docs or 0, total or 0
    having = np.zeros(n_terms, np.int64)
    each = sums.select(F.explode(F.arrays_zip("term", "tf")).alias("t")).groupBy("t.term").agg(F.sum("t.tf").alias("df"))
    for r in each.collect():  # one row per term of the block of items
        having[r["term"]] = r["df"]
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in having], np.int64), n_docs, total


def best(rows: DataFrame, sharing: Sharing, weight: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """``item, id, score``: of each item (by number) the ``k`` best documents of each task."""
    kind = dict(rows.dtypes)["id"]

    def worst_gone(held: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("id", "ascending")]))
        item = table.column(0).to_numpy()
        start = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        place = np.arange(len(item)) - np.repeat(start, np.diff(np.append(start, len(item))))
        return table.filter(pa.array(place < k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items, n_sets = len(sharing.items), sharing.first + len(sharing.pairs)
        step = max(1, CELLS // max(1, n_sets + n_items))
        least = np.ones(n_items, np.int64)  # a score that can still be among the best
        held: list[pa.RecordBatch] = []
        n_held = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                some = batch.slice(lo, step)
                sums = np.zeros((n_sets, some.num_rows), np.int64)
                counts = np.diff(some.column(2).offsets.to_numpy())
                doc = np.repeat(np.arange(some.num_rows), counts)
                term = some.column(2).flatten().to_numpy()
                tf = some.column(3).flatten().to_numpy()
                m = 100 - 50 + (50 * some.column(1).to_numpy() * n_docs) // total
                worth = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                np.add.at(sums, (sharing.of_term[term], doc), worth)
                for n, (a, b) in enumerate(sharing.pairs, sharing.first):
                    np.add(sums[a], sums[b], out=sums[n])
                scores = np.empty((n_items, some.num_rows), np.int64)
                for n, own in enumerate(sharing.items):
                    sums[own].sum(axis=0, out=scores[n])
                item, row = np.nonzero(scores >= least[:, None])
                if not len(item):
                    continue
                columns = [pa.array(item.astype(np.int32)), some.column(0).take(pa.array(row)), pa.array(scores[item, row])]
                held.append(pa.RecordBatch.from_arrays(columns, names=["item", "id", "score"]))
                n_held += len(item)
                if n_held > max(HELD, 2 * n_items * k):
                    table = worst_gone(held)
                    number, score = table.column(0).to_numpy(), table.column(2).to_numpy()
                    full = np.bincount(number, minlength=n_items) == k
                    last = np.ones(n_items, np.int64)
                    np.minimum.at(filled := np.full(n_items, np.iinfo(np.int64).max), number, score)
                    last[full] = filled[full]
                    least, held, n_held = last, table.to_batches(), table.num_rows
        if held:
            yield from worst_gone(held).to_batches()

    there = rows.where("id is not null and size(term) > 0").select("id", "n", "term", "tf")
    return there.mapInArrow(run, f"item int, id {kind}, score bigint")


def search(
    docs: DataFrame, items: DataFrame, k: int, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, id, score``: the ``k`` best documents of each item, the best first."""
    asked = items.where(F.col(item_key).isNotNull()).select(F.col(item_key).alias("item_id"), F.col(item_text).cast("binary").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    spark, out = docs.sparkSession, None
    for block in range(blocks):
        found: dict[object, set[bytes]] = defaultdict(set)
        for r in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            found[r["item_id"]].update(terms(bytes(r["text"] or b"")))
        ids = sorted(i for i, own in found.items() if own)
        vocabulary = sorted(set().union(*(found[i] for i in ids)))
        number = {t: n for n, t in enumerate(vocabulary)}
        sharing = share([sorted(number[t] for t in found[i]) for i in ids], len(vocabulary))
        rows = written(occurrences(docs, vocabulary, key, text), "lexical-occurrences")
        weight, n_docs, total = weights(rows, len(vocabulary))
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {dict(asked.dtypes)['item_id']}")
        order = [F.desc("score"), F.asc("id")]
        scored = best(rows, sharing, weight, n_docs, total, k).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        for by in (["item", "salt"], ["item"]):
            scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
        named = scored.join(names, "item").select("item_id", "rank", "id", "score")
        out = named if out is None else out.unionByName(named)
    return out
