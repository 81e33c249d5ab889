"""Packing token sequences into windows, planned with non-negative least squares over the histogram of lengths.

1. Each text is tokenised and ``end_id`` added. A document's full windows stand alone; what is left over is shorter than
   a window. The tokens are written to the shared folder once.
2. The lengths left over are counted. Shallow combinations of two or three lengths that fill a window exactly are enumerated, and
   non-negative least squares gives how often to use each so that together they use up the histogram. The numbers are rounded down.
3. A leftover's number within its length (counted over all documents without sorting them) says which combination it goes to. What the
   combinations do not use is laid end to end and cut at window borders, so only the last window of all is not full.

The driver holds the histogram, at most one count per length up to the window, and a number per combination. Nothing else
comes to it. A document's ids lie in its pieces in order and exactly once.

Null texts are packed as empty ones: their only token is ``end_id``. Other columns are not touched. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpitide.llm.bpe import word_codec
from kpitide.llm.common import released, written

WINDOW = 2048
END_ID = 1
FREQUENT = 64  # lengths from which combinations of three are made
SWEEPS = 60
ROWS_AT_ONCE = 1000


def tokenize(docs: DataFrame, vocabulary: str, window: int = WINDOW, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``key, n_tokens, ids`` (four bytes each), ``part`` and ``n_full`` and ``n_rest``.

    ``part`` is the task; ``n_full`` counts the full windows, ``n_rest`` the leftovers of the same length, before this row in the task.
    """
    names = ["key", "n_tokens", "ids", "part", "n_full", "n_rest"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    end = np.array([end_id], "<u4").tobytes()

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(vocabulary)
        part = TaskContext.get().partitionId()
        full, rest = 0, [0] * window
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                some = b.slice(lo, ROWS_AT_ONCE)
                ids = [x + end for x in codec.encode_all(some.column(1).to_pylist())]
                before, same = [], []
                for x in ids:
                    windows, left = divmod(len(x) // 4, window)
                    before.append(full)
                    same.append(rest[left])
                    full += windows
                    rest[left] += 1
                columns = [some.column(0).cast(types[0]), [len(x) // 4 for x in ids], ids, [part] * len(ids), before, same]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=names)

    schema = "key bigint, n_tokens bigint, ids binary, part bigint, n_full bigint, n_rest bigint"
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


def combinations(counts: np.ndarray, frequent: int = FREQUENT) -> list[tuple[int, ...]]:
    """Two or three lengths that fill the window. ``counts[i]``: how many leftovers have length i; the window is ``len(counts)``."""
    window = len(counts)
    out = [(a, window - a) for a in range(1, window // 2 + 1) if counts[a] and counts[window - a]]
    often = [int(i) for i in np.argsort(-counts, kind="stable")[:frequent] if counts[i]]
    triples = set()
    for n, a in enumerate(often):
        for b in often[n:]:
            c = window - a - b
            if c > 0 and counts[c]:
                triples.add(tuple(sorted((a, b, c))))
    return out + sorted(triples)


def solve(counts: np.ndarray, shapes: list[tuple[int, ...]], sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative numbers x that bring the sum of x times each combination's lengths closest to ``counts`` (coordinate descent)."""
    left = counts.astype(float)
    x = np.zeros(len(shapes))
    columns = []
    for shape in shapes:
        lengths, times = np.unique(shape, return_counts=True)
        columns.append((lengths.tolist(), times.tolist(), float((times**2).sum())))
    for _ in range(sweeps):
        moved = 0.0
        for j, (lengths, times, norm) in enumerate(columns):
            step = sum(t * left[i] for i, t in zip(lengths, times, strict=True)) / norm
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for i, t in zip(lengths, times, strict=True):
                    left[i] -= step * t
        if moved < 0.25:
            break
    return x


def rounded(counts: np.ndarray, shapes: list[tuple[int, ...]], x: np.ndarray) -> np.ndarray:
    """Whole numbers near x that use no length more often than it occurs: rounded down, then raised where lengths are left."""
    times = np.floor(x + 1e-9).astype(np.int64)
    left = counts.astype(np.int64).copy()
    for j in np.argsort(-times, kind="stable"):
        lengths, each = np.unique(shapes[j], return_counts=True)
        times[j] = min(times[j], int((left[lengths] // each).min()))
        left[lengths] -= times[j] * each
    for j in np.argsort(-x, kind="stable"):
        lengths, each = np.unique(shapes[j], return_counts=True)
        more = int((left[lengths] // each).min())
        times[j] += more
        left[lengths] -= more * each
    return times


class Plan:
    """Where the leftover number r of length l goes."""

    def __init__(self, counts: np.ndarray):
        window = len(counts)
        shapes = combinations(counts)
        times = rounded(counts, shapes, solve(counts, shapes)) if shapes else np.zeros(0, np.int64)
        self.window = window
        # For each length: first numbers of ranges, and for each range the first window, the windows and the offset there.
        ranges: list[list[tuple[int, int, int]]] = [[] for _ in range(window)]
        used = np.zeros(window, np.int64)
        windows = 0
        for shape, n in zip(shapes, times, strict=True):
            if n == 0:
                continue
            offset = 0
            for length in shape:
                ranges[length].append((int(used[length]), windows, offset))
                used[length] += n
                offset += length
            windows += int(n)
        self.used = used
        self.first = [np.array([r[0] for r in x], np.int64) for x in ranges]
        self.window_of = [np.array([r[1] for r in x], np.int64) for x in ranges]
        self.offset_of = [np.array([r[2] for r in x], np.int64) for x in ranges]
        lengths = np.arange(window)
        unused = (counts - used) * lengths
        self.stream = np.cumsum(unused) - unused
        self.windows = windows

    def place(self, length: int, number: int) -> list[tuple[int, int, int]]:
        """(window, offset, length) of each part of a leftover; two if it is cut."""
        if number < self.used[length]:
            at = int(np.searchsorted(self.first[length], number, side="right")) - 1
            return [(int(self.window_of[length][at] + number - self.first[length][at]), int(self.offset_of[length][at]), length)]
        at = int(self.stream[length]) + (number - int(self.used[length])) * length
        row, offset = divmod(at, self.window)
        fits = min(length, self.window - offset)
        parts = [(self.windows + row, offset, fits)]
        if fits < length:
            parts.append((self.windows + row + 1, 0, length - fits))
        return parts


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``key, start, length, ids`` (four bytes each), ``doc_tokens, sequence_id, offset``."""
    tokens = written(tokenize(docs, vocabulary, window, key, text, end_id), "packing-tokens")
    rest = (F.col("n_tokens") % window).alias("rest")
    per_part = tokens.groupBy("part", rest).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("n_tokens") / window)).alias("windows")
    )
    per_part = written(per_part, "packing-counts")
    counts = np.zeros(window, np.int64)
    for row in per_part.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # a row per length below the window
        if row["rest"]:
            counts[row["rest"]] = row["n"]
    plan = Plan(counts)
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    placed = tokens.withColumn("rest", rest).join(offsets, ["part", "rest"])

    names = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                rows: list[tuple] = []
                for doc, n, ids, part, n_full, number in zip(*(c.to_pylist() for c in b.slice(lo, ROWS_AT_ONCE).columns), strict=True):
                    full, left = divmod(n, window)
                    pieces = [((part << 32 | n_full + i) * 2 + 1, 0, window) for i in range(full)]
                    if left:
                        pieces += [(2 * w, offset, size) for w, offset, size in plan.place(left, number)]
                    start = 0
                    for sequence, offset, size in pieces:
                        rows.append((doc, start, size, ids[4 * start : 4 * (start + size)], n, sequence, offset))
                        start += size
                columns = zip(*rows, strict=True) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], names=names)

    schema = "key bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    columns = [key, "n_tokens", "ids", "part", "n_full", (F.col("earlier") + F.col("n_rest")).alias("number")]
    return placed.select(*columns).mapInArrow(run, schema).withColumnRenamed("key", key)
