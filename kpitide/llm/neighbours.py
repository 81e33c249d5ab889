"""Nearest neighbours by largest inner product with shifted Hilbert curves.

Vectors are projected several times at random onto a few axes, scaled to the unit cube, shifted, and put in the order of a Hilbert curve. Each order
is range-partitioned into ``CELLS`` cells with equal numbers of vectors. A query meets all vectors of its own cell and of the ``REACH`` cells on
either side, on each curve. Its best vectors of each cell are merged and ranked again by the exact product in double precision.

Equal vectors are placed once, with the smallest id: copies of a vector, however many, take no room in the cells and no more work than one. Of
each vector the k + 1 smallest ids are enough for any result; they are joined back after the ranking. Cells end at different places of a curve,
so that none is empty, also where many different vectors have the same place.

The scale of the axes is learned from at most ``SAMPLE`` vectors; every vector is indexed. Windows are a share of the table, as its
neighbours are in data without clusters: there the share decides the recall. A task reads its cell in batches and holds only the best rows of
its queries, of which there are at most about ``QUERIES_AT_ONCE``. A query for which the cells held fewer than k rows meets all vectors.

Rows that ``vectors.usable`` leaves out are neither queries nor candidates. Ties go to the smaller id. A query with fewer other rows than k gets
all of them. Ids must be unique.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpitide.llm.common import written
from kpitide.llm.vectors import matrix, sample, usable

CURVES = 8
AXES = 8
BITS = 4
CELLS = 20
REACH = 2
SAMPLE = 10_000
QUERIES_AT_ONCE = 10_000
SEED = 77
CLOSE = 1e-9  # products this near are compared exactly


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below 2**bits (rows: points)."""
    one = np.uint64(1)
    axes = points.shape[1]
    x = [points[:, i].astype(np.uint64) for i in range(axes)]
    for level in range(bits - 1, 0, -1):  # undo the turns of the cubes, from the largest down
        bit, lower = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(axes):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, np.uint64(0), (x[0] ^ x[i]) & lower)
            x[0] = np.where(inverted, x[0] ^ lower, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, axes):  # Gray code
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(points), np.uint64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[axes - 1] >> np.uint64(level)) & one != 0, turn ^ np.uint64((1 << level) - 1), turn)
    key = np.zeros(len(points), np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << one) | (((x[i] ^ turn) >> np.uint64(level)) & one)
    return key.astype(np.int64)


class Curves:
    """Projections, scales and shifts of the curves."""

    def __init__(self, some: np.ndarray):
        rng = np.random.default_rng(SEED)
        dim = some.shape[1]
        self.axes = min(AXES, dim)
        self.bits = BITS if self.axes == AXES else min(16, 62 // self.axes)
        self.frames = [np.linalg.qr(rng.normal(size=(dim, self.axes)))[0] for _ in range(CURVES)]
        self.shifts = [rng.uniform(0, 0.5, self.axes) for _ in range(CURVES)]
        self.means = [(some @ f).mean(axis=0) for f in self.frames]
        self.spreads = [np.maximum((some @ f).std(axis=0), 1e-12) for f in self.frames]

    def keys(self, rows: np.ndarray) -> list[np.ndarray]:
        out = []
        for frame, shift, mean, spread in zip(self.frames, self.shifts, self.means, self.spreads, strict=True):
            z = np.clip(1.702 * (rows @ frame - mean) / spread, -30, 30)
            unit = 0.5 / (1 + np.exp(-z)) + shift
            out.append(hilbert_keys(np.minimum((unit * (1 << self.bits)).astype(np.int64), (1 << self.bits) - 1), self.bits))
        return out


def best_of(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, product) of the k rows nearest to each query, by place."""
    out_q, out_r, out_s = [], [], []
    rough = queries @ rows.T
    for q in range(len(queries)):
        found = rough[q]
        if len(found) > k:
            near = np.flatnonzero(found >= np.partition(found, len(found) - k)[len(found) - k] - CLOSE)
        else:
            near = np.arange(len(found))
        exact = (rows[near] * queries[q]).sum(axis=1)
        order = np.lexsort((ids[near], -exact))[:k]
        out_q.append(np.full(len(order), q))
        out_r.append(near[order])
        out_s.append(exact[order])
    return tuple(np.concatenate(x) for x in (out_q, out_r, out_s))


def search(df: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows found for each row for which ``is_query`` holds."""
    asked = df.withColumn("_asked", F.coalesce(is_query, F.lit(False)))
    points, dim = usable(asked, key, vector, "_asked")
    kind = dict(points.dtypes)["id"]
    if dim == 0:
        return df.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    # Equal vectors are one node, known by two hashes and named after its smallest id.
    of_vector = [F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(SEED), "vec").alias("h2")]
    hashed = points.select("id", "vec", "_asked", *of_vector)
    made = hashed.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("vec").alias("vec"), F.max("_asked").alias("_asked"), F.count(F.lit(1)).alias("n"))
    nodes = written(made, "neighbour-vectors")
    some = sample(nodes, SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    if isinstance(some, pa.ChunkedArray):
        some = some.combine_chunks()
    curves = Curves(matrix(some, dim))
    names = [f"k{i}" for i in range(CURVES)]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = curves.keys(matrix(b.column(1), dim))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x) for x in keys)], names=["id", "vec", "_asked", *names])

    schema = f"id {kind}, vec {dict(points.dtypes)['vec']}, _asked boolean, " + ", ".join(f"{n} bigint" for n in names)
    placed = nodes.select("id", "vec", "_asked").mapInArrow(keyed, schema)
    total = nodes.agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("rows"), F.sum(F.col("_asked").cast("long")).alias("asked")).first()
    cells_of = max(1, min(CELLS, total["nodes"] // (k + 1)))
    shares = [i / cells_of for i in range(1, cells_of)]
    bounds = [sorted(set(b)) for b in placed.approxQuantile(names, shares, 0.002)] if shares else [[]] * CURVES  # a few numbers per curve

    def met(asked: DataFrame, bounds: list[list[float]], n_asked: int) -> DataFrame:
        """``query, id, score``: the k + 1 nearest nodes at least, of those that the queries in ``asked`` meet."""
        return nearest_of_cells(placed, asked, names, bounds, n_asked, k + 1, dim, kind)

    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    by_id = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    first_ids = hashed.select("id", "h1", "h2").withColumn("place", by_id).where(F.col("place") <= k + 1)
    first_ids = first_ids.groupBy("h1", "h2").agg(F.collect_list("id").alias("ids")).join(nodes.select("h1", "h2", F.col("id").alias("node")), ["h1", "h2"])
    first_ids = written(first_ids.select("node", "ids"), "neighbour-ids")

    def listed(found: DataFrame) -> DataFrame:
        """``query, best``: the k + 1 best rows of each query, itself among them if it is one."""
        top = found.withColumn("rank", rank).where(F.col("rank") <= k + 1).select("query", F.col("id").alias("node"), "score")
        ids = top.join(first_ids, "node").select("query", F.explode("ids").alias("id"), "score")
        best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))), 1, k + 1)
        return ids.groupBy("query").agg(best.alias("best"))

    lists = written(listed(met(placed.where("_asked"), bounds, total["asked"])), "neighbour-lists")
    due = min(k + 1, total["rows"])
    short = lists.where(F.size("best") < due)
    n_short = short.count()
    if n_short:
        again = placed.where("_asked").join(short.select(F.col("query").alias("id")), "id", "left_semi")
        lists = lists.where(F.size("best") >= due).unionByName(listed(met(again, [[]], n_short)))
    of_node = nodes.select("h1", "h2", F.col("id").alias("query")).join(lists, "query").select("h1", "h2", "best")
    out = hashed.where("_asked").select("id", "h1", "h2").join(of_node, ["h1", "h2"])
    out = out.select(F.col("id").alias("query_id"), F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k).alias("best"))
    out = out.select("query_id", F.posexplode("best").alias("place", "x"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def nearest_of_cells(placed: DataFrame, asked: DataFrame, names: list[str], bounds: list[list[float]], n_asked: int, k: int, dim: int, kind: str) -> DataFrame:
    """``query, id, score`` of the k nearest of the rows of each cell that a query of ``asked`` reaches, on each curve that has bounds."""
    window_share = min(1.0, max((2 * REACH + 1) / (len(b) + 1) for b in bounds))
    parts = max(1, math.ceil(n_asked * window_share / QUERIES_AT_ONCE))
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    result = f"query_id {kind}, id {kind}, score double"

    def cell(i: int) -> Column:
        out = F.lit(0)
        for bound in bounds[i]:
            out = out + (F.col(names[i]) > bound).cast("int")
        return out

    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("curve"), cell(i).alias("cell"), F.lit(len(b)).alias("last")) for i, b in enumerate(bounds)]))
    dealt, looking = (x.select("id", "vec", cells.alias("at")).select("id", "vec", "at.*") for x in (placed, asked))
    rows = dealt.select("curve", "cell", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "id", "vec")
    window = F.sequence(F.greatest(F.col("cell") - REACH, F.lit(0)), F.least(F.col("cell") + REACH, F.col("last")))
    asking = looking.select("curve", F.explode(window).alias("cell"), part.alias("part"), F.lit(0).alias("kind"), "id", "vec")
    keys = ["curve", "cell", "part"]
    together = asking.unionByName(rows).repartition(*keys).sortWithinPartitions(*keys, "kind")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of a cell come before its rows."""
        at, asked_ids, asked_rows, best = None, None, None, None

        def flush() -> Iterator[pa.RecordBatch]:
            if best is not None:
                q, ids, scores = best
                yield pa.RecordBatch.from_arrays([pa.array(asked_ids[q]), pa.array(ids), pa.array(scores)], names=["query_id", "id", "score"])

        for b in batches:
            if not b.num_rows:
                continue
            place = np.stack([b.column(i).to_numpy() for i in range(4)], axis=1)
            first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1)))
            for lo, hi in zip(first, np.append(first[1:], b.num_rows), strict=True):
                here, kind_of = tuple(place[lo, :3]), place[lo, 3]
                ids = b.column(4).slice(lo, hi - lo).to_numpy()
                vectors = matrix(b.column(5).slice(lo, hi - lo), dim)
                if here != at:
                    yield from flush()
                    at, asked_ids, asked_rows, best = here, None, None, None
                if kind_of == 0:
                    asked_ids = ids if asked_ids is None else np.concatenate([asked_ids, ids])
                    asked_rows = vectors if asked_rows is None else np.concatenate([asked_rows, vectors])
                elif asked_ids is not None:
                    q, r, s = best_of(asked_rows, vectors, ids, k)
                    found = (q, ids[r], s)
                    if best is not None:
                        found = tuple(np.concatenate(x) for x in zip(best, found, strict=True))
                        order = np.lexsort((found[1], -found[2], found[0]))
                        q = found[0][order]
                        start = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
                        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
                        found = tuple(x[order][rank < k] for x in found)
                    best = found
        yield from flush()

    return together.mapInArrow(meet, result).groupBy(F.col("query_id").alias("query"), "id").agg(F.max("score").alias("score"))
