"""Near-duplicate vectors with iterative quantisation and multi-index Hamming tables.

Rotations are learned that bring the signs of rotated vectors closest to the vectors themselves; the signs are the code. A code is cut into
``TABLE_BITS`` bits per table. A vector stands in one bucket of each table, and looks into that bucket and those one bit away. Vectors of
the same label that meet and whose whole codes differ in few bits are ranked again by the cosine of the original vectors in double precision.

Equal vectors of a label are one node, named after its smallest id and weighted by their number: copies, however many, stand and look once, and
each is linked with the others of its node and with all copies of the nodes that its node is linked with.

A pair is counted in the first table in which it meets, so links are counted without listing pairs: a task emits one number per vector and
bucket, and edges from each vector to one that it is linked with, enough to keep components whole. Vectors are only sent to buckets in which
codes are near. Buckets with many vectors are cut into blocks of about ``BLOCK``, and each block of lookers meets each block of those who stand
there by itself, when codes are compared as well as when vectors are. The driver gets one row per bucket that is cut.

Rotations are learned from at most ``SAMPLE`` rows; every vector is indexed. Rows that ``vectors.usable`` leaves out, and rows without a label, link
with nothing. Ids must be unique; rows with a null id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpitide.llm.common import written
from kpitide.llm.components import components
from kpitide.llm.vectors import matrix, sample, usable

ROTATIONS = 3
CODE_BITS = 64  # of a rotation
TABLE_BITS = 16
STEPS = 30
SAMPLE = 10_000
MOST_BITS = 62  # of all code bits; with random bits, vectors at cosine 0.93 differ in 23 and unrelated ones in 96
BLOCK = 4096
PAIRS_AT_ONCE = 1_000_000
SEED = 5
CODES = [f"code{i}" for i in range(ROTATIONS)]
FLIPS = np.array([0, *(1 << np.arange(TABLE_BITS))])  # of bits of the buckets that a vector looks into


def learn_rotations(some: np.ndarray) -> list[np.ndarray]:
    """Rotations (or projections to ``CODE_BITS`` axes) found by turns: signs for the rotation, then the rotation for the signs."""
    rng = np.random.default_rng(SEED)
    dim = some.shape[1]
    out = []
    for _ in range(ROTATIONS):
        frame = rng.normal(size=(dim, max(dim, CODE_BITS)))
        turn = np.linalg.qr(frame)[0] if dim >= CODE_BITS else np.linalg.qr(frame.T)[0].T
        turn = turn[:, :CODE_BITS]
        for _ in range(STEPS):
            left, _, right = np.linalg.svd(some.T @ np.sign(some @ turn), full_matrices=False)
            turn = left @ right
        out.append(turn)
    return out


def codes(rows: np.ndarray, turns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit integer per rotation."""
    return np.stack([np.packbits(rows @ t > 0, axis=1).view(">u8").ravel().astype(np.uint64) for t in turns], axis=1)


def fields(code: np.ndarray) -> np.ndarray:
    """The code's part for each table."""
    shifts = np.arange(0, CODE_BITS, TABLE_BITS, dtype=np.uint64)
    return ((code[:, :, None] >> shifts) & np.uint64((1 << TABLE_BITS) - 1)).reshape(len(code), -1)


def buckets(of: np.ndarray, code: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """The bucket of each row, table and flip of bits: label, table and bits. The label's hash keeps its upper bits."""
    seen = fields(code)[:, :, None] ^ flips.astype(np.uint64)
    label = of.view(np.uint64)[:, None, None] & ~np.uint64((1 << 20) - 1)
    return label | (np.arange(seen.shape[1], dtype=np.uint64)[:, None] << np.uint64(16)) | seen


def busy_buckets(coded: DataFrame, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets in which more than ``BLOCK`` stand or look, in order, and the numbers of blocks of lookers and of those standing. ``coded``: ``of`` and codes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = np.stack([b.column(1 + i).to_numpy() for i in range(ROTATIONS)], axis=1).view(np.uint64)
            found, n = np.unique(buckets(b.column(0).to_numpy(), code, np.zeros(1)).ravel(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["bucket", "n"])

    standing = coded.mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    standing = written(standing, "vector-buckets")
    seen = F.explode(F.array(*[F.col("bucket").bitwiseXOR(F.lit(int(x))) for x in FLIPS])).alias("bucket")
    looking = standing.select(seen, "n").groupBy("bucket").agg(F.sum("n").alias("looking"))
    both = standing.join(looking, "bucket").where(F.greatest("n", "looking") > BLOCK)
    found = sorted((r["bucket"], -(-r["looking"] // BLOCK), -(-r["n"] // BLOCK)) for r in both.collect())
    return tuple(np.array([x[i] for x in found], np.int64) for i in range(3))


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def near_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each tile that have a code nearby on the other side. Rows: ``bucket, tile, side, id`` and the codes; side 0 stands, 1 looks."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    bucket, tile, side, ids, *code = (table.column(i).to_numpy() for i in range(4 + ROTATIONS))
    order = np.lexsort((side, tile, bucket))
    bucket, tile, side, ids, code = bucket[order], tile[order], side[order], ids[order], np.stack(code, axis=1)[order]
    start = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])))
    stands = np.add.reduceat((side == 0).astype(np.int64), start)
    near = np.zeros(len(bucket), bool)
    looker = np.flatnonzero(side == 1)
    group = np.searchsorted(start, looker, side="right") - 1
    count = stands[group]
    looker, group, count = looker[count > 0], group[count > 0], count[count > 0]
    at = 0
    while at < len(looker):
        upto = max(at + 1, at + int(np.searchsorted(np.cumsum(count[at : at + PAIRS_AT_ONCE]), PAIRS_AT_ONCE)))
        n = count[at:upto]
        a = np.repeat(looker[at:upto], n)
        b = np.repeat(start[group[at:upto]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        bits = np.bitwise_count((code[a] ^ code[b]).view(np.uint64)).sum(axis=1)
        keep = (bits <= MOST_BITS) & (ids[a] != ids[b])
        near[a[keep]] = True
        near[b[keep]] = True
        at = upto
    found = np.flatnonzero(near)
    for lo in range(0, len(found), 100_000):
        part = found[lo : lo + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (bucket, side, ids)], names=["bucket", "side", "id"])


class Bucket:
    """Links between those who look into a bucket and those who stand in it, of one block each."""

    def __init__(self, ids: np.ndarray, code: np.ndarray, of: np.ndarray, n: np.ndarray, rows: np.ndarray, table: int, least: float):
        self.ids, self.code, self.of, self.n, self.rows, self.table, self.least = ids, code, of, n, rows, table, least
        self.root = np.arange(len(ids))

    def look(self, ids: np.ndarray, code: np.ndarray, of: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """Links of each looker that are met here first, with all copies, and an edge from each that has any link."""
        counts = np.zeros(len(ids), np.int64)
        edges = []
        step = max(1, PAIRS_AT_ONCE // max(1, len(self.ids)))
        for lo in range(0, len(ids), step):
            linked = rows[lo : lo + step] @ self.rows.T >= self.least
            linked &= (ids[lo : lo + step, None] != self.ids) & (of[lo : lo + step, None] == self.of)
            a, b = np.nonzero(linked)
            if not len(a):
                continue
            apart = fields(code[lo + a] ^ self.code[b])[:, : self.table]
            before = (np.bitwise_count(apart) <= 1).any(axis=1)
            np.add.at(counts, lo + a[~before], self.n[b[~before]])
            first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
            for i, j in zip(first, np.append(first[1:], len(a)), strict=True):
                roots = np.unique(self.root[b[i:j]])
                if len(roots) > 1:
                    self.root[np.isin(self.root, roots)] = roots[0]
                edges.append((ids[lo + a[i]], self.ids[b[i]]))
        return counts, edges

    def joined(self) -> list[tuple]:
        """Edges that hold together those standing here who have lookers in common."""
        return [(self.ids[i], self.ids[r]) for i, r in enumerate(self.root) if i != r]


def links(df: DataFrame, least: float, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, n_links, component`` of every row: vectors linked directly, and the smallest id reachable."""
    everyone = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"))
    points, dim = usable(df.where(F.col(label).isNotNull()), key, vector, label)
    kind = dict(points.dtypes)["id"]
    alone = [F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component")]
    if dim == 0:
        return everyone.select("id", *alone)
    # Equal vectors of a label are known by two hashes.
    hashed = points.select("id", "vec", F.xxhash64(F.col(label).cast("string")).alias("of"), F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(SEED), "vec").alias("h2"))
    made = hashed.groupBy("of", "h1", "h2").agg(F.min("id").alias("id"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"))
    nodes = written(made, "vector-nodes")
    some = sample(nodes, SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    turns = learn_rotations(unit(matrix(some, dim)))
    tables = ROTATIONS * CODE_BITS // TABLE_BITS

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = codes(unit(matrix(b.column(1), dim)), turns).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c) for c in code.T)], names=["id", "vec", "of", "n", "h1", *CODES])

    vec, code_columns = dict(points.dtypes)["vec"], ", ".join(f"{c} bigint" for c in CODES)
    everything = nodes.select("id", "vec", "of", "n", "h1").mapInArrow(coded, f"id {kind}, vec {vec}, of bigint, n bigint, h1 bigint, {code_columns}")
    everything = written(everything, "vector-codes")
    busy, lookers_in, standers_in = busy_buckets(everything.select("of", *CODES), tables)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = np.array([0, *[1] * (TABLE_BITS + 1)], np.int32)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                b = batch.slice(lo, 2000)
                code = np.stack([b.column(3 + i).to_numpy() for i in range(ROTATIONS)], axis=1).view(np.uint64)
                bucket = buckets(b.column(1).to_numpy(), code, np.concatenate([[0], FLIPS])).ravel().view(np.int64)
                row = np.repeat(np.arange(b.num_rows), tables * len(sides))
                side = np.tile(sides, b.num_rows * tables)
                tile = np.zeros(len(row), np.int64)
                if len(busy):
                    at = np.minimum(np.searchsorted(busy, bucket), len(busy) - 1)
                    cut = busy[at] == bucket
                    looking, standing = np.where(cut, lookers_in[at], 1), np.where(cut, standers_in[at], 1)
                    # A row is in one block of its side and meets every block of the other.
                    others = np.where(side == 1, standing, looking)
                    own = b.column(2).to_numpy()[row].view(np.uint64) % np.where(side == 1, looking, standing).astype(np.uint64)
                    again = np.repeat(np.arange(len(row)), others)
                    other = np.arange(len(again)) - np.repeat(np.cumsum(others) - others, others)
                    bucket, row, side, own, standing = bucket[again], row[again], side[again], own.astype(np.int64)[again], standing[again]
                    tile = np.where(side == 1, own * standing + other, other * standing + own)
                code = code.view(np.int64)[row]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (bucket, tile, side)), b.column(0).take(pa.array(row)), *(pa.array(c) for c in code.T)],
                    names=["bucket", "tile", "side", "id", *CODES],
                )

    rows = everything.select("id", "of", "h1", *CODES).mapInArrow(placed, f"bucket bigint, tile bigint, side int, id {kind}, {code_columns}")
    near = rows.repartition("bucket", "tile").mapInArrow(near_codes, f"bucket bigint, side int, id {kind}")
    near = written(near.distinct() if len(busy) else near, "vector-near")

    many = [F.ceil(F.sum(x) / BLOCK).cast("int").alias(name) for x, name in ((F.col("side"), "lookers"), (1 - F.col("side"), "standers"))]
    dealt = near.join(near.groupBy("bucket").agg(*many), "bucket")
    one, each = (lambda of: F.pmod(F.xxhash64("id"), F.col(of)).cast("int")), (lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1)))
    standing = dealt.where("side = 0 and lookers > 0").select("bucket", "side", "id", one("standers").alias("own"), each("lookers").alias("block"))
    looking = dealt.where("side = 1 and standers > 0").select("bucket", "side", "id", each("standers").alias("own"), one("lookers").alias("block"))
    dealt = standing.unionByName(looking).join(everything.select("id", "vec", "of", "n", *CODES), "id")
    keys = ["bucket", "block", "own"]
    dealt = dealt.select(*keys, "side", "id", *CODES, "of", "n", "vec").repartition(*keys).sortWithinPartitions(*keys, "side")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``a, b, n``: links of a met here, or (n null) an edge from a to b."""
        at, held, bucket = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            out_a, out_b, out_n = [], [], []
            place = np.stack([b.column(i).to_numpy() for i in range(4)], axis=1)
            code = np.stack([b.column(5 + i).to_numpy() for i in range(ROTATIONS)], axis=1).view(np.uint64)
            ids, of, n_copies = (b.column(i).to_numpy() for i in (4, 5 + ROTATIONS, 6 + ROTATIONS))
            vectors = unit(matrix(b.column(7 + ROTATIONS), dim))
            first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1)))
            for lo, hi in zip(first, np.append(first[1:], b.num_rows), strict=True):
                here, side = tuple(place[lo, :3]), place[lo, 3]
                some_rows = (ids[lo:hi], code[lo:hi], of[lo:hi], vectors[lo:hi])
                copies = n_copies[lo:hi]
                if here != at:
                    if bucket is not None:
                        for x, y in bucket.joined():
                            out_a.append(x), out_b.append(y), out_n.append(None)
                    at, held, bucket = here, [], None
                if side == 0:
                    held.append((*some_rows[:3], copies, some_rows[3]))
                    continue
                if bucket is None:
                    if not held:
                        continue
                    table = int(here[0]) >> 16 & 15
                    bucket = Bucket(*(np.concatenate(x) for x in zip(*held, strict=True)), table, least)
                counts, edges = bucket.look(*some_rows)
                for x, n in zip(some_rows[0][counts > 0], counts[counts > 0], strict=True):
                    out_a.append(x), out_b.append(x), out_n.append(n)
                for x, y in edges:
                    out_a.append(x), out_b.append(y), out_n.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, b.schema.field(4).type), pa.array(out_b, b.schema.field(4).type), pa.array(out_n, pa.int64())], names=["a", "b", "n"])
        if bucket is not None and (rest := bucket.joined()):
            a, b = zip(*rest, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a)), pa.array(np.array(b)), pa.nulls(len(a), pa.int64())], names=["a", "b", "n"])

    found = written(dealt.mapInArrow(rank, f"a {kind}, b {kind}, n bigint"), "vector-links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("found"))
    groups = components(found.where("n is null").select("a", "b"))
    linked = nodes.select("of", "h1", "h2", "n", F.col("id").alias("node")).join(counts.withColumnRenamed("id", "node"), "node", "left")
    linked = linked.join(groups.withColumnRenamed("id", "node"), "node", "left")
    total = (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("total")
    linked = linked.select("of", "h1", "h2", total, F.coalesce("component", "node").alias("component"))
    of_row = hashed.select("id", "of", "h1", "h2").join(linked, ["of", "h1", "h2"]).select("id", "total", "component")
    out = everyone.join(of_row, "id", "left")
    return out.select("id", F.coalesce("total", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component"))
