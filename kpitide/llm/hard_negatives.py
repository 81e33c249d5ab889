"""Hard negatives by angular triangle filtering.

Scores are inner products of vectors of whole numbers. Reference directions are learned; each row is kept with its angle to the nearest one (its
cell). For an anchor at angle a from the reference of a cell and a row at angle x, the triangle inequality puts the angle between them into
[|a - x|, a + x], and so the cosine between cos(a + x) and cos(|a - x|). Times both norms these are bounds of the score, taken a little
wider than rounding can move them. Rows of a cell stand in order of their angle, so the bounds leave a window of them, and only what lies in
a window is scored. A cell as a whole is held against all references the same way, and an anchor is not sent where no window can be.

Positives first meet their own cell, which gives a score that the others have to reach. Negatives have to lie in the score window of
some positive, and where three are found in an anchor's own cell for each positive, above the least of these.

In data without directions the bounds part little: cosines are near zero everywhere, and nearly all rows are scored against all anchors,
in blocks. Cells are dealt into parts of ``PART`` times the root of the number of rows, so both what a task holds and the copies of an anchor grow
with the root. Of rows with equal vectors and labels only the few of smallest ids can ever be returned, so only these go on as
candidates, however many there are.

Left out are rows with a null id, label or vector, vectors with null or non-finite components, and vectors without the number of components
that most have (the larger number if as many have another). Vectors of zeros take part, in a cell of their own. Rows with an equal id
are the same one if label and vector are equal as well; otherwise each is a candidate, and none of them is an "other row" to one of that
id. Scores must fit 64 bits. Other columns are not touched. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpitide.llm import vectors
from kpitide.llm.common import written

SAMPLE = 10_000
REFERENCES = 32
ROUNDS = 8
PART = 8
ANCHORS_AT_ONCE = 8192  # that a task holds
CELLS_AT_ONCE = 4_000_000  # scores
MARGIN = 1e-6  # radians; rounding moves an angle by less than 1e-7
EXACT = 2**53
NO_CELL = -1  # of vectors of zeros


def angles(x: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles between vectors and references; of zeros none is meant."""
    cosines = (x @ references.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly."""
    if len(a) and len(b) and a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) >= EXACT:
        return a @ b.T  # integers of 64 bits
    return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)


def takes_part(df: DataFrame, key: str, vector: str, label: Column, scaled: Callable[[Column], Column]) -> tuple[DataFrame, int]:
    """``id, label, vec`` of the rows that take part, with whole components, and the number of components."""
    column = F.col(vector)
    fine = df.select(F.col(key).alias("id"), label.alias("label"), column.alias("vec")).where("id is not null and label is not null and vec is not null")
    fine = fine.where(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    sizes = fine.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    dim = sizes[0]["size"] if sizes else 0
    whole = F.transform("vec", lambda x: scaled(x.cast("double")).cast("bigint"))
    return fine.where(F.size("vec") == dim).select("id", "label", whole.alias("vec")), dim


def learn(points: DataFrame, dim: int) -> np.ndarray:
    """Reference directions: centres of a sample of at most ``SAMPLE`` rows, by cosine, from a start that spreads them."""
    some = vectors.sample(points, SAMPLE).select("vec").toArrow().column(0).combine_chunks()
    x = vectors.matrix(some, dim) if dim else np.empty((0, 1))
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.eye(1, max(dim, 1))
    x = x[np.lexsort(x.T)]
    centres, far = [x[0]], x @ x[0]
    while len(centres) < min(REFERENCES, len(x)):
        centres.append(x[int(np.argmin(far))])
        far = np.maximum(far, x @ centres[-1])
    found = np.array(centres)
    for _ in range(ROUNDS):
        own = np.argmax(x @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1)
        found = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], found)
    return found


def with_angles(points: DataFrame, references: np.ndarray, dim: int) -> DataFrame:
    """Add ``norm``, ``cell`` (the nearest reference), ``angle`` (to it) and ``angles`` (to all)."""
    kinds = dict(points.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = vectors.matrix(b.column(2), dim)
            norms = np.linalg.norm(x, axis=1)
            all_angles = angles(x, norms, references)
            cell = np.where(norms > 0, np.argmin(all_angles, axis=1), NO_CELL).astype(np.int32)
            own = np.where(norms > 0, all_angles[np.arange(len(x)), cell], 0.0)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(all_angles.ravel()), len(references)).cast(pa.list_(pa.float64()))
            columns = [*b.columns, pa.array(norms), pa.array(cell), pa.array(own), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "vec", "norm", "cell", "angle", "angles"])

    schema = f"id {kinds['id']}, label {kinds['label']}, vec array<bigint>, norm double, cell int, angle double, angles array<double>"
    return points.mapInArrow(run, schema)


class Cells:
    """Of each cell the number of rows, the ranges of angles to all references, and the range of norms. As many as references."""

    def __init__(self, rows: DataFrame, n_references: int):
        ranges = [f(F.col("angles")[r]).alias(f"{name}{r}") for r in range(n_references) for name, f in (("low", F.min), ("high", F.max))]
        found = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("norm").alias("small"), F.max("norm").alias("large"), *ranges).orderBy("cell").collect()
        self.cell = np.array([r["cell"] for r in found], np.int32)
        self.low, self.high = (np.array([[r[f"{s}{k}"] for k in range(n_references)] for r in found]).reshape(len(found), n_references) for s in ("low", "high"))
        self.small, self.large = (np.array([r[s] for r in found], np.float64) for s in ("small", "large"))
        n = np.array([r["n"] for r in found], np.int64)
        self.parts = -(-n // max(1, int(PART * np.sqrt(n.sum()))))

    def bounds(self, own: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of anchors (rows) with any row of a cell (columns)."""
        gap = np.zeros((len(own), len(self.cell)))
        span = np.full((len(own), len(self.cell)), np.pi)
        for r in range(own.shape[1]):
            a = own[:, r : r + 1]
            np.maximum(gap, np.maximum(self.low[:, r] - a, a - self.high[:, r]), out=gap)
            np.minimum(span, np.minimum(a + self.high[:, r], 2 * np.pi - a - self.low[:, r]), out=span)
        # A vector of zeros has no angles: whoever meets one, the score is 0.
        none = (norms == 0)[:, None] | (self.cell == NO_CELL)
        return scores_between(gap, span, norms[:, None], self.small, self.large, none)


def scores_between(gap, span, norm, small, large, none) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores with angles from ``gap`` to ``span`` and norms from ``small`` to ``large``, a little wider than rounding."""
    top, bottom = np.cos(np.maximum(gap - MARGIN, 0)), np.cos(np.minimum(span + MARGIN, np.pi))
    high = norm * np.where(top > 0, large, small) * top
    low = norm * np.where(bottom > 0, small, large) * bottom
    slack = 1e-9 * norm * large + 1e-3
    return np.where(none, 0.0, low - slack), np.where(none, 0.0, high + slack)


def _sent(anchors: DataFrame, cells: Cells, slices: int, own: bool | None) -> DataFrame:
    """The anchors in each cell and part that their windows reach. ``own``: only their own cell, only the others, or all.

    ``anchors`` have ``wins``: pairs of least and largest score that are still of use.
    """
    fields = [f for f in anchors.schema.fields if f.name != "angles"]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                norms = b.column("norm").to_numpy()
                mine = b.column("cell").to_numpy()
                to_all = np.stack(b.column("angles").to_numpy(zero_copy_only=False))
                low, high = cells.bounds(to_all, norms)
                useful = np.zeros(low.shape, bool)
                count = np.diff(b.column("wins").offsets.to_numpy())
                wins = b.column("wins").flatten()
                at = np.repeat(np.arange(b.num_rows), count)
                least, most = (wins.field(i).to_numpy()[:, None].astype(np.float64) for i in (0, 1))
                np.logical_or.at(useful, at, (high[at] >= least) & (low[at] <= most))
                if own is not None:
                    useful &= (mine[:, None] == cells.cell) == own
                row, cell = np.nonzero(useful)
                parts = cells.parts[cell]
                row, cell = np.repeat(row, parts), np.repeat(cell, parts)
                part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                # In portions of about a thousand rows.
                for k in range(0, len(row), 1000):
                    some = pa.array(row[k : k + 1000])
                    columns = [b.column(n).take(some) for n in names]
                    columns += [pa.array(cells.cell[cell[k : k + 1000]]), pa.array(part[k : k + 1000].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=[*names, "to_cell", "to_part"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    out = anchors.mapInArrow(run, f"{schema}, to_cell int, to_part int")
    return out.withColumn("to_slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))


def _window(x_angle, x_norm, a_angle, a_norm, least, most, cell):
    """Which rows (in order of angle) a batch of anchors may need, from the first to the last, and for each pair whether it does."""
    gap, span = np.abs(x_angle - a_angle[:, None]), a_angle[:, None] + x_angle
    none = (a_norm == 0)[:, None] | np.full(len(x_angle), cell == NO_CELL)
    low, high = scores_between(gap, span, a_norm[:, None], x_norm, x_norm, none)
    return (high >= least[:, None]) & (low <= most[:, None])


def _met(rows: DataFrame, anchors: DataFrame, slices: int, k: int, same_label: bool, references: np.ndarray, dim: int) -> DataFrame:
    """``anchor, win, id, score``: in each cell and part, of each window of each anchor the ``k`` best rows."""
    kind = dict(rows.dtypes)["id"]
    dealt = rows.withColumn("to_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    on = ["to_cell", "to_part", "to_slice"]
    schema = f"anchor {kind}, copy bigint, win int, id {kind}, score bigint"

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"anchor": pa.array([], left.schema.field("id").type), "copy": pa.array([], pa.int64()), "win": pa.array([], pa.int32()), "id": pa.array([], left.schema.field("id").type), "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        cell = key[0].as_py()
        left, right = left.sort_by([("angle", "ascending")]).combine_chunks(), right.combine_chunks()
        whole = lambda t: t.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, dim)
        x, a = whole(left), whole(right)
        x_angle, x_norm, x_label = (left.column(c).to_numpy() for c in ("angle", "norm", "label"))
        a_norm, a_label = (right.column(c).to_numpy() for c in ("norm", "label"))
        a_angle = np.where(a_norm > 0, angles(a.astype(np.float64), a_norm, references[[max(cell, 0)]])[:, 0], 0.0)
        wins = right.column("wins").combine_chunks()
        first = wins.offsets.to_numpy()
        least, most = (wins.flatten().field(i).to_numpy() for i in (0, 1))
        x_ids, a_ids = left.column("id").combine_chunks(), right.column("id").combine_chunks()
        _, code = np.unique(np.concatenate([np.asarray(x_ids), np.asarray(a_ids)]), return_inverse=True)
        x_code, a_code = code[: len(x)], code[len(x) :]
        lowest, highest = np.minimum.reduceat(least, first[:-1]), np.maximum.reduceat(most, first[:-1])
        order = np.argsort(a_angle, kind="stable")
        step = max(1, CELLS_AT_ONCE // max(len(x), 1) // 4)
        out: list[tuple[np.ndarray, ...]] = []
        for lo in range(0, len(order), step):
            some = order[lo : lo + step]
            near = _window(x_angle, x_norm, a_angle[some], a_norm[some], lowest[some].astype(np.float64), highest[some].astype(np.float64), cell)
            near &= (x_label == a_label[some][:, None]) == same_label
            near &= x_code != a_code[some][:, None]
            used = np.flatnonzero(near.any(axis=0))
            if not len(used):
                continue
            near, score = near[:, used], products(a[some], x[used])
            for w in range(int(np.diff(first)[some].max())):
                there = w < np.diff(first)[some]
                at = np.where(there, first[some] + w, 0)
                hit = near & there[:, None] & (score >= least[at][:, None]) & (score <= most[at][:, None])
                row, col = np.nonzero(hit)
                s, c = score[row, col], x_code[used[col]]
                best = np.lexsort((c, -s, row))
                row, col, s = row[best], col[best], s[best]
                start = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
                place = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
                keep = place < k
                out.append((some[row[keep]], np.full(int(keep.sum()), w, np.int32), used[col[keep]], s[keep]))
        if not out:
            return empty
        a_row, win, x_row, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"anchor": a_ids.take(pa.array(a_row)), "copy": right.column("copy").combine_chunks().take(pa.array(a_row)), "win": pa.array(win), "id": x_ids.take(pa.array(x_row)), "score": pa.array(score)})

    return dealt.groupBy(*on).cogroup(anchors.groupBy(*on)).applyInArrow(run, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "copy", "win").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    is_anchor: Column,
    positives: int,
    negatives: int,
    window: tuple[int, int],
    label: Column,
    scaled: Callable[[Column], Column] = F.floor,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    The positives of an anchor are its best rows of the same label; the negatives of a positive with score p the best rows of other labels
    with scores from ``window[0]`` to ``window[1]`` hundredths of p. ``is_anchor`` is a condition on the column ``id``, ``scaled`` makes a component whole.
    """
    points, dim = takes_part(df, key, vector, label, scaled)
    points = written(points.distinct(), "negatives-points")
    references = learn(points, dim)
    placed = written(with_angles(points, references, dim), "negatives-placed")
    copy = F.xxhash64("label", "vec").alias("copy")  # tells rows with the same id apart
    asked = written(placed.where(is_anchor).select("id", copy, "label", "vec", "norm", "cell", "angles"), "negatives-anchors")

    most = positives + 1
    equal = Window.partitionBy("label", "vec").orderBy("id")
    few = placed.withColumn("_place", F.row_number().over(equal)).where(F.col("_place") <= max(most, negatives + 1)).drop("_place")
    few = written(few, "negatives-candidates")
    cells = Cells(few, len(references))
    n_parts = F.element_at(F.create_map(*[F.lit(int(v)) for p in zip(cells.cell, cells.parts) for v in p]), F.col("cell")) if len(cells.cell) else F.lit(1)
    part = F.pmod(F.xxhash64("id", "label"), n_parts).cast("int")
    rows = few.select("id", "label", "vec", "norm", "angle", F.col("cell").alias("to_cell"), part.alias("to_part"))
    slices = max(1, -(-asked.count() // ANCHORS_AT_ONCE))

    end = 2**62
    wins = lambda *pairs: F.array(*[F.struct(F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi")) for lo, hi in pairs])

    def found(anchors: DataFrame, k: int, same: bool, own: bool) -> DataFrame:
        return _best(_met(rows, _sent(anchors, cells, slices, own), slices, k, same, references, dim), k).drop("rank")

    at_home = written(found(asked.withColumn("wins", wins((-end, end))), positives, True, True), "negatives-home")
    reached = at_home.groupBy("anchor", "copy").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = reached.select(F.col("anchor").alias("id"), "copy", F.when(F.col("n") >= positives, F.col("least")).alias("least"))
    nearer = asked.join(reached, ["id", "copy"], "left").withColumn("wins", wins((F.coalesce("least", F.lit(-end)), end))).drop("least")
    away = found(nearer, positives, True, False)
    pairs = written(_best(at_home.unionByName(away), positives), "negatives-positives")

    # In whole numbers: the low end rounded up, the high end rounded down.
    floored = "((score * {0}) - pmod(score * {0}, 100L)) div 100"
    low, high = F.expr("-(" + floored.format(f"({-window[0]}L)") + ")"), F.expr(floored.format(f"{window[1]}L"))
    each = F.struct("rank", low.alias("lo"), high.alias("hi"))
    spans = pairs.groupBy("anchor", "copy").agg(F.sort_array(F.collect_list(each)).alias("spans"))
    spans = spans.select(F.col("anchor").alias("id"), "copy", F.transform("spans", lambda s: F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"))).alias("spans"))
    searching = written(asked.join(spans, ["id", "copy"]).withColumnRenamed("spans", "wins"), "negatives-searching")

    at_home = written(found(searching, negatives, False, True), "negatives-near")
    reached = at_home.groupBy("anchor", "copy", "win").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = reached.where(F.col("n") >= negatives).groupBy("anchor", "copy").agg(F.map_from_entries(F.collect_list(F.struct("win", "least"))).alias("least"))
    reached = reached.select(F.col("anchor").alias("id"), "copy", "least")
    raised = F.transform("wins", lambda w, i: F.struct(F.greatest(w["lo"], F.col("least")[i]).alias("lo"), w["hi"].alias("hi")))
    nearer = searching.join(reached, ["id", "copy"], "left").withColumn("wins", raised).drop("least")
    away = found(nearer, negatives, False, False)
    answers = _best(at_home.unionByName(away), negatives).select("anchor", "copy", (F.col("win") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    of_anchor = pairs.select("anchor", "copy", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return of_anchor.join(answers, ["anchor", "copy", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
